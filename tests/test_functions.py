"""Boundary rows of every classification and the time and text functions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from railgauge.functions import classify, numbers, text, times


def evaluate(spark, schema, values, column):
    rows = [(i, *(value if isinstance(value, tuple) else (value,))) for i, value in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [row[1] for row in df.select("i", column.alias("result")).orderBy("i").collect()]


def test_delay_severity(spark):
    delays = [None, -30, 60, 61, 300, 301, 600, 601]
    labels = ["on_time", "on_time", "on_time", "minor", "minor", "moderate", "moderate", "severe"]
    assert evaluate(spark, "d int", delays, classify.delay_severity("d")) == labels


def test_headway_status(spark):
    gaps = [None, 0.0, 300.0, 301.0, 600.0, 601.0]
    labels = ["unknown", "bunched", "bunched", "normal", "normal", "sparse"]
    assert evaluate(spark, "g double", gaps, classify.headway_status("g")) == labels


def test_gap_cap(spark):
    gaps = [1800.0, 1801.0, None]
    assert evaluate(spark, "g double", gaps, classify.nullify_over("g")) == [1800.0, None, None]
    assert evaluate(spark, "g double", gaps, classify.null_or_within("g")) == [True, False, True]


def test_effect_label(spark):
    labels = evaluate(spark, "e int", [1, 11, 0, 12, None], classify.effect_label("e"))
    assert labels == ["no_service", "accessibility_issue", "unknown_effect", "unknown_effect", "unknown_effect"]


def test_weather_flags(spark):
    assert evaluate(spark, "t double", [32.1, 32.2, None], classify.is_extreme_heat("t")) == [False, True, False]
    assert evaluate(spark, "p double", [0.0, 0.1, None], classify.is_positive("p")) == [False, True, False]


def test_weather_condition(spark):
    rows = [
        (15.0, 0.0, 0.1),
        (15.0, 5.1, 0.0),
        (15.0, 5.0, 0.0),
        (32.2, 0.0, 0.0),
        (27.0, 0.0, 0.0),
        (0.0, 0.0, 0.0),
        (15.0, 0.0, 0.0),
        (None, None, None),
    ]
    labels = ["snow", "heavy_rain", "light_rain", "extreme_heat", "hot", "freezing", "mild", "mild"]
    schema = "temperature_c double, precip_mm double, snowfall_cm double"
    assert evaluate(spark, schema, rows, classify.weather_condition()) == labels


def test_feels_like(spark):
    rows = [(27.0, 60.0), (30.0, 80.0), (26.9, 90.0), (27.0, None)]
    schema = "temperature_c double, humidity_pct double"
    assert evaluate(spark, schema, rows, classify.feels_like()) == [27.0, 32.0, 26.9, 27.0]


def test_wind_category(spark):
    speeds = [29.9, 30.0, 59.9, 60.0, None]
    labels = ["light", "moderate", "moderate", "strong", "light"]
    assert evaluate(spark, "wind_speed_kmh double", speeds, classify.wind_category()) == labels


NOW = datetime(2024, 1, 20)
EARLIER, LATER = datetime(2024, 1, 19), datetime(2024, 1, 21)
PERIODS = [(LATER, None), (NOW, None), (EARLIER, LATER), (EARLIER, NOW), (None, None), (None, EARLIER), (LATER, EARLIER)]


def test_alert_status(spark):
    schema = "start_time timestamp, end_time timestamp"
    found = evaluate(spark, schema, PERIODS, classify.alert_status(as_of=NOW))
    assert found == ["upcoming", "ongoing", "active", "expired", "ongoing", "expired", "upcoming"]
    relevant = evaluate(spark, schema, PERIODS, classify.is_relevant(as_of=NOW))
    assert relevant == [status != "expired" for status in found]


def test_alert_status_defaults_to_now(spark):
    schema = "start_time timestamp, end_time timestamp"
    found = evaluate(spark, schema, [(datetime(2000, 1, 1), datetime(2001, 1, 1))], classify.alert_status())
    assert found == ["expired"]


def test_window_floor(spark):
    stamps = ["2024-01-01 12:00:00", "2024-01-01 12:14:59.999999", "2024-01-01 12:15:00", "1969-12-31 23:59:59", None]
    floors = evaluate(spark, "t string", stamps, times.window_floor(F.col("t").cast("timestamp")).cast("string"))
    assert floors == [
        "2024-01-01 12:00:00",
        "2024-01-01 12:00:00",
        "2024-01-01 12:15:00",
        "1969-12-31 23:45:00",
        None,
    ]


def test_epoch_and_text_times(spark):
    assert evaluate(spark, "e string", ["0", "x", None], times.from_epoch("e").cast("string")) == [
        "1970-01-01 00:00:00",
        None,
        None,
    ]
    local = ["2026-06-10T11:45", "not a time", None]
    assert evaluate(spark, "t string", local, times.parse_local("t").cast("string")) == ["2026-06-10 11:45:00", None, None]
    assert evaluate(spark, "t string", ["2026-06-10T11:45:00-04:00"], times.parse_instant("t").cast("string")) == [
        "2026-06-10 15:45:00"
    ]


def test_local_to_instant(spark):
    """The sample observation: labelled UTC, or moved from New York to true UTC."""
    wall_clock = F.col("t").cast("timestamp_ntz")
    labelled = times.hour_floor(times.local_to_instant(wall_clock)).cast("string")
    shifted = times.hour_floor(times.local_to_instant(wall_clock, "America/New_York")).cast("string")
    assert evaluate(spark, "t string", ["2026-06-10T11:45"], labelled) == ["2026-06-10 11:00:00"]
    assert evaluate(spark, "t string", ["2026-06-10T11:45"], shifted) == ["2026-06-10 15:00:00"]


def test_hours_between(spark):
    pairs = [(datetime(2024, 1, 1, 6, 30), datetime(2024, 1, 1)), (datetime(2024, 1, 1), datetime(2024, 1, 2)), (None, NOW)]
    assert evaluate(spark, "a timestamp, b timestamp", pairs, times.hours_between("a", "b")) == [6.5, -24.0, None]


def test_file_instant(spark):
    names = ["file:/raw/weather_20260610_155719.json", "file:/raw/weather.json", "file:/20260610_155719/weather.json"]
    fallback = F.lit("2020-01-01").cast("timestamp")
    assert evaluate(spark, "f string", names, times.file_instant("f", fallback).cast("string")) == [
        "2026-06-10 15:57:19",
        "2020-01-01 00:00:00",
        "2026-06-10 15:57:19",
    ]


def test_from_epoch_has_no_overflow(spark):
    seconds = [0, 9223372036854775807, -9223372036854775808, 253402300799, 253402300800, -62135596800, -62135596801]
    read = evaluate(spark, "s bigint", seconds, times.from_epoch("s").isNotNull())
    assert read == [True, False, False, True, False, True, False]


def test_numbers(spark):
    assert evaluate(spark, "x double", [1.005, 2.5, -2.5, None], numbers.round_scaled("x", 2)) == [1.0, 2.5, -2.5, None]
    pairs = [(1, 3), (0, 0), (2, 2)]
    assert evaluate(spark, "a int, b int", pairs, numbers.percentage("a", "b")) == [33.33, None, 100.0]
    assert evaluate(spark, "x int", [None, 5], numbers.null_to_zero("x", "int")) == [0, 5]


@pytest.mark.parametrize(
    ("function", "values", "expected"),
    [
        (text.minutes_seconds, [125.7, 59.9, None], ["2m 5s", "0m 59s", "—"]),
        (text.minutes, [125.7, None], ["2m", "—"]),
        (text.days_hours, [23.9, 24.0, 100.5], ["23h", "1d 0h", "4d 4h"]),
        (text.starts_in, [0.5, 49.9], ["in 0h", "in 2d 1h"]),
        (text.count_text, [7.0, None], ["7", "—"]),
        (lambda c: text.measure(c, "mm"), [0.0, None], ["0.0mm", "—"]),
    ],
)
def test_display_text(spark, function, values, expected):
    assert evaluate(spark, "x double", values, function("x")) == expected


def test_flagged_measure(spark):
    rows = [(33.0, True), (20.0, False), (20.0, None), (None, True)]
    shown = text.measure("t", "°C", F.col("hot"), text.HEAT_MARK)
    assert evaluate(spark, "t double, hot boolean", rows, shown) == ["33.0°C 🔥", "20.0°C", "20.0°C", "—"]


def test_dates_and_prefixes(spark):
    stamps = [datetime(2024, 1, 5, 7, 3), None]
    assert evaluate(spark, "t timestamp", stamps, text.utc_date("t", text.NO_END)) == ["Jan 05 07:03 UTC", "TBD"]
    assert evaluate(spark, "t timestamp", stamps, text.utc_stamp("t")) == ["2024-01-05 07:03 UTC", None]
    assert evaluate(spark, "s string", ["é" * 300, "short", None], F.length(text.prefix("s"))) == [200, 5, None]
    assert evaluate(spark, "s string", ["x" * 90], text.title("s")) == ["x" * 80 + "..."]
