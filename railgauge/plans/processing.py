"""Raw rows to processed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import classify, text, times
from ..functions.numbers import null_to_zero
from ..operators.dedup import ALERT_KEY, DELAY_KEY, WEATHER_KEY, keep_first
from ..operators.filters import any_present
from ..operators.headway import with_headway
from ..sources import feeds
from ..sources.weather import first_raw_weather


def clean_delays(raw: DataFrame) -> DataFrame:
    known = any_present(raw, ["arrival_delay", "departure_delay"])
    return _delays(keep_first(known, DELAY_KEY))


def snapshot_delays(feed: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES) -> DataFrame:
    """``clean_delays`` straight from snapshots of one row per file, without a shuffle; works on streams."""
    return _delays(feeds.first_raw_delays(feed, routes))


def _delays(first: DataFrame) -> DataFrame:
    return first.select(
        "vehicle_id",
        "trip_id",
        "route_id",
        "stop_id",
        null_to_zero("arrival_delay", "int").alias("arrival_delay"),
        null_to_zero("departure_delay", "int").alias("departure_delay"),
        "source_file",
        F.col("event_time").cast("timestamp").alias("event_time"),
        classify.delay_severity("arrival_delay").alias("delay_severity"),
        times.window_floor("event_time").alias("window_start"),
    )


def clean_alerts(raw: DataFrame) -> DataFrame:
    return _alerts(keep_first(raw, ALERT_KEY))


def snapshot_alerts(feed: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES) -> DataFrame:
    """``clean_alerts`` straight from snapshots of one row per file, without a shuffle; works on streams."""
    return _alerts(feeds.first_raw_alerts(feed, routes))


def _alerts(first: DataFrame) -> DataFrame:
    return first.select(
        "alert_id",
        "route_ids",
        "header",
        "description",
        "effect",
        times.from_epoch("start_time").alias("start_time"),
        times.from_epoch("end_time").alias("end_time"),
        "source_file",
        F.col("event_time").cast("timestamp").alias("event_time"),
        classify.effect_label("effect").alias("severity"),
        text.prefix("description").alias("description_short"),
        times.window_floor("event_time").alias("window_start"),
    )


def clean_positions(raw: DataFrame, per_visit: bool = False) -> DataFrame:
    return with_headway(raw, per_visit=per_visit).select(
        "vehicle_id",
        "trip_id",
        "route_id",
        "stop_id",
        "current_stop_sequence",
        "current_status",
        "occupancy_status",
        times.from_epoch("mta_timestamp").alias("mta_timestamp"),
        "source_file",
        F.col("event_time").cast("timestamp").alias("event_time"),
        "headway_gap_sec",
        "headway_status",
        times.window_floor("event_time").alias("window_start"),
    )


def clean_weather(raw: DataFrame, source_tz: str | None = None) -> DataFrame:
    """``source_tz`` is the zone the response states its hours in.

    None labels those hours as UTC without a shift, which is what the results to match do;
    with a zone the hours become true UTC.
    """
    parsed = raw.withColumn("weather_timestamp", times.parse_local("weather_timestamp"))
    return _weather(keep_first(parsed, WEATHER_KEY), source_tz)


def snapshot_weather(responses: DataFrame, source_tz: str | None = None) -> DataFrame:
    """``clean_weather`` straight from responses of one row per file, without a shuffle; works on streams."""
    raw = first_raw_weather(responses)
    return _weather(raw.withColumn("weather_timestamp", times.parse_local("weather_timestamp")), source_tz)


def _weather(first: DataFrame, source_tz: str | None) -> DataFrame:
    return first.select(
        "temperature_c",
        "humidity_pct",
        "precip_mm",
        "snowfall_cm",
        "wind_speed_kmh",
        "weather_timestamp",
        "source_file",
        F.col("event_time").cast("timestamp").alias("event_time"),
        times.window_floor("event_time").alias("window_start"),
        times.hour_floor(times.local_to_instant("weather_timestamp", source_tz)).alias("obs_hour"),
        classify.is_extreme_heat("temperature_c").alias("is_extreme_heat"),
        classify.is_positive("precip_mm").alias("is_precip"),
        classify.is_positive("snowfall_cm").alias("is_snow"),
    )
