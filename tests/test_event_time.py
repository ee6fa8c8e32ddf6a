"""Windows from streaming state with a watermark, gaps by hour, and weather that arrives beside windows."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from railgauge import schemas
from railgauge.operators import aggregates
from railgauge.plans import latest, processing
from railgauge.registry import views
from railgauge.streaming import event_time, headway, live_weather, sinks, windows
from railgauge.sources import tables, versions

from compare import spark_rows

START = datetime(2024, 1, 1)


def same(left, right):
    assert spark_rows(left.select(*sorted(left.columns))) == spark_rows(right.select(*sorted(right.columns)))


def report(number, minutes, route="J"):
    at = None if minutes is None else START + timedelta(minutes=minutes)
    floor = None if minutes is None else START + timedelta(minutes=minutes // 15 * 15)
    return ("v", f"t{number}", route, "A", 60, 60, f"f{number}", at, "on_time", floor)


@pytest.fixture
def kept(spark, tmp_path):
    """Stream batches of reports, one after the other; returns the query's progress of each."""
    writer = event_time.event_time_upserts(*(str(tmp_path / n) for n in ("rows", "windows", "notes")), "1 hour")

    def run(*batches):
        progress = []
        for reports in batches:
            number = len(list(tmp_path.glob("in/*")))
            spark.createDataFrame(reports, schemas.DELAYS).coalesce(1).write.parquet(str(tmp_path / f"in/{number}"))
            stream = spark.readStream.schema(schemas.DELAYS).parquet(str(tmp_path / "in/*"))
            query = sinks.run_stream(event_time.windows_and_rows(stream, "1 hour"), writer, str(tmp_path / "checkpoint"))
            query.awaitTermination()
            progress.append([p for p in query.recentProgress if p["stateOperators"]])
        return progress

    run.table = str(tmp_path / "windows")
    run.rows = str(tmp_path / "rows")
    return run


def counts(spark, kept):
    return {(r.route_id, r.window_start): r.delay_records for r in windows.read_windows(spark, kept.table).collect()}


def test_state_is_dropped_and_late_rows_are_counted(spark, kept):
    progress = kept([report(0, 0), report(1, 1)], [report(2, 600)], [report(3, 5), report(4, 601, "Z")], [report(5, None)])
    removed = sum(p["stateOperators"][0]["numRowsRemoved"] for run in progress for p in run)
    assert removed == 1 and progress[-1][-1]["stateOperators"][0]["numRowsTotal"] == 2
    day = START + timedelta(minutes=600)
    assert counts(spark, kept) == {("J", START): 3, ("J", day): 1, ("Z", day): 1, ("J", None): 1}


def test_rows_on_time_come_from_state_alone(spark, kept, monkeypatch):
    """No stored row is read where nothing is late."""
    monkeypatch.setattr(event_time, "read_processed", lambda *a, **k: pytest.fail("stored rows were read"))
    kept([report(0, 0)], [report(1, 10), report(2, 50)], [report(3, 20), report(4, 70)])
    assert sorted(counts(spark, kept).values()) == [1, 1, 1, 2]


def test_replayed_batch_changes_nothing(spark, kept, tmp_path):
    kept([report(0, 0), report(1, 600)], [report(2, 1), report(3, 601)])
    expected = counts(spark, kept)
    rows = spark.createDataFrame([report(2, 1), report(3, 601)], schemas.DELAYS).select(F.struct("*").alias("row"))
    state = spark.createDataFrame([("J", START + timedelta(minutes=600), 60.0, 60, 2)], event_time.WINDOWS).select(F.struct("*").alias("window"))
    batch = state.withColumn("kind", F.lit("window")).unionByName(rows.withColumn("kind", F.lit("row")), allowMissingColumns=True)
    writer = event_time.event_time_upserts(*(str(tmp_path / n) for n in ("rows", "windows", "notes")), "1 hour")
    # Batches without rows, which only drop state, have numbers too.
    stored = spark.read.schema(f"{schemas.DELAYS.rstrip()}, run_id string").parquet(kept.rows).filter("trip_id = 't2'")
    writer(batch.select("kind", "window", "row"), int(stored.first()["run_id"].split("_")[1]))
    assert counts(spark, kept) == expected


def test_random_order_equals_batch(spark, sf_dir, kept):
    reports = processing.snapshot_delays(views.feed(spark, sf_dir), views.ROUTES)
    parts = [reports.filter(F.pmod(F.hash("source_file"), F.lit(3)) == n).collect() for n in (1, 0, 2)]
    kept(*parts)
    same(windows.read_windows(spark, kept.table), aggregates.delays_by_window(reports))


# Gaps by hour


def position(vehicle, at, stop="A", file="f"):
    seconds = None if at is None else int((at - datetime(1970, 1, 1)).total_seconds())
    return (vehicle, "t", "J", stop, 1, 2, None, seconds, file, START, 0)


def scanned(spark, landing, slots):
    plan = headway.rows_of_slots(spark, landing, slots)._jdf.queryExecution().executedPlan().toString()
    return re.search(r"Location: [^\n]*", plan).group(0), re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)


def test_a_batch_reads_no_hour_further_than_the_cap(spark, tmp_path):
    landing, table = str(tmp_path / "in"), str(tmp_path / "t")
    writer = headway.headway_tables(landing, table)
    times = [START + timedelta(hours=h) for h in range(0, 72)]
    writer(spark.createDataFrame([position(f"v{i}", t) for i, t in enumerate(times)], schemas.RAW_POSITIONS), 0)
    asked, real = [], headway.rows_of_slots

    def spied(spark, landing, slots):
        asked.append(slots)
        return real(spark, landing, slots)

    headway.rows_of_slots = spied
    try:
        writer(spark.createDataFrame([position("late", START + timedelta(hours=30, minutes=20))], schemas.RAW_POSITIONS), 1)
    finally:
        headway.rows_of_slots = real
    day = date(2024, 1, 2)
    assert asked == [{(day, 5), (day, 6), (day, 7)}]
    where, pushed = scanned(spark, landing, asked[0])
    assert "2024-01-02" in where and "2024-01-01" not in where and "2024-01-03" not in where
    low = int((START + timedelta(hours=29) - datetime(1970, 1, 1)).total_seconds())
    assert f"GreaterThanOrEqual(mta_timestamp,{low})" in pushed and f"LessThan(mta_timestamp,{low + 3 * 3600})" in pushed
    names = versions.current(spark, f"{table}/{tables.STREAM_FOLDER}")["parts"]
    first = names["event_date=2024-01-01/event_part=0"]
    assert [n for n, v in sorted(names.items()) if v != first] == ["event_date=2024-01-02/event_part=1"]
    same(headway.read_headways(spark, table), processing.clean_positions(spark.read.parquet(landing).drop("event_date", "batch_id")))


def test_rows_without_time_stay_apart(spark, tmp_path):
    """Batches with such rows at other stops, beside midnight of the first day and over several years."""
    landing, table = str(tmp_path / "in"), str(tmp_path / "t")
    writer = headway.headway_tables(landing, table)
    zero = datetime(1970, 1, 1)
    batches = [
        [position("a", zero, "A"), position("b", None, "B"), position("c", START, "A")],
        [position("d", zero, "A"), position("e", zero + timedelta(hours=23, minutes=50), "A"), position("f", None, "A")],
        [position("g", zero + timedelta(days=1, minutes=5), "A"), position("h", zero - timedelta(minutes=5), "A")],
        [position("i", zero, "C"), position("a", zero, "A", "other file")],
    ]
    versions_of = []
    for number, rows in enumerate(batches):
        writer(spark.createDataFrame(rows, schemas.RAW_POSITIONS), number)
        versions_of.append(versions.current(spark, f"{table}/{tables.STREAM_FOLDER}")["parts"])
        stored = spark.read.schema(f"{schemas.RAW_POSITIONS}, event_date date, batch_id bigint").parquet(landing)
        same(headway.read_headways(spark, table), processing.clean_positions(stored.drop("event_date", "batch_id")))
    assert versions_of[0]["event_date=2024-01-01/event_part=0"] == versions_of[-1]["event_date=2024-01-01/event_part=0"]


def test_slots_reach_over_days():
    day = date(2024, 1, 1)
    assert headway.reached({(day, 23)}, 2) == {(day, 23), (date(2024, 1, 2), 0), (date(2024, 1, 2), 1)}
    assert headway.reached({(day, 0)}, -1) == {(day, 0), (date(2023, 12, 31), 23)}
    assert (tables.NO_DATE, 5) in headway.reached({(date(1970, 1, 2), 0)}, -1)
    assert headway.reached({(tables.NO_DATE, 3)}, 1) == {(tables.NO_DATE, 3), (date(1970, 1, 2), 0)}


# Weather beside windows


def test_weather_that_comes_later_reaches_its_windows(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    write_delays, write_weather = live_weather.live_weather(root, f"{root}/joined")
    raw_delays, raw_weather = views.raw_delays(spark, sf_dir), views.raw_weather(spark, sf_dir)

    def part(df, number):
        return df.filter(F.pmod(F.hash("source_file"), F.lit(3)) == number)

    write_weather(part(raw_weather, 0), 0)
    for number in (2, 1, 0):
        write_delays(part(raw_delays, number), number)
    write_weather(part(raw_weather, 2), 2)
    write_weather(part(raw_weather, 1), 1)
    write_weather(part(raw_weather, 2), 2)
    hourly = latest.latest_weather(spark, f"{root}/weather").select("obs_hour", "temperature_c")
    expected = aggregates.delays_by_window(views.delays(spark, sf_dir))
    joined = windows.read_windows(spark, f"{root}/joined")
    same(joined.drop("temperature_c"), expected)
    same(joined, windows.weather_onto_windows(expected, hourly))
    assert joined.filter("temperature_c is not null").count() > joined.count() // 2
