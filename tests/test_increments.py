"""Tables kept up run by run equal those built from everything; only touched dates are read; snapshots deduplicate in place."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from railgauge import schemas
from railgauge.operators import dedup
from railgauge.plans import increments, latest, marts, processing, refresh, staging, warehouse
from railgauge.registry import views
from railgauge.sources import feeds, sinks, tables, versions
from railgauge.sources import weather as weather_source

from compare import spark_rows

START = datetime(2024, 1, 1)


def same(left, right):
    assert spark_rows(left.select(*sorted(left.columns))) == spark_rows(right.select(*sorted(right.columns)))


def alert(alert_id, day, routes=("J",), header="h", file=None):
    at = START + timedelta(days=day)
    return (alert_id, list(routes), header, "d", 1, at, None, file or f"f{day}", at, "no_service", "d", at)


@pytest.fixture
def noted(spark, tmp_path):
    """Save a run of a processed table and note it."""

    def run(name, number, rows):
        path = tables.processed_paths(f"{tmp_path}/processed")[name]
        time = tables.vehicle_date(F.col("mta_timestamp")) if name == "vehicle_positions" else "event_time"
        folder = sinks.save_processed(rows, path, f"run_{number}", time)
        return increments.note_run(spark, f"{tmp_path}/state", name, f"run_{number}", spark.read.schema(rows.schema).parquet(folder))

    return run


def test_moved_alert_marks_both_windows(spark, tmp_path, noted):
    frame = lambda *rows: spark.createDataFrame(list(rows), schemas.ALERTS)
    days = lambda *numbers: {date(2024, 1, 1) + timedelta(days=n) for n in numbers}
    assert noted("alerts", 0, frame(alert("a", 0), alert("b", 0, ("J", "Z")))) == days(0)
    assert noted("alerts", 1, frame(alert("a", 4))) == days(0, 4)
    # An older poll is noted and changes nothing; the same run again names its dates again.
    assert noted("alerts", 2, frame(alert("a", 2, header="old"))) == days(2, 4)
    assert noted("alerts", 1, frame(alert("a", 4))) == days(4)
    found = {(r.alert_id, r.route_id): r.window_start for r in latest.latest_alerts(spark, f"{tmp_path}/state/alerts").collect()}
    assert found == {("a", "J"): START + timedelta(days=4), ("b", "J"): START, ("b", "Z"): START}
    # What run 1 noted at first is not lost by its repetition.
    pending, _ = refresh.pending(spark, f"{tmp_path}/state/changes")
    assert pending == days(0, 2, 4)


def test_only_touched_dates_are_read(spark, sf_dir, tmp_path, noted):
    built = {"delays": views.delays, "alerts": views.alerts, "vehicle_positions": views.positions, "weather": views.weather}
    late = F.col("event_time") >= "2024-01-20"
    root, state = f"{tmp_path}/processed", f"{tmp_path}/state"
    for name, view in built.items():
        noted(name, 0, view(spark, sf_dir).filter(~late))
    stops = views.stops(spark, sf_dir)
    first = increments.refresh_marts(spark, root, state, f"{tmp_path}/marts", stops, views.ROUTES)
    before = versions.current(spark, f"{tmp_path}/marts/{increments.FACT}")["parts"]
    one_day = (F.col("event_time") >= "2024-01-20") & (F.col("event_time") < "2024-01-21")
    for name in ("delays", "vehicle_positions"):
        noted(name, 1, built[name](spark, sf_dir).filter(one_day))
    touched = increments.refresh_marts(spark, root, state, f"{tmp_path}/marts", stops, views.ROUTES)
    assert touched == {date(2024, 1, 20)} and len(first) > 10
    after = versions.current(spark, f"{tmp_path}/marts/{increments.FACT}")["parts"]
    assert {name for name in after if after[name] != before.get(name)} == {"event_date=2024-01-20"}
    assert increments.refresh_marts(spark, root, state, f"{tmp_path}/marts", stops, views.ROUTES) == set()

    plan = increments.fact_of(spark, root, state, touched, stops, views.ROUTES)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet[^\n]*", plan)
    delays = [s for s in scans if "arrival_delay" in s]
    assert delays and all("event_date" in s and "2024-01-20" in s for s in delays)
    positions = [s for s in scans if "headway_gap_sec" in s]
    assert positions and all(re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*", s) for s in positions)
    weather = [s for s in scans if "temperature_c" in s]
    assert weather and all(s.count("event_date=") <= 1 for s in weather)
    assert not [s for s in scans if "/processed/alerts" in s or "/processed/weather" in s]


def test_increments_equal_everything_at_once(spark, sf_dir, tmp_path, noted):
    """Five runs in random order, one of them twice, marts refreshed now and then."""
    built = {"delays": views.delays, "alerts": views.alerts, "vehicle_positions": views.positions, "weather": views.weather}
    stops, root, state = views.stops(spark, sf_dir), f"{tmp_path}/processed", f"{tmp_path}/state"
    for turn, number in enumerate((3, 0, 2, 0, 1)):
        for name, view in built.items():
            noted(name, number, view(spark, sf_dir).filter(F.pmod(F.hash("source_file"), F.lit(4)) == number))
        if turn % 2 == 0:
            increments.refresh_marts(spark, root, state, f"{tmp_path}/marts", stops, views.ROUTES)
    stage = (
        staging.stg_delays(views.delays(spark, sf_dir), stops),
        staging.stg_alerts(views.alerts(spark, sf_dir), views.ROUTES),
        staging.stg_positions(views.positions(spark, sf_dir), views.ROUTES),
        staging.stg_weather(views.weather(spark, sf_dir)),
    )
    same(increments.read_fact(spark, f"{tmp_path}/marts").drop("dbt_updated_at"), marts.fct_performance(*stage).drop("dbt_updated_at"))
    same(increments.read_dimension(spark, f"{tmp_path}/marts"), marts.dim_weather_conditions(stage[3]))


def test_older_weather_poll_changes_nothing(spark, tmp_path):
    def poll(hour, temperature, polled):
        at = START + timedelta(hours=hour)
        return (temperature, 50.0, 0.0, 0.0, 5.0, at, f"w{polled}", START + timedelta(days=polled), at, at, False, False, False)

    root = f"{tmp_path}/weather"
    for rows in ([poll(0, 1.0, 3), poll(25, 1.0, 3)], [poll(0, 2.0, 1)], [poll(25, 3.0, 4)]):
        latest.upsert_weather(spark.createDataFrame(rows, schemas.WEATHER), root)
    assert sorted((r.obs_hour, r.temperature_c) for r in latest.latest_weather(spark, root).collect()) == [
        (START, 1.0),
        (START + timedelta(hours=25), 3.0),
    ]
    day = latest.latest_weather(spark, root, {date(2024, 1, 2)})
    assert [r.temperature_c for r in day.collect()] == [3.0]


# First per key inside the snapshot


@pytest.mark.parametrize("kind", ["delays", "alerts", "weather"])
def test_snapshots_deduplicate_without_a_shuffle(spark, sf_dir, tmp_path, kind):
    if kind == "weather":
        landed, schema = views.weather_responses(spark, sf_dir), weather_source.STORED_RESPONSE
        narrow, wide = processing.snapshot_weather, lambda f: processing.clean_weather(weather_source.load_raw_weather(f))
    else:
        landed, schema = views.feed_twice(spark, sf_dir), schemas.FEED
        narrow = lambda f: getattr(processing, f"snapshot_{kind}")(f, views.ROUTES)
        wide = lambda f: getattr(processing, f"clean_{kind}")(getattr(feeds, f"load_raw_{kind}")(f, views.ROUTES))
    landed.write.parquet(f"{tmp_path}/in")
    frame = spark.read.schema(schema).parquet(f"{tmp_path}/in")
    plan = narrow(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    read = " ".join(re.findall(r"ReadSchema: (\S+)", plan))
    assert ("stop_time_update" in read) == (kind == "delays") and "vehicle:struct" not in read
    same(narrow(frame), wide(frame))


def test_first_in_array_takes_nulls_as_a_key(spark):
    rows = [([("b", 1), (None, 2), ("a", 3), ("b", 4), (None, 5), ("a", 6)],), ([],), (None,)]
    df = spark.createDataFrame(rows, "xs array<struct<k: string, v: int>>")
    got = [r[0] for r in df.select(dedup.first_in_array(F.col("xs"), lambda x: F.struct(x["k"]))).collect()]
    assert [sorted(map(tuple, x), key=repr) for x in got[:2]] == [[("a", 3), ("b", 1), (None, 2)], []] and got[2] is None


def test_routes_and_missing_parts(spark):
    """Entities without the payload, without updates, on other routes, without ids."""
    row = """named_struct('id', {id}, 'trip_update', named_struct('trip', named_struct('trip_id', 't', 'route_id', {route}),
        'stop_time_update', {updates}), 'vehicle', null, 'alert', null)"""
    update = "array(named_struct('stop_id', null, 'arrival', named_struct('delay', {a}), 'departure', null))"
    entities = [
        row.format(id="'v'", route="'J'", updates=update.format(a="cast(null as int)")),
        row.format(id="'v'", route="'J'", updates=update.format(a="7")),
        row.format(id="null", route="'J'", updates=update.format(a="8")),
        row.format(id="'w'", route="'X'", updates=update.format(a="9")),
        row.format(id="'x'", route="'J'", updates="null"),
        row.format(id="'y'", route="null", updates=update.format(a="5")),
    ]
    made = spark.sql(f"select 's' as source_file, named_struct('timestamp', 60L) as header, array({','.join(entities)}, null) as entity")
    feed = spark.createDataFrame(made.rdd, schemas.FEED)
    for routes in (["J"], None):
        same(processing.snapshot_delays(feed, routes), processing.clean_delays(feeds.load_raw_delays(feed, routes)))
        same(processing.snapshot_alerts(feed, routes), processing.clean_alerts(feeds.load_raw_alerts(feed, routes)))


def test_files_of_several_snapshots_meet_by_key(spark, sf_dir, tmp_path):
    """Where a file has several rows, processing falls back to deduplication across rows."""
    feed = views.feed(spark, sf_dir).limit(40).withColumn("source_file", F.concat(F.lit("s"), F.pmod(F.hash("source_file"), F.lit(5))))
    responses = views.weather_responses(spark, sf_dir).limit(10)
    assert feeds.split_files(feed).count() > 0 and feeds.split_files(responses).isEmpty()
    warehouse.process(warehouse.Snapshots(feed, feed, feed, responses), str(tmp_path), views.ROUTES)
    stored = tables.open_catalog(spark, str(tmp_path))
    same(stored["delays"], processing.clean_delays(feeds.load_raw_delays(feed, views.ROUTES)))
    same(stored["alerts"], processing.clean_alerts(feeds.load_raw_alerts(feed, views.ROUTES)))
    same(stored["weather"], processing.clean_weather(weather_source.load_raw_weather(responses)))
