"""Flattening of nested snapshots, weather shapes, seeds, catalog, discovery, writers."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from railgauge import schemas
from railgauge.plans import processing
from railgauge.sources import feeds, sinks, tables
from railgauge.sources import weather as weather_source

HEADER = {"timestamp": 1_700_000_000}


def trip_entity(entity_id, route, updates):
    return {"id": entity_id, "trip_update": {"trip": {"trip_id": "t1", "route_id": route}, "stop_time_update": updates}}


ENTITIES = [
    trip_entity(
        "v1",
        "J",
        [
            {"stop_id": "A", "arrival": {"delay": 61}, "departure": None},
            {"stop_id": "B", "arrival": {"delay": None}, "departure": {"delay": 7}},
            {"stop_id": "C", "arrival": None, "departure": None},
        ],
    ),
    trip_entity("v2", "Q", [{"stop_id": "A", "arrival": {"delay": 1}}]),
    {"id": "v3", "vehicle": {"trip": {"trip_id": "t3", "route_id": "Z"}, "stop_id": "A", "timestamp": 1_699_999_000}},
    {"id": "v4", "vehicle": {"trip": {"route_id": "J"}}},
    {
        "id": "a1",
        "alert": {
            "informed_entity": [{"route_id": "Z"}, {"route_id": "J"}, {"route_id": "Z"}, {"route_id": "Q"}, {}],
            "header_text": {"translation": [{"text": "first"}, {"text": "second"}]},
            "effect": 4,
            "active_period": [{"end": 1_700_003_600}, {"start": 5}],
        },
    },
    {"id": "a2", "alert": {"informed_entity": [{"route_id": "Q"}], "effect": 1}},
    {"id": "a3", "alert": {"informed_entity": [{"route_id": "J"}]}},
]


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feed") / "2024" / "deep"
    folder.mkdir(parents=True)
    (folder / "snap_1.json").write_text(json.dumps({"header": HEADER, "entity": ENTITIES}))
    (folder / "snap_2.json").write_text(json.dumps({"header": HEADER, "entity": []}))
    return feeds.read_feed(spark, str(folder.parents[1]), "json", "*.json")


def test_lineage_and_recursion(feed):
    names = {row.source_file.rsplit("/", 1)[1] for row in feed.select("source_file").collect()}
    assert names == {"snap_1.json", "snap_2.json"}


def test_delays_from_snapshots(feed):
    rows = feeds.load_raw_delays(feed).orderBy("feed_seq").collect()
    assert [(r.vehicle_id, r.stop_id, r.arrival_delay, r.departure_delay) for r in rows] == [
        ("v1", "A", 61, None),
        ("v1", "B", 0, 7),
        ("v1", "C", None, None),
    ]
    assert rows[0].event_time == datetime(2023, 11, 14, 22, 13, 20)
    assert {r.route_id for r in feeds.load_raw_delays(feed, None).collect()} == {"J", "Q"}


def test_positions_from_snapshots(feed):
    rows = feeds.load_raw_positions(feed).orderBy("feed_seq").collect()
    assert [(r.vehicle_id, r.trip_id, r.route_id, r.stop_id, r.mta_timestamp, r.occupancy_status) for r in rows] == [
        ("v3", "t3", "Z", "A", 1_699_999_000, None),
        ("v4", "", "J", "", 0, None),
    ]


def test_alerts_from_snapshots(feed):
    first, third = feeds.load_raw_alerts(feed).orderBy("feed_seq").collect()
    assert (first.alert_id, first.route_ids, first.header, first.description) == ("a1", ["J", "Z"], "first", "")
    assert (first.effect, first.start_time, first.end_time) == (4, 0, 1_700_003_600)
    assert (third.alert_id, third.header, third.start_time, third.end_time, third.effect) == ("a3", "", None, None, 8)


@pytest.mark.parametrize(
    ("load", "payload", "others"),
    [
        (feeds.load_raw_delays, "trip_update:", ("vehicle:", "alert:")),
        (feeds.load_raw_positions, "vehicle:", ("trip_update:", "alert:")),
        (feeds.load_raw_alerts, "alert:", ("vehicle:", "trip_update:")),
    ],
)
def test_flattening_reads_only_its_payload(spark, feed, tmp_path, load, payload, others):
    path = sinks.land_snapshots(feed, str(tmp_path))
    plan = load(feeds.read_feed(spark, path))._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema")[1]
    assert payload in read and "..." not in read
    assert not any(other in read for other in others)


def test_landed_snapshots_never_change(feed, tmp_path):
    sinks.land_snapshots(feed, str(tmp_path), "20240101_000000")
    with pytest.raises(Exception, match="already exists"):
        sinks.land_snapshots(feed, str(tmp_path), "20240101_000000")


CURRENT = {
    "current": {
        "time": "2026-06-10T11:45",
        "interval": 900,
        "temperature_2m": 27.1,
        "relative_humidity_2m": 59,
        "precipitation": 0.0,
        "snowfall": 0.0,
        "wind_speed_10m": 14.8,
    }
}
HOURLY = {
    "hourly": {
        "time": ["2026-06-10T00:00", "2026-06-10T01:00"],
        "temperature_2m": [20.0, None],
        "relative_humidity_2m": [50, 51],
        "precipitation": [0.0, 1.5],
        "snowfall": [0.0, 0.0],
        "wind_speed_10m": [5.0, 6.0, 7.0],
    },
    **CURRENT,
}


@pytest.mark.parametrize("indent", [None, 2])
def test_weather_shapes(spark, tmp_path, indent):
    (tmp_path / "weather_20260610_155719.json").write_text(json.dumps(CURRENT))
    (tmp_path / "weather_20260610_160000.json").write_text(json.dumps(HOURLY, indent=indent))
    raw = weather_source.load_raw_weather(weather_source.read_weather(spark, str(tmp_path), multi_line=indent is not None))
    rows = raw.orderBy("event_time", "feed_seq").collect()
    assert [(r.weather_timestamp, r.temperature_c, r.precip_mm) for r in rows] == [
        ("2026-06-10T11:45", 27.1, 0.0),
        ("2026-06-10T00:00", 20.0, 0.0),
        ("2026-06-10T01:00", None, 1.5),
    ]
    assert rows[0].event_time == datetime(2026, 6, 10, 15, 57, 19)

    clean = processing.clean_weather(raw).orderBy("event_time", "weather_timestamp").collect()
    assert clean[0].obs_hour == datetime(2026, 6, 10, 11)
    assert (clean[0].is_extreme_heat, clean[0].is_precip, clean[0].is_snow) == (False, False, False)
    assert (clean[2].is_extreme_heat, clean[2].is_precip) == (False, True)
    local = processing.clean_weather(raw, "America/New_York").orderBy("event_time", "weather_timestamp").collect()
    assert local[0].obs_hour == datetime(2026, 6, 10, 15)


def test_default_stops(spark):
    stops = tables.default_stops(spark)
    assert stops.count() == stops.select("stop_id").distinct().count() == 64
    assert {row.line: row["count"] for row in stops.groupBy("line").count().collect()} == {"J": 34, "J/Z": 30}
    assert {row.direction: row["count"] for row in stops.groupBy("direction").count().collect()} == {
        "Northbound": 32,
        "Southbound": 32,
    }


def delay_rows(spark, days, per_day=3):
    rows = [
        (f"v{i}", "t", "J", "A", 10 * i, 0, "f", datetime(2024, 1, day, 12, i), "on_time", datetime(2024, 1, day, 12))
        for day in days
        for i in range(per_day)
    ]
    return spark.createDataFrame(rows, schemas.DELAYS)


def test_runs_add_up_and_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "delays")
    sinks.save_processed(delay_rows(spark, [1, 2]), path, "a")
    sinks.save_processed(delay_rows(spark, [2]), path, "b")
    assert tables.read_processed(spark, path, schemas.DELAYS).count() == 9
    sinks.save_processed(delay_rows(spark, [2]), path, "b")
    back = tables.read_processed(spark, path, schemas.DELAYS)
    assert back.count() == 9
    assert back.columns == delay_rows(spark, [1]).columns


def test_date_pruning(spark, tmp_path):
    path = str(tmp_path / "delays")
    sinks.save_processed(delay_rows(spark, [1, 2, 3]), path)
    one = tables.read_processed(spark, path, schemas.DELAYS, since=date(2024, 1, 2), until="2024-01-02")
    assert one.count() == 3
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_failed_validation_leaves_nothing(spark, tmp_path, monkeypatch):
    path = tmp_path / "delays"

    def wrong(session, run_path, expected, written):
        raise sinks.WriteValidationError("made to fail")

    monkeypatch.setattr(sinks, "validate_count", wrong)
    with pytest.raises(sinks.WriteValidationError):
        sinks.save_processed(delay_rows(spark, [1]), str(path), "bad")
    assert not (path / "run_id=bad").exists()


def test_count_mismatch_is_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    df = delay_rows(spark, [1])
    df.write.parquet(path)
    sinks.validate_count(spark, path, 3, df)
    with pytest.raises(sinks.WriteValidationError):
        sinks.validate_count(spark, path, 4, df)


def test_table_without_files_is_empty(spark, tmp_path):
    catalog = tables.open_catalog(spark, str(tmp_path))
    assert {name: table.count() for name, table in catalog.items()} == dict.fromkeys(tables.TABLES, 0)
    assert spark.table("delays").columns == delay_rows(spark, [1]).columns


def test_folders_without_files_are_empty(spark, tmp_path):
    missing = str(tmp_path / "nothing")
    assert feeds.load_raw_delays(feeds.read_feed(spark, missing)).isEmpty()
    assert weather_source.load_raw_weather(weather_source.read_weather(spark, missing)).isEmpty()


def test_new_files(spark, tmp_path):
    for name in ("a.json", "b.json", "c.txt"):
        (tmp_path / name).write_text("{}")
    listing = tables.list_files(spark, str(tmp_path), "*.json")
    assert listing.count() == 2
    seen = listing.filter(F.col("source_file").endswith("a.json")).withColumn("again", F.explode(F.array(F.lit(1), F.lit(2))))
    fresh = [row.source_file.rsplit("/", 1)[1] for row in tables.new_files(listing, seen).collect()]
    assert fresh == ["b.json"]


def test_views_and_tables(spark, tmp_path):
    df = delay_rows(spark, [1])
    assert sinks.materialize_view(df, "some_view").count() == 3
    assert sinks.materialize_table(df, "some_table", str(tmp_path / "t")).count() == 3
    assert sinks.materialize_table(df.limit(2), "some_table", str(tmp_path / "t")).count() == 2
    assert spark.read.parquet(sinks.save_features(df, str(tmp_path / "f"))).count() == 3


def test_unreadable_feed_files_stop_the_read_or_are_counted(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/good.json").write_text('{"header": {"timestamp": 5}, "entity": []}\n')
    (tmp_path / "a/cut.json").write_text('{"header": {"timestamp": 5}, "entity": [\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|FAILFAST"):
        feeds.read_feed(spark, str(tmp_path), "json").collect()
    counted = feeds.corrupt_lines(spark, str(tmp_path)).collect()
    assert {(r.source_file.rsplit("/", 1)[1], r.lines, r.corrupt) for r in counted} == {("good.json", 1, 0), ("cut.json", 1, 1)}
