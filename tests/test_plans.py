"""The physical plans keep the properties that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from railgauge import schemas
from railgauge.operators import dedup, filters, headway
from railgauge.plans import marts, processing, staging
from railgauge.registry import views
from railgauge.registry.queries import QUERIES

STREAMS = [name for name in QUERIES if name.startswith("stream_")]
WRITERS = ["landed_feed_scan", "landed_json_scan", "seed_scan", "roundtrip_write_validate", "overwrite_features", "materialize_view_table", "source_catalog"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STREAMS) - set(WRITERS)))
def test_no_python_no_cross_join_no_global_window(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
    assert not re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_copies_are_reduced_before_the_shuffle(spark, sf_dir):
    plan = plan_of(dedup.earliest_delay(views.raw_delays(spark, sf_dir)))
    below_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_shuffle


def test_headway_shuffles_full_rows_once(spark, sf_dir):
    """One exchange carries the whole row; the other uses of it are the same exchange again."""
    df = processing.clean_positions(views.raw_positions(spark, sf_dir))
    df.collect()
    plan = plan_of(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    assert plan.count("FileScan") == 1


def test_headway_never_groups_rows_by_place_alone(spark, sf_dir):
    plan = plan_of(headway.headway_gaps(views.raw_positions(spark, sf_dir), ["feed_seq"]))
    for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan):
        assert "_day" in keys or "_at" in keys or "mta_timestamp" in keys or "_id" in keys


def test_as_of_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([], schemas.ALERTS).write.parquet(str(tmp_path / "a"))
    alerts = spark.read.parquet(str(tmp_path / "a"))
    for status, expected in (("ongoing", "IsNull(end_time)"), ("upcoming", "GreaterThan(start_time,2024-01-20")):
        plan = plan_of(filters.with_status(alerts, [status], views.AS_OF))
        assert expected in re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)


def test_features_read_few_columns(spark, tmp_path):
    """Description texts, the widest columns, are not read for the features or the fact."""
    frames = {}
    for name, schema in (
        ("delays", schemas.DELAYS),
        ("alerts", schemas.ALERTS),
        ("weather", schemas.WEATHER),
        ("positions", schemas.POSITIONS),
    ):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    features = marts.combined_features(**frames)
    stops = spark.createDataFrame([], schemas.STOPS)
    fact = marts.fct_performance(
        staging.stg_delays(frames["delays"], stops),
        staging.stg_alerts(frames["alerts"]),
        staging.stg_positions(frames["positions"]),
        staging.stg_weather(frames["weather"]),
    )
    for df in (features, fact):
        read = " ".join(re.findall(r"ReadSchema: (\S+)", plan_of(df)))
        assert "arrival_delay" in read and "..." not in read
        assert "description" not in read and "occupancy_status" not in read


def test_routes_and_caps_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([], schemas.POSITIONS).write.parquet(str(tmp_path / "p"))
    plan = plan_of(staging.stg_positions(spark.read.parquet(str(tmp_path / "p"))))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "In(route_id, [J,Z])" in pushed and "headway_gap_sec" in pushed


def test_no_forced_broadcast(spark, sf_dir):
    """With broadcasting off by size, every join still runs: nothing is broadcast regardless."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["fct_performance"](spark, sf_dir)
        rows = df.count()
        assert "Broadcast" not in plan_of(df)
        assert rows == df.select(F.count_distinct("route_id", "window_start")).first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
