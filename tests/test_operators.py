"""Deduplication, headway, aggregation, joins, checks against brute force on small rows."""

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from railgauge import schemas
from railgauge.operators import aggregates, dedup, filters, headway, joins, quality

T0 = datetime(2024, 1, 1)


def test_keep_first_follows_input_order(spark):
    rows = [("a", "f1", 2, "later"), ("a", "f1", 1, "first"), ("a", "f2", 9, "other file"), (None, "f1", 3, "null key")]
    df = spark.createDataFrame(rows, "alert_id string, source_file string, feed_seq bigint, v string")
    kept = {(r.alert_id, r.source_file): r.v for r in dedup.keep_first(df, dedup.ALERT_KEY).collect()}
    assert kept == {("a", "f1"): "first", ("a", "f2"): "other file", (None, "f1"): "null key"}


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert sorted(r.v for r in dedup.top1(df, ["k"], [F.desc("v")]).collect()) == [2, 3]


def test_soonest_and_longest(spark):
    rows = [
        ("J", "h", T0, None),
        ("J", "h", T0, T0 + timedelta(days=1)),
        ("J", "h", T0 - timedelta(days=1), T0),
        ("J", "none", None, None),
    ]
    df = spark.createDataFrame(rows, "route_id string, header string, start_time timestamp, end_time timestamp")
    soonest = {r.header: (r.start_time, r.end_time) for r in dedup.soonest(df).collect()}
    assert soonest == {"h": (T0 - timedelta(days=1), T0), "none": (None, None)}
    longest = {r.header: r.start_time for r in dedup.longest_running(df).collect()}
    assert longest == {"h": T0 - timedelta(days=1), "none": None}


def brute_force_gaps(rows, cap):
    """rows: (vehicle, trip, route, stop, second), unique by vehicle, trip, stop, second."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2], row[3]].append(row)
    gaps = {}
    for members in groups.values():
        members.sort(key=lambda r: (r[4], r[0], r[1]))
        for before, row in zip([None, *members], members):
            gap = None if before is None else row[4] - before[4]
            gaps[row] = None if gap is None or (cap is not None and gap > cap) else float(gap)
    return gaps


def position_frame(spark, rows):
    full = [(v, t, r, s, 1, 2, None, at, "f", T0 + timedelta(seconds=i), i) for i, (v, t, r, s, at) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.RAW_POSITIONS)


def spark_gaps(df):
    return {
        (r.vehicle_id, r.trip_id, r.route_id, r.stop_id, r.mta_timestamp): r.headway_gap_sec for r in df.collect()
    }


DAY = 86_400
SECONDS = st.one_of(
    st.integers(0, 3),
    st.integers(DAY - 3, DAY + 3),
    st.integers(DAY - 1801, DAY - 1798),
    st.integers(DAY + 1797, DAY + 1802),
    st.integers(0, 5 * DAY),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["v1", "v2", "v3"]),
            st.sampled_from(["t1", "t2"]),
            st.sampled_from(["J", "Z"]),
            st.sampled_from(["A", "B"]),
            SECONDS,
        ),
        min_size=1,
        max_size=40,
        unique_by=lambda r: (r[0], r[1], r[3], r[4]),
    )
)
def test_gaps_match_brute_force(spark, rows):
    df = position_frame(spark, rows)
    for cap in (1800, None, 2 * DAY):
        expected = brute_force_gaps(rows, cap)
        assert spark_gaps(headway.headway_gaps(df, cap=cap)) == expected
        assert spark_gaps(headway.deduplicated_gaps(df, cap=cap)) == expected


def test_gaps_of_copies_and_missing_times(spark):
    """Copies leave one row; vehicles without a time all state second zero; null times have no gap."""
    rows = [("v1", "t", "J", "A", 100), ("v1", "t", "J", "A", 100), ("v2", "t", "J", "A", 130), ("v3", "t", "J", "A", None)]
    rows += [(f"w{i}", "t", "Z", "A", 0) for i in range(50)]
    found = spark_gaps(headway.deduplicated_gaps(position_frame(spark, rows)))
    assert found["v1", "t", "J", "A", 100] is None
    assert found["v2", "t", "J", "A", 130] == 30.0
    assert found["v3", "t", "J", "A", None] is None
    zeros = [gap for key, gap in found.items() if key[2] == "Z"]
    assert len(zeros) == 50 and zeros.count(0.0) == 49 and zeros.count(None) == 1


def test_null_identity_parts(spark):
    rows = [(None, "t", "J", "A", 10), (None, "t", "J", "A", 10), ("v", None, "J", "A", 40), (None, None, "J", None, 70)]
    found = spark_gaps(headway.deduplicated_gaps(position_frame(spark, rows)))
    assert found == {
        (None, "t", "J", "A", 10): None,
        ("v", None, "J", "A", 40): 30.0,
        (None, None, "J", None, 70): None,
    }


def test_per_visit(spark):
    rows = [("v1", "t1", "J", "A", 0), ("v1", "t1", "J", "A", 20), ("v2", "t2", "J", "A", 300)]
    found = spark_gaps(headway.deduplicated_gaps(position_frame(spark, rows), per_visit=True))
    assert found == {("v1", "t1", "J", "A", 0): None, ("v2", "t2", "J", "A", 300): 300.0}


@pytest.fixture
def delays(spark):
    rows = [
        ("J", T0, "A", "Alpha", 700, "severe"),
        ("J", T0, "B", "Beta", 700, "severe"),
        ("J", T0, "A", "Alpha", 10, "on_time"),
        ("J", T0, "C", None, 400, "moderate"),
        ("Z", T0, "A", "Alpha", None, "on_time"),
    ]
    schema = "route_id string, window_start timestamp, stop_id string, stop_name string, arrival_delay int, delay_severity string"
    return spark.createDataFrame(rows, schema)


def test_delay_profile(delays):
    rows = {r.route_id: r for r in aggregates.delay_profile(delays).collect()}
    j, z = rows["J"], rows["Z"]
    assert (j.avg_delay_sec, j.max_delay_sec, j.delay_records, j.pct_delayed) == (1810 / 4, 700, 4, 75.0)
    assert (j.severe_count, j.moderate_count, j.minor_count, j.on_time_count) == (2, 1, 0, 1)
    assert (j.worst_stop_id, j.worst_stop_name) == ("B", "Beta")
    assert (z.avg_delay_sec, z.max_delay_sec, z.worst_stop_id, z.pct_delayed) == (None, None, None, 0.0)


def test_profile_agrees_with_its_parts(delays):
    profile = {r.route_id: r.asDict() for r in aggregates.delay_profile(delays).collect()}
    for part in (aggregates.delays_by_window, aggregates.severity_counts, aggregates.worst_stop):
        for row in part(delays).collect():
            assert row.asDict().items() <= profile[row.route_id].items()


def test_alert_profile(spark):
    rows = [
        ("J", T0, "a1", "late", "detour"),
        ("J", T0, "a2", "late", "stop_moved"),
        ("J", T0, "a3", "early", "no_service"),
        ("Z", T0, "a1", None, "detour"),
    ]
    alerts = spark.createDataFrame(
        rows, "route_id string, window_start timestamp, alert_id string, header string, severity string"
    )
    found = {r.route_id: (r.alerts_active, r.worst_severity, r.alert_headers) for r in aggregates.alert_profile(alerts).collect()}
    assert found == {"J": (3, "stop_moved", "early | late"), "Z": (1, "detour", None)}
    assert {r.route_id: r.alert_headers for r in aggregates.alert_headers(alerts).collect()} == {"J": "early | late", "Z": None}
    counts = aggregates.alert_count_by_window(alerts.unionAll(alerts))
    assert {r.route_id: r.alerts_active for r in counts.collect()} == {"J": 3, "Z": 1}


def test_unnest_drops_alerts_without_routes(spark):
    alerts = spark.createDataFrame([(None, 1), ([], 2), (["J", "Z"], 3)], "route_ids array<string>, id int")
    assert sorted((r.route_id, r.id) for r in filters.unnest_routes(alerts).collect()) == [("J", 3), ("Z", 3)]
    assert [(r.route_id, r.id) for r in filters.unnest_routes(alerts, ["Z"]).collect()] == [("Z", 3)]


def test_all_null_filter(spark):
    df = spark.createDataFrame([(None, None), (None, 5), (5, None)], "arrival_delay int, departure_delay int")
    assert filters.any_present(df, ["arrival_delay", "departure_delay"]).count() == 2


def test_stop_join_never_adds_rows(spark):
    stops = spark.createDataFrame([("A", "Alpha", "J", "N"), ("A", "Alpha 2", "J", "S")], schemas.STOPS)
    delays = spark.createDataFrame([("A",), ("B",)], "stop_id string")
    assert sorted((r.stop_id, r.stop_name) for r in joins.join_stops(delays, stops).collect()) == [("A", "Alpha"), ("B", None)]


def test_windows_without_delays_disappear(spark):
    def frame(rows, extra):
        return spark.createDataFrame(rows, f"window_start timestamp, route_id string, {extra}")

    base = frame([(T0 + timedelta(minutes=15), "J", 1)], "n int")
    alerts = frame([(T0, "J", 3)], "alerts_active bigint")
    positions = frame([(T0 + timedelta(minutes=15), "J", 9.0)], "gap double")
    weather = spark.createDataFrame([(T0, 20.0)], "obs_hour timestamp, temperature_c double")
    rows = joins.star_join(base, alerts, positions, weather).collect()
    assert [(r.n, r.alerts_active, r.gap, r.temperature_c) for r in rows] == [(1, 0, 9.0, 20.0)]


def test_seeded_failures(spark):
    rows = [("J", "on_time", T0), ("Q", "on_time", T0), (None, "odd", None)]
    df = spark.createDataFrame(rows, "route_id string, delay_severity string, obs_hour timestamp")
    expected = quality.Expectations(
        not_null=("route_id", "delay_severity"),
        accepted={"route_id": ["J", "Z"], "delay_severity": ["on_time"]},
        unique=("obs_hour",),
    )
    found = {(r.column_name, r.check_name): r.failures for r in quality.check_table(df, "m", expected).collect()}
    assert found == {
        ("route_id", "not_null"): 1,
        ("delay_severity", "not_null"): 0,
        ("route_id", "accepted_values"): 1,
        ("delay_severity", "accepted_values"): 1,
        ("obs_hour", "unique"): 1,
    }


def test_there_are_29_standard_checks():
    standard = quality.standard_expectations().values()
    assert sum(len(e.not_null) for e in standard) == 22
    assert sum(len(e.accepted) for e in standard) == 6
    assert sum(len(e.unique) for e in standard) == 1


def test_metrics(spark):
    raw = spark.createDataFrame([(1,), (2,)], "x int")
    assert quality.delay_metrics(raw, raw.limit(1)).first().asDict() == {"raw_records": 2, "clean_records": 1}
    weather = spark.createDataFrame([(0.0,), (0.1,), (None,)], "precip_mm double")
    assert quality.weather_metrics(weather).first().asDict() == {"hourly_records": 3, "wet_hours": 1}
