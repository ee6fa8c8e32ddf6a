"""All stages from landed snapshots to marts."""

import pytest

from railgauge.operators import quality
from railgauge.plans import reports, warehouse
from railgauge.registry import views
from railgauge.sources import feeds, sinks

from compare import spark_rows


@pytest.fixture(scope="module")
def snapshots(spark, sf_dir, tmp_path_factory):
    landing = str(tmp_path_factory.mktemp("landing"))
    feed = feeds.read_feed(spark, sinks.land_snapshots(views.feed(spark, sf_dir), landing))
    return warehouse.Snapshots(feed, feed, feed, views.weather_responses(spark, sf_dir))


def build(spark, snapshots, root, run_id, sf_dir):
    return warehouse.run_all(
        spark,
        snapshots,
        root,
        routes=views.ROUTES,
        stops=views.stops(spark, sf_dir),
        run_id=run_id,
        as_of=views.AS_OF,
    )


def test_second_run_changes_nothing_downstream(spark, snapshots, sf_dir, tmp_path):
    """Every run reads all snapshots again: processed tables double, marts and features stay."""
    names = ("fct_performance", "dim_weather_conditions", "dim_alerts_active", "combined_features")

    def rows(tables):
        return {name: spark_rows(tables[name].drop("dbt_updated_at")) for name in names}

    tables = build(spark, snapshots, str(tmp_path), "one", sf_dir)
    first, delays = rows(tables), tables["delays"].count()
    tables = build(spark, snapshots, str(tmp_path), "two", sf_dir)
    assert tables["delays"].count() == 2 * delays > 0
    assert rows(tables) == first

    failures = quality.check_all(tables, quality.standard_expectations(views.ROUTES))
    assert failures.count() == 29
    assert failures.filter("failures > 0").count() == 0

    fact = tables["fct_performance"]
    assert fact.columns[:4] == ["route_id", "window_start", "worst_stop_name", "worst_stop_id"]
    assert len(fact.columns) == 28
    assert reports.preview(fact, 3).count() == 3


def test_default_routes_find_nothing_here(spark, snapshots, tmp_path):
    tables = warehouse.run_all(spark, snapshots, str(tmp_path), run_id="empty")
    counts = {name: tables[name].count() for name in ("delays", "alerts", "vehicle_positions", "fct_performance")}
    assert counts == dict.fromkeys(counts, 0)
