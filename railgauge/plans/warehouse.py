"""All stages in order: snapshots, processed tables, features, staging, marts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators.filters import on_routes
from ..sources import feeds, sinks, versions
from ..sources.tables import default_stops, open_catalog, processed_paths, vehicle_date
from ..sources.weather import load_raw_weather
from . import marts, processing, staging


@dataclass(frozen=True)
class Snapshots:
    """Landed input. The three transit feeds may be one and the same frame."""

    trip_updates: DataFrame
    alerts: DataFrame
    vehicle_positions: DataFrame
    weather: DataFrame


def process(
    snapshots: Snapshots,
    root: str,
    routes: Sequence[str] | None = fv.DEFAULT_ROUTES,
    run_id: str | None = None,
    source_tz: str | None = None,
) -> dict[str, str]:
    """Flatten, clean and add one run to each processed table.

    Delays, alerts and weather are deduplicated within a file. Where each file is one row, that is done inside the
    row, without a shuffle; where some file has several, rows of the whole input meet by key.
    """

    def whole(frame: DataFrame) -> bool:
        return feeds.split_files(frame).isEmpty()

    def clean_delays(feed: DataFrame) -> DataFrame:
        return processing.snapshot_delays(feed, routes) if whole(feed) else processing.clean_delays(feeds.load_raw_delays(feed, routes))

    def clean_alerts(feed: DataFrame) -> DataFrame:
        return processing.snapshot_alerts(feed, routes) if whole(feed) else processing.clean_alerts(feeds.load_raw_alerts(feed, routes))

    def clean_weather(responses: DataFrame) -> DataFrame:
        if whole(responses):
            return processing.snapshot_weather(responses, source_tz)
        return processing.clean_weather(load_raw_weather(responses), source_tz)

    cleaned = {
        "delays": clean_delays(snapshots.trip_updates),
        "alerts": clean_alerts(snapshots.alerts),
        "vehicle_positions": processing.clean_positions(feeds.load_raw_positions(snapshots.vehicle_positions, routes)),
        "weather": clean_weather(snapshots.weather),
    }
    run_id = run_id or sinks.new_run_id()
    paths = processed_paths(root)
    layout = {"vehicle_positions": vehicle_date(F.col("mta_timestamp"))}
    return {
        name: sinks.save_processed(table, paths[name], run_id, layout.get(name, "event_time"))
        for name, table in cleaned.items()
    }


def staging_views(
    spark: SparkSession,
    catalog: dict[str, DataFrame],
    stops: DataFrame | None = None,
    routes: Sequence[str] | None = fv.DEFAULT_ROUTES,
) -> dict[str, DataFrame]:
    views = {
        "stg_delays": staging.stg_delays(on_routes(catalog["delays"], routes), default_stops(spark) if stops is None else stops),
        "stg_alerts": staging.stg_alerts(catalog["alerts"], routes),
        "stg_positions": staging.stg_positions(catalog["vehicle_positions"], routes),
        "stg_weather": staging.stg_weather(catalog["weather"]),
    }
    return {name: sinks.materialize_view(view, name) for name, view in views.items()}


def build_marts(
    stage: dict[str, DataFrame], root: str, as_of: Column | str | datetime | None = None
) -> dict[str, DataFrame]:
    """The fact and the weather dimension are stored; active alerts stay a view, as they age."""
    fact = marts.fct_performance(
        stage["stg_delays"], stage["stg_alerts"], stage["stg_positions"], stage["stg_weather"]
    )
    weather = marts.dim_weather_conditions(stage["stg_weather"])
    return {
        "fct_performance": sinks.materialize_table(fact, "fct_performance", f"{root}/fct_performance"),
        "dim_weather_conditions": sinks.materialize_table(
            weather, "dim_weather_conditions", f"{root}/dim_weather_conditions"
        ),
        "dim_alerts_active": sinks.materialize_view(
            marts.dim_alerts_active(stage["stg_alerts"], as_of), "dim_alerts_active"
        ),
    }


def run_all(
    spark: SparkSession,
    snapshots: Snapshots,
    root: str,
    routes: Sequence[str] | None = fv.DEFAULT_ROUTES,
    stops: DataFrame | None = None,
    run_id: str | None = None,
    source_tz: str | None = None,
    as_of: Column | str | datetime | None = None,
) -> dict[str, DataFrame]:
    """Every table by name. Each stage reads what the stage before it has written."""
    root = root.rstrip("/")
    process(snapshots, f"{root}/processed", routes, run_id, source_tz)
    catalog = open_catalog(spark, f"{root}/processed")
    features = marts.combined_features(
        catalog["delays"], catalog["alerts"], catalog["weather"], catalog["vehicle_positions"]
    )
    sinks.save_features(features, f"{root}/features/combined")
    stage = staging_views(spark, catalog, stops, routes)
    return {
        **catalog,
        **stage,
        **build_marts(stage, f"{root}/marts", as_of),
        "combined_features": versions.read(spark, f"{root}/features/combined"),
    }
