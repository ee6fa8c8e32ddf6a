"""The fact and the weather dimension kept up run by run: only the dates that new rows touch are built again.

A run of a processed table is noted after it is saved: the window dates it touches, the newest row per alert
and route, the latest observation per hour, and which vehicle dates the positions of a window date lie in. ``refresh``
then builds the noted dates of the fact and the dimension from those tables and from the date folders of delays
and positions, and replaces them. It reads neither other dates nor the history of alerts and weather polls.

    <state>/alerts, <state>/weather   newest rows per key (``latest``)
    <state>/changes                   notes per run, and which of them are done (``refresh``)
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators.filters import on_routes
from ..sources.tables import TABLES, default_stops, processed_paths, read_processed
from ..streaming.windows import between_dates, read_windows, replace_dates, window_date
from . import latest, marts, refresh, staging

FACT, DIMENSION = "fct_performance", "dim_weather_conditions"


def note_run(spark: SparkSession, state: str, name: str, run_id: str, rows: DataFrame) -> set[date]:
    """Note a saved run of the processed table ``name``; returns the window dates that it touches.

    The dates are noted before the rows are merged, and a repeated run adds to its own note, so a run that is noted
    again after a failure loses no date. A file lies whole in one run, as in ``refresh``.
    """
    changes = f"{state}/changes"
    dates = latest.moved_windows(rows, f"{state}/alerts") if name == "alerts" else refresh.changed_dates(spark, changes, name, run_id, rows)
    refresh.log_changes(spark, changes, name, run_id, dates | refresh.noted_dates(spark, changes, name, run_id))
    if name == "alerts":
        latest.upsert_alerts(rows, f"{state}/alerts")
    if name == "weather":
        latest.upsert_weather(rows, f"{state}/weather")
    return dates


def fact_of(
    spark: SparkSession, root: str, state: str, dates: set[date], stops: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES
) -> DataFrame:
    """The rows of the fact for some window dates."""
    paths = processed_paths(root)
    delays = read_processed(spark, paths["delays"], TABLES["delays"], dates=dates)
    alerts = latest.latest_alerts(spark, f"{state}/alerts").filter(between_dates("window_start", dates))
    positions = refresh.positions_of(spark, root, f"{state}/changes", dates)
    weather = latest.latest_weather(spark, f"{state}/weather", dates)
    fact = marts.fct_performance(
        staging.stg_delays(on_routes(delays, routes), stops),
        on_routes(alerts, routes),
        staging.stg_positions(positions, routes),
        weather,
    )
    return fact.filter(window_date().isin(*dates))


def dimension_of(spark: SparkSession, state: str, dates: set[date] | None = None) -> DataFrame:
    """The weather dimension from the latest observations."""
    return marts.dim_weather_conditions(latest.latest_weather(spark, f"{state}/weather", dates))


def refresh_marts(
    spark: SparkSession, root: str, state: str, marts_root: str, stops: DataFrame | None = None, routes: Sequence[str] | None = fv.DEFAULT_ROUTES
) -> set[date]:
    """Build the noted dates of both tables again. Safe to repeat at any point."""
    dates, notes = refresh.pending(spark, f"{state}/changes")
    if dates:
        stops = default_stops(spark) if stops is None else stops
        dimension = dimension_of(spark, state, dates).withColumn("window_start", F.col("obs_hour"))
        replace_dates(dimension, f"{marts_root}/{DIMENSION}", dates)
        replace_dates(fact_of(spark, root, state, dates, stops, routes), f"{marts_root}/{FACT}", dates)
        refresh.mark_done(spark, f"{state}/changes", notes)
    return dates


def read_fact(spark: SparkSession, marts_root: str) -> DataFrame:
    return read_windows(spark, f"{marts_root}/{FACT}")


def read_dimension(spark: SparkSession, marts_root: str) -> DataFrame:
    return read_windows(spark, f"{marts_root}/{DIMENSION}").drop("window_start")
