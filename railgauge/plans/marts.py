"""Fact, dimensions, and the combined features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.times import hours_between, instant
from ..operators import aggregates, dedup, joins
from ..operators.filters import unnest_routes

WEATHER_COLUMNS = (
    "temperature_c",
    "humidity_pct",
    "precip_mm",
    "snowfall_cm",
    "wind_speed_kmh",
    "is_extreme_heat",
    "is_precip",
    "is_snow",
)


def fct_performance(
    stg_delays: DataFrame, stg_alerts: DataFrame, stg_positions: DataFrame, stg_weather: DataFrame
) -> DataFrame:
    """One row per route and 15-minute window that has delay records.

    An alert counts in the window of its newest snapshot only (compare ``combined_features``).
    """
    joined = joins.star_join(
        aggregates.delay_profile(stg_delays),
        aggregates.alert_profile(stg_alerts),
        aggregates.headway_profile(stg_positions),
        stg_weather.select("obs_hour", *WEATHER_COLUMNS),
    )
    return joined.select(
        "route_id",
        "window_start",
        "worst_stop_name",
        "worst_stop_id",
        "avg_delay_sec",
        "max_delay_sec",
        "delay_records",
        "severe_count",
        "moderate_count",
        "minor_count",
        "on_time_count",
        "pct_delayed",
        "alerts_active",
        "worst_severity",
        "alert_headers",
        "avg_headway_gap_sec",
        "max_headway_gap_sec",
        "bunched_count",
        "sparse_count",
        *WEATHER_COLUMNS,
        F.current_timestamp().alias("dbt_updated_at"),
    )


def dim_alerts_active(
    stg_alerts: DataFrame, as_of: Column | str | datetime | None = None, seen_within: str | None = None
) -> DataFrame:
    """Alerts that have not expired, with their status.

    An alert that left the feed without an end stays ongoing; ``seen_within`` (an interval such
    as ``"2 days"``) keeps only alerts whose newest snapshot is that recent.
    """
    now = instant(as_of)
    current = stg_alerts.filter(classify.is_relevant(as_of=now))
    if seen_within is not None:
        current = current.filter(F.col("window_start") >= now - F.expr(f"INTERVAL {seen_within}"))
    return current.select(
        "alert_id",
        "route_id",
        "header",
        "description_short",
        "severity",
        "start_time",
        "end_time",
        classify.alert_status(as_of=now).alias("alert_status"),
        hours_between(now, "start_time").alias("hours_since_start"),
        hours_between("start_time", now).alias("hours_until_start"),
        "window_start",
    )


def dim_weather_conditions(stg_weather: DataFrame) -> DataFrame:
    return stg_weather.select(
        "obs_hour",
        *WEATHER_COLUMNS,
        classify.weather_condition().alias("condition_bucket"),
        classify.feels_like().alias("feels_like_c"),
        classify.wind_category().alias("wind_category"),
    )


def combined_features(
    delays: DataFrame,
    alerts: DataFrame,
    weather: DataFrame,
    positions: DataFrame,
    deduplicate: bool = True,
) -> DataFrame:
    """Route and window features straight from the processed tables.

    An alert counts in every window whose snapshots show it. Processed tables hold the same
    feed row once per run; without ``deduplicate`` each of those copies counts.
    """
    if deduplicate:
        delays = dedup.earliest_delay(delays)
        positions = dedup.latest_position(positions)
    hourly = dedup.latest_weather_snapshot(weather).select("obs_hour", *WEATHER_COLUMNS)
    joined = joins.star_join(
        aggregates.delays_by_window(delays),
        aggregates.alert_count_by_window(unnest_routes(alerts)),
        aggregates.headway_by_window(positions),
        hourly,
    )
    return joined.select(
        "route_id",
        "window_start",
        "avg_delay_sec",
        "max_delay_sec",
        "delay_records",
        "alerts_active",
        "avg_headway_gap_sec",
        "max_headway_gap_sec",
        *WEATHER_COLUMNS,
    )
