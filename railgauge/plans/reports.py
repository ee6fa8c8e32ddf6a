"""Reports over the features and the processed alerts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text
from ..functions.times import hours_between, instant
from ..operators import dedup
from ..operators.filters import all_present, any_present, unnest_routes, with_status

AsOf = Column | str | datetime | None


def newest_first(features: DataFrame) -> DataFrame:
    """The full listing; a range-partitioned sort, so for presentation only."""
    return features.orderBy(F.desc("window_start"), F.asc("route_id"))


def latest_row(features: DataFrame) -> DataFrame:
    """The newest window (first route among equals): a top-k, not a sort of everything."""
    return newest_first(features).limit(1)


def latest_status(features: DataFrame) -> DataFrame:
    """Six metrics of the newest window as text. Its window is also the data's freshness."""
    return latest_row(features).select(
        text.minutes_seconds("avg_headway_gap_sec").alias("avg_headway_gap"),
        text.minutes("max_headway_gap_sec").alias("max_headway_gap"),
        text.count_text("delay_records").alias("delay_records"),
        text.count_text("alerts_active").alias("alerts"),
        text.measure("temperature_c", "°C", F.col("is_extreme_heat"), text.HEAT_MARK).alias("temperature"),
        text.measure("precip_mm", "mm", F.col("is_precip"), text.RAIN_MARK).alias("precipitation"),
        text.utc_stamp("window_start").alias("last_run"),
    )


def headway_weather_series(features: DataFrame) -> DataFrame:
    """Headway gap and temperature over time."""
    measures = ["avg_headway_gap_sec", "temperature_c"]
    return any_present(features.select("window_start", "route_id", *measures), measures).orderBy(
        "window_start", "route_id"
    ).drop("route_id")


def recent_headways(features: DataFrame, points: int = 20) -> DataFrame:
    """The last points of the headway series, oldest first."""
    known = all_present(features.select("window_start", "route_id", "avg_headway_gap_sec"), ["avg_headway_gap_sec"])
    latest = known.orderBy(F.desc("window_start"), F.desc("route_id")).limit(points)
    return latest.orderBy("window_start", "route_id").drop("route_id")


def ongoing_disruptions(
    alerts: DataFrame, as_of: AsOf = None, routes: Sequence[str] | None = fv.DEFAULT_ROUTES
) -> DataFrame:
    """Open-ended alerts that have started, one per route and header, longest running first."""
    now = instant(as_of)
    ongoing = unnest_routes(with_status(alerts, ["ongoing"], now), routes)
    hours = dedup.longest_running(ongoing).select(
        "route_id", "header", hours_between(now, "start_time").alias("hours_since_start")
    )
    return hours.select(
        "*",
        text.days_hours("hours_since_start").alias("duration"),
        text.title("header").alias("title"),
    ).orderBy(F.desc_nulls_last("hours_since_start"), "route_id", "header")


def upcoming_work(
    alerts: DataFrame, as_of: AsOf = None, routes: Sequence[str] | None = fv.DEFAULT_ROUTES
) -> DataFrame:
    """Alerts that start later, one per route and header, soonest first."""
    now = instant(as_of)
    upcoming = unnest_routes(with_status(alerts, ["upcoming"], now), routes)
    hours = dedup.soonest(upcoming).withColumn("hours_until_start", hours_between("start_time", now))
    return hours.select(
        "route_id",
        "header",
        "hours_until_start",
        "start_time",
        "end_time",
        text.starts_in("hours_until_start").alias("eta"),
        text.utc_date("start_time").alias("starts"),
        text.utc_date("end_time", text.NO_END).alias("ends"),
        text.title("header").alias("title"),
    ).orderBy(F.asc_nulls_last("hours_until_start"), "route_id", "header")


def extreme_heat_windows(features: DataFrame) -> DataFrame:
    return features.filter(F.col("is_extreme_heat")).select(
        "window_start", "route_id", "avg_headway_gap_sec", "temperature_c", "alerts_active"
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
