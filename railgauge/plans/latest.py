"""Tables of the newest row per key, kept up by merging new rows into the parts they fall in.

They hold one row per alert and route, or per hour of weather, however many snapshots have shown it, so what is
derived from them does not read the history of snapshots again. A part is read, merged and replaced in one step;
merging the same rows twice, or an older poll, changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import dedup
from ..operators.filters import unnest_routes
from ..sources import versions
from ..sources.tables import NO_DATE
from ..streaming.windows import date_parts, dates_of

Newest = Callable[[DataFrame], DataFrame]

ALERTS = """
    alert_id string, route_id string, header string, description_short string, severity string,
    start_time timestamp, end_time timestamp, source_file string, event_time timestamp, window_start timestamp
"""
BUCKETS = 64
BUCKET_COLUMN = "alert_bucket"
DATE_COLUMN = "event_date"


def _merge(new: DataFrame, root: str, schema: str, column: str, kind: str, parts: list[str], newest: Newest, part: Column) -> None:
    old = versions.read(new.sparkSession, root, f"{schema.rstrip()}, {column} {kind}", parts).drop(column)
    merged = newest(old.unionByName(new.select(*old.columns))).withColumn(column, part)
    versions.replace(merged.hint("rebalance", column), root, [column], parts)


# Alerts


def _bucket() -> Column:
    return F.pmod(F.xxhash64("alert_id"), F.lit(BUCKETS)).cast("int")


def _of_routes(alerts: DataFrame) -> DataFrame:
    return dedup.latest_alert(unnest_routes(alerts))


def upsert_alerts(alerts: DataFrame, root: str) -> None:
    """Merge rows of the processed alerts into the newest row per alert and route."""
    parts = [versions.part(**{BUCKET_COLUMN: row[0]}) for row in alerts.select(_bucket()).distinct().collect()]
    if parts:
        _merge(_of_routes(alerts), root, ALERTS, BUCKET_COLUMN, "int", parts, dedup.latest_alert, _bucket())


def latest_alerts(spark: SparkSession, root: str) -> DataFrame:
    return versions.read(spark, root, f"{ALERTS.rstrip()}, {BUCKET_COLUMN} int").drop(BUCKET_COLUMN)


def moved_windows(alerts: DataFrame, root: str) -> set[date]:
    """The window dates in which the fact may count other alerts once these rows are merged.

    A newer snapshot takes an alert from the window of its newest one so far to its own. Asked before merging; rows
    already merged, or older than what is stored, name dates in which nothing changes.
    """
    keys = alerts.select("alert_id").distinct()
    before = latest_alerts(alerts.sparkSession, root).join(keys, "alert_id", "left_semi")
    return dates_of(before, "window_start") | dates_of(_of_routes(alerts), "window_start")


# Weather


def _day() -> Column:
    return F.coalesce(F.to_date("obs_hour"), F.lit(NO_DATE))


def upsert_weather(weather: DataFrame, root: str, newest: Newest = dedup.latest_observation) -> set[date]:
    """Merge rows of the processed weather into one per hour, the ``newest``; returns the dates of the rows."""
    dates = dates_of(weather, "obs_hour")
    if dates:
        _merge(weather, root, schemas.WEATHER, DATE_COLUMN, "date", date_parts(dates), newest, _day())
    return dates


def latest_weather(spark: SparkSession, root: str, dates: set[date] | None = None) -> DataFrame:
    """The row kept per hour, of some dates or all; only the folders of those are listed."""
    parts = None if dates is None else date_parts(dates)
    return versions.read(spark, root, f"{schemas.WEATHER.rstrip()}, {DATE_COLUMN} date", parts).drop(DATE_COLUMN)
