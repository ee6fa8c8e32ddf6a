"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import classify
from ..functions.times import instant


def on_routes(df: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES, column: str = "route_id") -> DataFrame:
    """Rows of the wanted routes; None keeps every route."""
    return df if routes is None else df.filter(F.col(column).isin(*routes))


def any_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where every one of the columns is null."""
    return df.dropna(how="all", subset=list(columns))


def all_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def within_gap_cap(df: DataFrame, column: str = "headway_gap_sec", cap: float = fv.GAP_CAP_SECONDS) -> DataFrame:
    return df.filter(classify.null_or_within(column, cap))


def unnest_routes(alerts: DataFrame, routes: Sequence[str] | None = None) -> DataFrame:
    """One row per alert and route; alerts without routes disappear."""
    others = [column for column in alerts.columns if column != "route_ids"]
    return on_routes(alerts.select(F.explode("route_ids").alias("route_id"), *others), routes)


def with_status(
    alerts: DataFrame, statuses: Sequence[str], as_of: Column | str | datetime | None = None
) -> DataFrame:
    """Alerts in one of the statuses.

    The status is a CASE the scan cannot use, so what each status implies for the start or end
    is stated as a plain comparison too; those reach the scan.
    """
    now, start, end = instant(as_of), F.col("start_time"), F.col("end_time")
    implied = {"upcoming": start > now, "ongoing": end.isNull(), "active": end > now, "expired": end <= now}
    possible = reduce(Column.__or__, [implied[status] for status in statuses])
    return alerts.filter(possible).filter(classify.alert_status(as_of=now).isin(*statuses))
