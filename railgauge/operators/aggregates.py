"""Aggregations per route and window.

Grouping keys are few and hot at scale (every report of a route's quarter hour), so each
aggregation keeps fixed-width buffers that Spark combines before the shuffle. Text results
(worst stop, headers) are computed in a second step over the already reduced rows, because a
text buffer would turn the first step from a hash into a sort of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.numbers import mean, percentage

# The time leads: sorts for merge joins and text aggregates then compare numbers first.
GRAIN = ("window_start", "route_id")
SEVERITIES = tuple(label for _, label in fv.DELAY_BOUNDS) + (fv.DELAY_OVER,)
HEADER_SEPARATOR = " | "


def delays_by_window(delays: DataFrame, keys: Sequence[str | Column] = GRAIN) -> DataFrame:
    """Average and longest arrival delay, number of records."""
    return delays.groupBy(*keys).agg(
        F.avg("arrival_delay").alias("avg_delay_sec"),
        F.max("arrival_delay").alias("max_delay_sec"),
        F.count(F.lit(1)).alias("delay_records"),
    )


def severity_counts(delays: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    counts = [F.count_if(F.col("delay_severity") == label).alias(f"{label}_count") for label in SEVERITIES]
    return delays.groupBy(*keys).agg(*counts)


def percent_delayed(counts: DataFrame) -> DataFrame:
    """Share of moderate and severe records in percent, two digits."""
    share = percentage(F.col("severe_count") + F.col("moderate_count"), "delay_records")
    return counts.withColumn("pct_delayed", share)


def worst_stop(delays: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """The stop with the longest arrival delay (the last stop id among equals)."""
    per_stop = delays.filter(F.col("arrival_delay").isNotNull()).groupBy(*keys, "stop_id", "stop_name")
    longest = per_stop.agg(F.max("arrival_delay").alias("_longest"))
    return longest.groupBy(*keys).agg(_worst("_longest").alias("_worst")).select(
        *keys,
        F.col("_worst.stop_id").alias("worst_stop_id"),
        F.col("_worst.stop_name").alias("worst_stop_name"),
    )


def _worst(longest: str) -> Column:
    """Stops without any arrival delay do not compete."""
    rank = F.when(F.col(longest).isNotNull(), F.struct(F.col(longest), F.col("stop_id"), F.col("stop_name")))
    return F.max_by(F.struct("stop_id", "stop_name"), rank)


def delay_profile(delays: DataFrame) -> DataFrame:
    """All delay measures of the fact, worst stop included, from one pass over the delays.

    First per stop with hash aggregation, then per route and window over one row per stop.
    """
    per_stop = delays.groupBy(*GRAIN, "stop_id", "stop_name").agg(
        F.sum("arrival_delay").alias("_total"),
        F.count("arrival_delay").alias("_known"),
        F.max("arrival_delay").alias("_longest"),
        F.count(F.lit(1)).alias("_records"),
        *[F.count_if(F.col("delay_severity") == label).alias(f"_{label}") for label in SEVERITIES],
    )
    merged = per_stop.groupBy(*GRAIN).agg(
        _worst("_longest").alias("_worst"),
        mean(F.sum("_total"), F.sum("_known")).alias("avg_delay_sec"),
        F.max("_longest").alias("max_delay_sec"),
        F.sum("_records").alias("delay_records"),
        *[F.sum(f"_{label}").alias(f"{label}_count") for label in SEVERITIES],
    )
    return percent_delayed(merged).select(
        *GRAIN,
        F.col("_worst.stop_name").alias("worst_stop_name"),
        F.col("_worst.stop_id").alias("worst_stop_id"),
        "avg_delay_sec",
        "max_delay_sec",
        "delay_records",
        *[f"{label}_count" for label in reversed(SEVERITIES)],
        "pct_delayed",
    )


def alert_count_by_window(alerts: DataFrame) -> DataFrame:
    """Distinct alerts per route and window; input has one row per alert, route and snapshot.

    Spark plans a single distinct count as two hash aggregations, the first per alert, so the
    many snapshots of one alert are combined before the shuffle.
    """
    return alerts.groupBy(*GRAIN).agg(F.count_distinct("alert_id").alias("alerts_active"))


def worst_severity(alerts: DataFrame) -> DataFrame:
    """The last severity label in alphabetical order (labels carry no rank)."""
    labels = alerts.select(*GRAIN, "severity").distinct()
    return labels.groupBy(*GRAIN).agg(F.max("severity").alias("worst_severity"))


def alert_headers(alerts: DataFrame) -> DataFrame:
    """Distinct headers in alphabetical order, joined into one text."""
    distinct = alerts.select(*GRAIN, "header").distinct()
    return distinct.groupBy(*GRAIN).agg(_headers().alias("alert_headers"))


def _headers() -> Column:
    """Null when there is no header at all, as for any aggregate over nothing."""
    joined = F.array_join(F.array_sort(F.collect_list("header")), HEADER_SEPARATOR)
    return F.when(F.count("header") > 0, joined)


def alert_profile(alerts: DataFrame) -> DataFrame:
    """Alert measures of the fact; input has one row per alert and route (``latest_alert``).

    Alerts are unique within a route there, so counts per header add up to the distinct count.
    """
    per_header = alerts.groupBy(*GRAIN, "header").agg(
        F.count("alert_id").alias("_alerts"), F.max("severity").alias("_severity")
    )
    return per_header.groupBy(*GRAIN).agg(
        F.sum("_alerts").alias("alerts_active"),
        F.max("_severity").alias("worst_severity"),
        _headers().alias("alert_headers"),
    )


def headway_by_window(positions: DataFrame) -> DataFrame:
    """Average and longest gap; a window without any gap has none."""
    return positions.groupBy(*GRAIN).agg(
        F.avg("headway_gap_sec").alias("avg_headway_gap_sec"),
        F.max("headway_gap_sec").alias("max_headway_gap_sec"),
    )


def headway_profile(positions: DataFrame) -> DataFrame:
    """Gap measures of the fact."""
    return positions.groupBy(*GRAIN).agg(
        F.avg("headway_gap_sec").alias("avg_headway_gap_sec"),
        F.max("headway_gap_sec").alias("max_headway_gap_sec"),
        F.count_if(F.col("occupancy_proxy") == "bunched").alias("bunched_count"),
        F.count_if(F.col("occupancy_proxy") == "sparse").alias("sparse_count"),
    )


def freshness(features: DataFrame) -> DataFrame:
    return features.agg(F.max("window_start").alias("newest_window"))
