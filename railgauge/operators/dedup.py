"""One row per key, under a stated total order.

``top1`` compiles to a row_number filter. Spark plans a group limit below the shuffle for it:
each map task sends at most one row per key, so a key that owns a third of all rows reaches
its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"
KEY_HASH = "_key_hash"


def top1(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep_hash: bool = False
) -> DataFrame:
    """The first row of each key; null keys form a group of their own.

    A 64-bit hash leads the partition columns: the sorts on both sides of the shuffle then
    compare numbers and look at the (text) keys only where hashes are equal. ``keep_hash``
    leaves it on the rows for a later join on the same keys.
    """
    window = Window.partitionBy(KEY_HASH, *keys).orderBy(*order)
    ranked = df.withColumn(KEY_HASH, F.xxhash64(*keys)).withColumn(RANK, F.row_number().over(window))
    first = ranked.filter(F.col(RANK) == 1).drop(RANK)
    return first if keep_hash else first.drop(KEY_HASH)


def ordered_by(df: DataFrame, *columns: str, descending: Sequence[str] = ()) -> list[Column]:
    """Sort columns, as far as the frame has them."""
    return [F.desc(column) if column in descending else F.asc(column) for column in columns if column in df.columns]


def remaining(df: DataFrame, used: Sequence[str]) -> list[str]:
    return [column for column in df.columns if column not in used]


DELAY_KEY = ("vehicle_id", "trip_id", "stop_id", "source_file")
ALERT_KEY = ("alert_id", "source_file")
WEATHER_KEY = ("weather_timestamp", "source_file")
POSITION_KEY = ("vehicle_id", "trip_id", "stop_id", "mta_timestamp")
ALERT_ROUTE_KEY = ("alert_id", "route_id")
WEATHER_HOUR_KEY = ("obs_hour",)

INPUT_ORDER = ("event_time", "source_file", "feed_seq")


def keep_first(
    df: DataFrame, keys: Sequence[str], every_column: bool = False, keep_hash: bool = False
) -> DataFrame:
    """The first row of each key in input order: by snapshot, then by place in the snapshot.

    ``feed_seq`` makes that order total. Frames without it are ordered by all their columns, as
    are frames for which ``every_column`` asks; both make the scan read every column.
    """
    ties = remaining(df, (*keys, *INPUT_ORDER)) if every_column or "feed_seq" not in df.columns else []
    lead = [column for column in INPUT_ORDER if column not in keys]
    return top1(df, keys, ordered_by(df, *lead, *ties), keep_hash)


def first_in_array(rows: Column, key: Callable[[Column], Column]) -> Column:
    """Of an array of structs the first of each key (nulls are a key too), without a shuffle.

    The elements are sorted by key and place, so each is compared with the one before it only.
    """

    def first(ordered: Column) -> Column:
        def new(row: Column, i: Column) -> Column:
            return (i == 0) | ~row["key"].eqNullSafe(F.get(ordered, i - 1)["key"])

        return F.transform(F.filter(ordered, new), lambda row: row["row"])

    numbered = F.transform(rows, lambda row, i: F.struct(key(row).alias("key"), i.alias("place"), row.alias("row")))
    # An array of one element binds the sorted array, so that it is sorted once and not for each element.
    return F.get(F.transform(F.array(F.array_sort(numbered)), first), F.lit(0))


# Ties below are between rows that state the same key at the same time. They are broken by the
# file and by the few columns a reader can tell such rows apart by. Longer columns stay out of
# the order, so that a query which does not show them does not read them either.


def earliest_delay(df: DataFrame) -> DataFrame:
    """Per vehicle, trip, stop and file: the earliest report."""
    return top1(df, DELAY_KEY, ordered_by(df, "event_time", "route_id", "arrival_delay", "departure_delay"))


def latest_alert(df: DataFrame) -> DataFrame:
    """Per alert and route: the newest snapshot."""
    newest = ("event_time", "source_file")
    order = ordered_by(df, *newest, "severity", "header", "start_time", "end_time", descending=newest)
    return top1(df, ALERT_ROUTE_KEY, order)


def latest_position(df: DataFrame) -> DataFrame:
    """Per vehicle, trip, stop and vehicle time: the newest snapshot."""
    newest = ("event_time", "source_file")
    return top1(df, POSITION_KEY, ordered_by(df, *newest, "route_id", "headway_gap_sec", descending=newest))


def latest_observation(df: DataFrame) -> DataFrame:
    """Per hour: the latest weather time, then the newest snapshot."""
    newest = ("weather_timestamp", "event_time", "source_file")
    return top1(df, WEATHER_HOUR_KEY, ordered_by(df, *newest, descending=newest))


def latest_weather_snapshot(df: DataFrame) -> DataFrame:
    """Per hour: the newest snapshot, then the latest weather time."""
    newest = ("event_time", "weather_timestamp", "source_file")
    return top1(df, WEATHER_HOUR_KEY, ordered_by(df, *newest, descending=newest))


def longest_running(alerts: DataFrame) -> DataFrame:
    """Per route and header: the earliest start, as one hash aggregation.

    The reader sees route, header and the hours since that start, so no row has to be kept
    whole; partial sums of the minimum travel instead of rows.
    """
    return alerts.groupBy("route_id", "header").agg(F.min("start_time").alias("start_time"))


def soonest(alerts: DataFrame) -> DataFrame:
    """Per route and header: the earliest start with its end (open-ended first among equals)."""
    first = alerts.groupBy("route_id", "header").agg(F.min(F.struct("start_time", "end_time")).alias("period"))
    return first.select("route_id", "header", "period.start_time", "period.end_time")
