"""Seconds since the previous report at the same route and stop.

A route and stop can own any share of all rows, over any span of time, and one second of it can
own many of them (vehicles that state no time all report second zero). So the rows themselves
are never gathered per route and stop:

1. Rows are reduced to distinct (route, stop, second), with the identity of the first row of
   that second. This is a partial aggregation; a group is one second.
2. The gap between seconds is computed per (route, stop, day). A task sees at most 86,400
   seconds of one day, plus the capped look-back, however many rows there are.
3. The gap goes back to its first row by that row's identity. All other rows of the second
   follow a row with the same time: their gap is zero.

Step 3 joins on the row identity, which is unique, so no join key is hot; and a frame that was
deduplicated on that identity is already partitioned for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import classify
from .dedup import KEY_HASH, POSITION_KEY, keep_first, top1

DAY_SECONDS = 86_400
ROUTE_STOP = ("route_id", "stop_id")


def _second_gaps_capped(seconds: DataFrame, places: Sequence[str], cap: int) -> DataFrame:
    """Gaps up to ``cap``; a day only needs the last ``cap`` seconds of the days before it."""
    day = F.floor(F.col("_at") / DAY_SECONDS)
    last_reached = F.floor((F.col("_at") + cap) / DAY_SECONDS)
    spread = seconds.withColumn("_day", F.explode(F.sequence(day, last_reached)))
    window = Window.partitionBy("_day", *places).orderBy("_at")
    gaps = spread.withColumn("_gap", (F.col("_at") - F.lag("_at").over(window)).cast("double"))
    return gaps.filter(F.col("_day") == day).withColumn("_gap", classify.nullify_over("_gap", cap))


def _second_gaps(seconds: DataFrame, places: Sequence[str]) -> DataFrame:
    """Gaps of any length: within each day, and from the last second of an earlier day.

    The second window runs over one row per route, stop and day.
    """
    dated = seconds.withColumn("_day", F.floor(F.col("_at") / DAY_SECONDS))
    last_of_day = dated.groupBy("_day", *places).agg(F.max("_at").alias("_last"))
    by_day = Window.partitionBy(*places).orderBy("_day")
    carried = last_of_day.select(
        F.col("_day").alias("_carry_day"),
        *[F.col(place).alias(f"_carry{place}") for place in places],
        F.lag("_last").over(by_day).alias("_carry"),
    )
    within = Window.partitionBy("_day", *places).orderBy("_at")
    previous = dated.withColumn("_previous", F.lag("_at").over(within))
    same_place = [F.col(place).eqNullSafe(F.col(f"_carry{place}")) for place in places]
    joined = previous.join(carried, [F.col("_day") == F.col("_carry_day"), *same_place], "left")
    return joined.withColumn("_gap", (F.col("_at") - F.coalesce("_previous", "_carry")).cast("double"))


def _attach_gaps(marked: DataFrame, places: Sequence[Column], at: Column, cap: int | None) -> DataFrame:
    """Add the gap to rows marked with their identity and its hash."""
    names = [f"_place{i}" for i in range(len(places))]
    timed = marked.select("_id", at.alias("_at"), *[place.alias(name) for name, place in zip(names, places)])
    seconds = timed.groupBy("_at", *names).agg(F.min("_id").alias("_id"))
    gaps = _second_gaps(seconds, names) if cap is None else _second_gaps_capped(seconds, names, cap)
    firsts = gaps.select(F.xxhash64("_id").alias(KEY_HASH), "_id", "_gap", F.lit(True).alias("_first"))
    same_second = F.when(at.isNotNull(), F.lit(0.0))
    gap = F.when(F.col("_first"), F.col("_gap")).otherwise(same_second)
    joined = marked.join(firsts, [KEY_HASH, "_id"], "left").withColumn("headway_gap_sec", gap)
    return joined.drop(KEY_HASH, "_gap", "_first")


def headway_gaps(
    positions: DataFrame,
    identity: Sequence[str] = POSITION_KEY,
    keys: Sequence[str] = ROUTE_STOP,
    time: str = "mta_timestamp",
    cap: int | None = fv.GAP_CAP_SECONDS,
) -> DataFrame:
    """Add ``headway_gap_sec``. ``time`` is epoch seconds; ``identity`` columns tell rows apart.

    The first row of a route and stop has no gap; neither has one longer than ``cap``
    (None keeps gaps of any length). Rows of the same second are ordered by identity.
    """
    marked = positions.withColumn("_id", F.struct(*identity)).withColumn(KEY_HASH, F.xxhash64("_id"))
    return _attach_gaps(marked, [F.col(key) for key in keys], F.col(time), cap).drop("_id")


def deduplicated_gaps(
    positions: DataFrame,
    cap: int | None = fv.GAP_CAP_SECONDS,
    per_visit: bool = False,
) -> DataFrame:
    """First row per vehicle, trip, stop and vehicle time, then the gaps between those rows.

    The identity is one struct column, because equality of structs holds for missing parts too,
    unlike a join on the parts. Deduplication and the join that brings the gaps back share it and
    its hash, hence one shuffle of the full rows. ``per_visit`` first reduces a vehicle's stay at
    a stop to its first report, so that repeated reports of one train make no gaps.
    """
    columns = positions.columns
    others = [column for column in columns if column not in POSITION_KEY]
    marked = positions.select(F.struct(*POSITION_KEY).alias("_id"), *others)
    # With every column in the order, both uses of these rows below ask for the same columns
    # and Spark runs their scan and shuffle once.
    unique = keep_first(marked, ["_id"], every_column=True, keep_hash=True)
    if per_visit:
        visit = ["_id.vehicle_id", "_id.trip_id", "route_id", "_id.stop_id"]
        unique = top1(unique.drop(KEY_HASH), visit, [F.asc("_id.mta_timestamp")])
        unique = unique.withColumn(KEY_HASH, F.xxhash64("_id"))
    gaps = _attach_gaps(unique, [F.col("route_id"), F.col("_id.stop_id")], F.col("_id.mta_timestamp"), cap)
    restored = [F.col(f"_id.{column}" if column in POSITION_KEY else column) for column in columns]
    return gaps.select(*restored, "headway_gap_sec")


def with_headway(positions: DataFrame, **options) -> DataFrame:
    """Gaps and their status."""
    return deduplicated_gaps(positions, **options).withColumn(
        "headway_status", classify.headway_status("headway_gap_sec")
    )
