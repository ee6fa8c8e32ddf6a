"""The next row in a global order, without one task that sees all rows; built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one range is meant to hold.
ROWS_IN_RANGE = 20_000


def _firsts(rows: DataFrame, key: str, tie: str, rows_in_range: int) -> list[tuple]:
    """The first (key, tie) of each range: Spark's sampled range partitioning of the keys alone, as many as the rows ask for.

    Only these rows, one for `rows_in_range` of the input, reach the driver.
    """
    keys = rows.select(key, tie)
    ranges = -(-keys.count() // rows_in_range)
    if ranges <= 1:
        first = keys.agg(F.min(F.struct(key, tie)).alias("first")).first()["first"]
        return [] if first is None else [tuple(first)]
    dealt = keys.repartitionByRange(ranges, F.asc_nulls_first(key), F.asc_nulls_first(tie))
    found = dealt.groupBy(F.spark_partition_id()).agg(F.min(F.struct(key, tie)).alias("first")).collect()
    return sorted((tuple(row["first"]) for row in found), key=lambda f: (f[0] is not None, f[0] or 0, f[1]))


def _range_number(firsts: list[tuple], key: str, tie: str) -> Column:
    """How many ranges begin at or before a row, less one; nulls first, so rows without a key are split by their tie."""
    if len(firsts) <= 1:
        return F.lit(0)
    width = math.isqrt(len(firsts)) + 1
    chunks = [firsts[i : i + width] for i in range(0, len(firsts), width)]
    own = F.struct(F.col(key).alias("key"), F.col(tie).alias("tie"))

    def bound(first: tuple) -> Column:
        return F.struct(F.lit(first[0]).cast("long").alias("key"), F.lit(first[1]).cast("long").alias("tie"))

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= own))

    chunk = F.greatest(below(F.array(*[bound(c[0]) for c in chunks])), F.lit(1))
    inside = F.array(*[F.array(*map(bound, c)) for c in chunks])
    return F.greatest((chunk - 1) * width + below(F.element_at(inside, chunk)) - 1, F.lit(0))


def in_ranges(rows: DataFrame, key: str, tie: str, rows_in_range: int = ROWS_IN_RANGE) -> DataFrame:
    """The rows with `range` and `copy` added, and for every range a copy of the row that follows it.

    Rows are ordered by key (long, nulls first) and tie (long). Sorted by copy, key and tie, each row
    that is no copy is followed within its range by the next row of all; the last by the first. Rows
    equal in key and tie are in one range.
    """
    firsts = _firsts(rows, key, tie, rows_in_range)
    ranged = rows.withColumn("range", _range_number(firsts, key, tie))
    # One row per range, so this broadcast is bounded by the number of ranges.
    before = [(k, t, (number - 1) % len(firsts)) for number, (k, t) in enumerate(firsts)]
    begins = rows.sparkSession.createDataFrame(before, "first_key long, first_tie long, before int")
    matches = (F.col(tie) == F.col("first_tie")) & F.col(key).eqNullSafe(F.col("first_key"))
    copies = ranged.join(F.broadcast(begins), matches).drop("range", "first_key", "first_tie").withColumnRenamed("before", "range")
    return ranged.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))


def order_in_range(key: str, tie: str):
    return Window.partitionBy("range").orderBy("copy", key, tie)
