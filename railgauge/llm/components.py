"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


#: Links per task; without adaptive merging a small table would be dealt over all shuffle partitions again and again.
LINKS_IN_TASK = 100_000


def _stars(links: DataFrame, large: bool, tasks: int) -> DataFrame:
    """Each node's neighbours, linked to the smallest node among them and itself.

    links has a > b. The large star moves a node's larger neighbours, the small star its smaller ones
    and itself. The minimum is aggregated before the shuffle, and one row per node joins back.
    """
    links = links.coalesce(tasks)
    if large:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(tasks)
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        joined = links.join(least, "a")
        moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a > b").coalesce(tasks).distinct().coalesce(tasks)


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable), for every node of the links (a, b: long).

    Each round is written to the shared folder; the rounds end when a round changes no link, after a
    number that grows with the logarithm of the nodes. Only a count and a checksum reach the driver.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    links, before = cut(links), None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
        tasks = state[0] // LINKS_IN_TASK + 1
        links = cut(_stars(_stars(links, True, tasks), False, tasks))
    links = links.coalesce(before[0] // LINKS_IN_TASK + 1)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
