"""Left joins of the star.

No side carries a broadcast hint: Spark broadcasts a side only while its size, estimated from
the files or measured by adaptive execution, is under ``spark.sql.autoBroadcastJoinThreshold``.
A bigger side is merge-joined, and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import null_to_zero
from ..functions.times import hour_floor
from .aggregates import GRAIN


def join_stops(delays: DataFrame, stops: DataFrame) -> DataFrame:
    """Stop name and direction; unknown stops keep null. One stop row per id."""
    named = stops.groupBy("stop_id").agg(
        F.min(F.struct("stop_name", "direction")).alias("_stop")
    ).select("stop_id", "_stop.stop_name", "_stop.direction")
    return delays.join(named, "stop_id", "left")


def join_on_grain(base: DataFrame, other: DataFrame) -> DataFrame:
    """Per route and window. Both sides come out of an aggregation on these keys, which has
    already partitioned them for the join."""
    return base.join(other, list(GRAIN), "left")


def join_alerts(base: DataFrame, alerts: DataFrame) -> DataFrame:
    """Windows without alerts count zero of them."""
    return join_on_grain(base, alerts).withColumn("alerts_active", null_to_zero("alerts_active"))


def join_weather(base: DataFrame, weather: DataFrame) -> DataFrame:
    """Hourly weather for each window of the hour, on every route. ``weather``: one row per hour."""
    hourly = weather.withColumnRenamed("obs_hour", "_hour")
    return base.withColumn("_hour", hour_floor("window_start")).join(hourly, "_hour", "left").drop("_hour")


def star_join(base: DataFrame, alerts: DataFrame, positions: DataFrame, weather: DataFrame) -> DataFrame:
    """Everything known about the windows that have delay records."""
    return join_weather(join_on_grain(join_alerts(base, alerts), positions), weather)
