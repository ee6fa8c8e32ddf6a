"""Nested feed snapshots (trip updates, alerts, vehicle positions) to flat rows.

One input row is one snapshot: a header time and an array of entities. Every function here
is a narrow transformation (no shuffle), works on batch and streaming frames alike, and reads
only the nested fields it needs.

``feed_seq`` numbers the rows of one snapshot in input order, so that "keep the first" has a
meaning after a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .. import schemas
from ..functions.times import from_epoch
from ..operators.dedup import first_in_array
from .scan import load_or_empty

# Landing folders hold a sub-folder per poll.
SCAN = {"recursiveFileLookup": "true"}


def read_feed(spark: SparkSession, path: str, fmt: str = "parquet", glob: str | None = None, **options: str) -> DataFrame:
    """All snapshots below ``path``; ``source_file`` is the file each row came from.

    A ``source_file`` stored in the rows (compacted landing files) wins over the file path. Text that is
    no snapshot stops the read; pass ``mode="PERMISSIVE"`` to go on without it and ``corrupt_lines`` to count it.
    """
    reader = spark.read.schema(schemas.FEED).format(fmt).options(**SCAN, **({"mode": "FAILFAST"} | options))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return load_or_empty(spark, lambda: with_lineage(reader.load(path)), schemas.FEED)


def stream_feed(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None, **options: str
) -> DataFrame:
    """New snapshots as they land, in any folder below; the checkpoint remembers which files were seen.

    ``path`` must exist: a misspelt landing folder is an error, not an empty stream.
    """
    reader = spark.readStream.schema(schemas.FEED).format(fmt).options(**SCAN, **({"mode": "FAILFAST"} | options))
    reader = reader.option("pathGlobFilter", f"*.{fmt}*")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_lineage(reader.load(path))


def corrupt_lines(spark: SparkSession, path: str, schema: str = schemas.FEED, glob: str = "*.json") -> DataFrame:
    """source_file, lines, corrupt: per JSON file below ``path``, its lines and those that cannot be read."""
    lines = spark.read.options(**SCAN).option("pathGlobFilter", glob).text(path)
    read = F.from_json("value", f"{schema.rstrip()}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    named = lines.select(F.col("_metadata.file_path").alias("source_file"), read["_corrupt"].alias("corrupt"))
    return named.groupBy("source_file").agg(F.count(F.lit(1)).alias("lines"), F.count("corrupt").alias("corrupt"))


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the file each row was read from, where the rows do not state their source."""
    path = F.col("_metadata.file_path")
    if "source_file" in df.columns:
        return df.withColumn("source_file", F.coalesce("source_file", path))
    return df.withColumn("source_file", path)


def _entities(feed: DataFrame, payload: str) -> DataFrame:
    """One row per entity that carries the payload.

    The ids and the payload leave the entities as arrays of their own before they are exploded
    together: exploding whole entities would make the scan read every payload.
    """
    wanted = F.arrays_zip(F.col("entity.id").alias("id"), F.col(f"entity.{payload}").alias(payload))
    exploded = feed.select(
        "source_file",
        from_epoch("header.timestamp").alias("event_time"),
        F.posexplode(wanted).alias("entity_pos", "entity"),
    )
    return exploded.filter(F.col(f"entity.{payload}").isNotNull())


def _sequence(entity_pos: str, inner_pos: str | None = None) -> Column:
    major = F.shiftleft(F.col(entity_pos).cast("bigint"), 32)
    return (major + F.col(inner_pos) if inner_pos else major).alias("feed_seq")


def _text(path: str) -> Column:
    """Text left off the wire reads as empty."""
    return F.coalesce(F.col(path), F.lit(""))


def load_raw_delays(feed: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES) -> DataFrame:
    """One row per stop-time update of a trip on the wanted routes (all routes when None)."""
    trips = _entities(feed, "trip_update")
    if routes is not None:
        trips = trips.filter(F.col("entity.trip_update.trip.route_id").isin(*routes))
    updates = trips.select(
        "source_file",
        "event_time",
        "entity_pos",
        _text("entity.id").alias("vehicle_id"),
        _text("entity.trip_update.trip.trip_id").alias("trip_id"),
        _text("entity.trip_update.trip.route_id").alias("route_id"),
        F.posexplode("entity.trip_update.stop_time_update").alias("update_pos", "update"),
    )
    return updates.select(
        "vehicle_id",
        "trip_id",
        "route_id",
        _text("update.stop_id").alias("stop_id"),
        _delay("arrival").alias("arrival_delay"),
        _delay("departure").alias("departure_delay"),
        "source_file",
        "event_time",
        _sequence("entity_pos", "update_pos"),
    )


def _delay(event: str) -> Column:
    """Null without the event; zero when the event is there but states no delay."""
    event_column = F.col(f"update.{event}")
    return F.when(event_column.isNotNull(), F.coalesce(F.col(f"update.{event}.delay"), F.lit(0)))


def load_raw_alerts(feed: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES) -> DataFrame:
    """One row per alert that names a wanted route; its routes as a sorted distinct array."""
    alerts = _entities(feed, "alert")
    informed = F.col("entity.alert.informed_entity.route_id")
    named = informed if routes is None else F.filter(informed, lambda route: route.isin(*routes))
    alerts = alerts.withColumn("route_ids", F.array_sort(F.array_distinct(named))).filter(F.size("route_ids") > 0)
    period = F.get(F.col("entity.alert.active_period"), F.lit(0))
    return alerts.select(
        _text("entity.id").alias("alert_id"),
        "route_ids",
        _first_translation("header_text").alias("header"),
        _first_translation("description_text").alias("description"),
        F.coalesce(F.col("entity.alert.effect"), F.lit(fv.WIRE_DEFAULT_EFFECT)).alias("effect"),
        F.when(period.isNotNull(), F.coalesce(period["start"], F.lit(0))).alias("start_time"),
        period["end"].alias("end_time"),
        "source_file",
        "event_time",
        _sequence("entity_pos"),
    )


def _first_translation(field: str) -> Column:
    first = F.get(F.col(f"entity.alert.{field}.translation"), F.lit(0))
    return F.coalesce(first["text"], F.lit(""))


def split_files(snapshots: DataFrame) -> DataFrame:
    """Files that more than one row comes from: there, what is first in a row need not be first in the file."""
    return snapshots.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def first_raw_delays(feed: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES) -> DataFrame:
    """The first stop-time update with a delay of each vehicle, trip and stop, one snapshot at a time.

    What ``load_raw_delays`` and the deduplication by file give where each file is one row, but narrow: the updates
    of a snapshot are one array, from which the first of each key is taken before it becomes rows.
    """
    wanted = F.arrays_zip(F.col("entity.id").alias("id"), F.col("entity.trip_update").alias("trip_update"))

    def has_updates(entity: Column) -> Column:
        on_route = F.lit(True) if routes is None else entity["trip_update"]["trip"]["route_id"].isin(*routes)
        return on_route & entity["trip_update"]["stop_time_update"].isNotNull()

    def text(column: Column) -> Column:
        return F.coalesce(column, F.lit(""))

    def late(event: Column) -> Column:
        return F.when(event.isNotNull(), F.coalesce(event["delay"], F.lit(0)))

    def rows(entity: Column) -> Column:
        trip = entity["trip_update"]["trip"]
        return F.transform(
            entity["trip_update"]["stop_time_update"],
            lambda update: F.struct(
                text(entity["id"]).alias("vehicle_id"),
                text(trip["trip_id"]).alias("trip_id"),
                text(trip["route_id"]).alias("route_id"),
                text(update["stop_id"]).alias("stop_id"),
                late(update["arrival"]).alias("arrival_delay"),
                late(update["departure"]).alias("departure_delay"),
            ),
        )

    updates = F.flatten(F.transform(F.filter(wanted, has_updates), rows))
    known = F.filter(updates, lambda row: row["arrival_delay"].isNotNull() | row["departure_delay"].isNotNull())
    first = first_in_array(known, lambda row: F.struct(row["vehicle_id"], row["trip_id"], row["stop_id"]))
    return feed.select("source_file", from_epoch("header.timestamp").alias("event_time"), F.inline(first))


def first_raw_alerts(feed: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES) -> DataFrame:
    """The first alert of each id that names a wanted route, one snapshot at a time (compare ``first_raw_delays``)."""
    wanted = F.arrays_zip(F.col("entity.id").alias("id"), F.col("entity.alert").alias("alert"))

    def on_routes(entity: Column) -> Column:
        named = entity["alert"]["informed_entity"]["route_id"]
        return F.exists(named, lambda route: F.lit(True) if routes is None else route.isin(*routes))

    kept = F.filter(wanted, lambda entity: entity["alert"].isNotNull() & on_routes(entity))
    first = first_in_array(kept, lambda entity: F.struct(F.coalesce(entity["id"], F.lit("")).alias("id")))
    return load_raw_alerts(feed.select("source_file", "header", first.alias("entity")), routes).drop("feed_seq")


def load_raw_positions(feed: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES) -> DataFrame:
    """One row per vehicle on the wanted routes."""
    vehicles = _entities(feed, "vehicle")
    if routes is not None:
        vehicles = vehicles.filter(F.col("entity.vehicle.trip.route_id").isin(*routes))
    return vehicles.select(
        _text("entity.id").alias("vehicle_id"),
        _text("entity.vehicle.trip.trip_id").alias("trip_id"),
        _text("entity.vehicle.trip.route_id").alias("route_id"),
        _text("entity.vehicle.stop_id").alias("stop_id"),
        F.coalesce("entity.vehicle.current_stop_sequence", F.lit(0)).alias("current_stop_sequence"),
        F.coalesce("entity.vehicle.current_status", F.lit(fv.WIRE_DEFAULT_STOP_STATUS)).alias("current_status"),
        F.col("entity.vehicle.occupancy_status").alias("occupancy_status"),
        F.coalesce(F.col("entity.vehicle.timestamp"), F.lit(0)).cast("bigint").alias("mta_timestamp"),
        "source_file",
        "event_time",
        _sequence("entity_pos"),
    )
