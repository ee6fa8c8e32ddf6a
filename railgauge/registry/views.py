"""The library's input tables, derived from the given ``events`` and ``nation`` tables.

Every view uses every event. A view that must hold copies (processing reads all snapshots again
on each run) holds each row twice. Nested snapshots gather at most 16 consecutive events, so no
array grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import processing
from ..session import pin_utc

ROUTES = ("click", "error", "purchase", "signup", "view")
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
NATION = "n_nationkey int, n_name string, n_regionkey int"
AS_OF = "2024-01-20 00:00:00"
SNAPSHOT_EVENTS = 16
RESPONSE_HOURS = 24


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.schema(NATION).parquet(f"{sf_dir}/nation.parquet").select(
        text("n_nationkey").alias("stop_id"),
        F.col("n_name").alias("stop_name"),
        text("n_regionkey").alias("line"),
        F.when(F.col("n_nationkey") % 2 == 0, "Northbound").otherwise("Southbound").alias("direction"),
    )


def _source(spark: SparkSession, sf_dir: str, source: DataFrame | None) -> DataFrame:
    """The events table, or a frame with its columns (the streams pass theirs)."""
    return events(spark, sf_dir) if source is None else source


def _common(prefix: str = "f") -> list[Column]:
    return [
        F.concat(F.lit(prefix), F.col("event_id") % 50).alias("source_file"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("feed_seq"),
    ]


def _every(divisor: int) -> Column:
    return F.col("event_id") % divisor == 0


def arrival() -> Column:
    return F.when(~_every(11), F.floor(F.col("value") * 5).cast("int"))


def departure() -> Column:
    return F.when(~_every(7), F.floor(F.col("value") * 4).cast("int"))


def raw_delays(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    return _source(spark, sf_dir, source).select(
        text("user_id").alias("vehicle_id"),
        text(F.col("event_id") % 500).alias("trip_id"),
        F.col("event_type").alias("route_id"),
        text(F.col("user_id") % 30).alias("stop_id"),
        arrival().alias("arrival_delay"),
        departure().alias("departure_delay"),
        *_common(),
    )


def _epoch() -> Column:
    return F.unix_seconds("ts")


def alert_routes() -> Column:
    other = F.get(F.array(*[F.lit(route) for route in ROUTES]), (F.col("user_id") % 5).cast("int"))
    return F.array_sort(F.array_distinct(F.array(F.col("event_type"), other)))


def alert_start() -> Column:
    return F.when(~_every(13), _epoch() + (F.col("event_id") % 144 - 72) * 3600)


def alert_end() -> Column:
    return F.when(~_every(13) & ~_every(5), _epoch() + F.col("event_id") % 200 * 3600)


def raw_alerts(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    return _source(spark, sf_dir, source).select(
        F.concat(F.lit("A"), F.col("user_id")).alias("alert_id"),
        alert_routes().alias("route_ids"),
        F.concat(F.lit("H"), F.col("user_id") % 12).alias("header"),
        F.repeat(F.col("props"), 30).alias("description"),
        (F.col("user_id") % 13).cast("int").alias("effect"),
        alert_start().alias("start_time"),
        alert_end().alias("end_time"),
        *_common(),
    )


def raw_positions(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    return _source(spark, sf_dir, source).select(
        text("user_id").alias("vehicle_id"),
        text(F.col("event_id") % 500).alias("trip_id"),
        F.col("event_type").alias("route_id"),
        F.concat(F.lit("S"), F.col("user_id") % 2).alias("stop_id"),
        (F.col("event_id") % 40).cast("int").alias("current_stop_sequence"),
        (F.col("event_id") % 3).cast("int").alias("current_status"),
        F.when(~_every(3), (F.col("event_id") % 7).cast("int")).alias("occupancy_status"),
        _epoch().alias("mta_timestamp"),
        *_common(),
    )


def _temperature() -> Column:
    return F.floor(F.col("value") * 2 - 50) / 10


def _precip() -> Column:
    return F.when(_every(4), F.col("event_id") % 80 / 10).otherwise(0.0)


def _snowfall() -> Column:
    return F.when(_every(17), 0.5).otherwise(0.0)


def _humidity() -> Column:
    return (F.col("user_id") % 100).cast("double")


def _wind() -> Column:
    return (F.col("event_id") % 90).cast("double")


def _minute_text() -> Column:
    return F.date_format("ts", "yyyy-MM-dd'T'HH:mm")


def raw_weather(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    return _source(spark, sf_dir, source).select(
        _temperature().alias("temperature_c"),
        _humidity().alias("humidity_pct"),
        _precip().alias("precip_mm"),
        _snowfall().alias("snowfall_cm"),
        _wind().alias("wind_speed_kmh"),
        _minute_text().alias("weather_timestamp"),
        *_common("w"),
    )


def twice(df: DataFrame) -> DataFrame:
    """The rows of two runs over the same snapshots."""
    return df.unionAll(df)


def changed(df: DataFrame, **payload: Column) -> DataFrame:
    """Each row and a copy that differs: an hour later where feed_seq is even, an hour earlier else."""
    shift = F.when(F.col("feed_seq") % 2 == 0, F.expr("interval 1 hour")).otherwise(F.expr("interval -1 hour"))
    return df.unionAll(df.withColumns({"event_time": F.col("event_time") + shift, **payload}))


def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processing.clean_delays(raw_delays(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processing.clean_alerts(raw_alerts(spark, sf_dir))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processing.clean_positions(raw_positions(spark, sf_dir))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processing.clean_weather(raw_weather(spark, sf_dir))


def _struct(**fields: Column) -> Column:
    return F.struct(*[column.alias(name) for name, column in fields.items()])


def _in_order(*fields: Column) -> Column:
    """The group's rows by event id. A group is a fixed number of consecutive event ids."""
    return F.array_sort(F.collect_list(F.struct("event_id", *fields)))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of 16 consecutive events; each event is a trip, a vehicle and an alert entity."""
    nothing = F.lit(None)
    trip = _struct(trip_id=text(F.col("event_id") % 500), route_id=F.col("event_type"))
    late = "struct<delay:int>"

    def event(delay: Column) -> Column:
        return F.when(delay.isNotNull(), _struct(delay=delay)).cast(late)

    here = _struct(stop_id=text(F.col("user_id") % 30), arrival=event(arrival()), departure=event(departure()))
    after = _struct(
        stop_id=text((F.col("user_id") + 1) % 30), arrival=event(arrival() + 30), departure=nothing.cast(late)
    )
    trip_update = _struct(trip=trip, stop_time_update=F.array(here, after))
    vehicle = _struct(
        trip=trip,
        stop_id=F.concat(F.lit("S"), F.col("user_id") % 2),
        current_stop_sequence=(F.col("event_id") % 40).cast("int"),
        current_status=(F.col("event_id") % 3).cast("int"),
        occupancy_status=F.when(~_every(3), (F.col("event_id") % 7).cast("int")),
        timestamp=_epoch(),
    )
    text_type = "struct<translation: array<struct<text: string>>>"
    header = F.when(~_every(9), _struct(translation=F.array(_struct(text=F.concat(F.lit("H"), F.col("user_id") % 12)))))
    period = _struct(start=alert_start(), end=alert_end())
    alert = _struct(
        informed_entity=F.transform(
            F.array(F.col("event_type"), F.element_at(alert_routes(), -1), F.col("event_type")),
            lambda route: F.struct(route.alias("route_id")),
        ),
        header_text=header.cast(text_type),
        description_text=nothing.cast(text_type),
        effect=(F.col("user_id") % 13).cast("int"),
        active_period=F.when(alert_start().isNotNull(), F.array(period)),
    )
    rows = events(spark, sf_dir).select(
        "event_id",
        F.floor(F.col("event_id") / SNAPSHOT_EVENTS).alias("snapshot"),
        _epoch().alias("second"),
        trip_update.alias("trip_update"),
        vehicle.alias("vehicle"),
        alert.alias("alert"),
        text("user_id").alias("vehicle_id"),
        F.concat(F.lit("A"), F.col("user_id")).alias("alert_id"),
    )
    types = dict(rows.dtypes)

    def entity(row: Column, id_field: str, payload: str) -> Column:
        parts = [
            (row[name] if name == payload else F.lit(None).cast(types[name])).alias(name)
            for name in ("trip_update", "vehicle", "alert")
        ]
        return F.struct(row[id_field].alias("id"), *parts)

    grouped = rows.groupBy("snapshot").agg(
        F.min("second").alias("second"),
        _in_order(*[F.col(name) for name in ("trip_update", "vehicle", "alert", "vehicle_id", "alert_id")]).alias("rows"),
    )
    entities = F.flatten(
        F.transform(
            "rows",
            lambda row: F.array(
                entity(row, "vehicle_id", "trip_update"),
                entity(row, "vehicle_id", "vehicle"),
                entity(row, "alert_id", "alert"),
            ),
        )
    )
    return grouped.select(
        F.concat(F.lit("s"), F.col("snapshot")).alias("source_file"),
        _struct(timestamp=F.col("second")).alias("header"),
        entities.alias("entity"),
    )


def feed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots of ``feed`` with each entity once more at the end."""
    return feed(spark, sf_dir).withColumn("entity", F.concat("entity", "entity"))


def weather_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of 24 consecutive events as parallel arrays; every tenth states only its last one."""
    fields = {
        "time": _minute_text(),
        "temperature_2m": _temperature(),
        "relative_humidity_2m": _humidity(),
        "precipitation": _precip(),
        "snowfall": _snowfall(),
        "wind_speed_10m": _wind(),
    }
    rows = events(spark, sf_dir).select(
        "event_id",
        F.floor(F.col("event_id") / RESPONSE_HOURS).alias("response"),
        "ts",
        *[column.alias(name) for name, column in fields.items()],
    )
    grouped = rows.groupBy("response").agg(
        F.min("ts").alias("event_time"), _in_order(*[F.col(name) for name in fields]).alias("rows")
    )
    last = F.element_at("rows", -1)
    hourly = F.struct(*[F.col(f"rows.{name}").alias(name) for name in fields])
    current = F.struct(*[last[name].alias(name) for name in fields])
    only_current = F.col("response") % 10 == 0
    return grouped.select(
        F.concat(F.lit("w"), F.col("response")).alias("source_file"),
        F.date_trunc("second", "event_time").alias("event_time"),
        F.when(~only_current, hourly).alias("hourly"),
        F.when(only_current, current).alias("current"),
    )

