"""Weather responses: hourly parallel arrays, or one current observation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.times import file_instant, parse_local
from ..operators.dedup import first_in_array
from .scan import load_or_empty

# Response field to table column.
MEASURES = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "humidity_pct",
    "precipitation": "precip_mm",
    "snowfall": "snowfall_cm",
    "wind_speed_10m": "wind_speed_kmh",
}

STORED_RESPONSE = f"{schemas.WEATHER_RESPONSE.rstrip()}, source_file string, event_time timestamp"


def read_weather(spark: SparkSession, path: str, glob: str = "*.json", multi_line: bool = False) -> DataFrame:
    """All responses below ``path`` with their file and poll time.

    One response per line; ``multi_line`` reads responses written over several lines, one per
    file. The poll time comes from the file (its name, else its modification time), so that
    reading the same files again gives the same rows.
    """
    reader = (
        spark.read.schema(STORED_RESPONSE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("multiLine", str(multi_line).lower())
        .option("mode", "FAILFAST")
    )
    return load_or_empty(spark, lambda: _with_poll(reader.json(path)), STORED_RESPONSE)


def stream_weather(spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None) -> DataFrame:
    """New responses as they land, in any folder below ``path``, which must exist."""
    reader = spark.readStream.schema(STORED_RESPONSE).format(fmt).option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", f"*.{fmt}*").option("mode", "FAILFAST")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_poll(reader.load(path))


def _with_poll(responses: DataFrame) -> DataFrame:
    """File and poll time; rows that state theirs (compacted landing files) keep them."""
    path = F.col("_metadata.file_path")
    polled = file_instant(path, F.col("_metadata.file_modification_time"))
    return responses.withColumns(
        {"source_file": F.coalesce("source_file", path), "event_time": F.coalesce("event_time", polled)}
    )


def hourly_rows(responses: DataFrame) -> DataFrame:
    """One row per hour of the parallel arrays; the time array says how many hours there are."""
    arrays = [F.col("hourly.time").alias("time")] + [F.col(f"hourly.{field}").alias(field) for field in MEASURES]
    hours = responses.filter(F.col("hourly").isNotNull()).select(
        "source_file",
        "event_time",
        F.size("hourly.time").alias("hours"),
        F.posexplode(F.arrays_zip(*arrays)).alias("hour_pos", "hour"),
    )
    return hours.filter(F.col("hour_pos") < F.col("hours")).select(
        *[F.col(f"hour.{field}").alias(name) for field, name in MEASURES.items()],
        F.col("hour.time").alias("weather_timestamp"),
        "source_file",
        "event_time",
        F.col("hour_pos").cast("bigint").alias("feed_seq"),
    )


def current_rows(responses: DataFrame) -> DataFrame:
    """One row per response that has no hourly part."""
    current = responses.filter(F.col("hourly").isNull() & F.col("current").isNotNull())
    return current.select(
        *[F.col(f"current.{field}").alias(name) for field, name in MEASURES.items()],
        F.col("current.time").alias("weather_timestamp"),
        "source_file",
        "event_time",
        F.lit(0).cast("bigint").alias("feed_seq"),
    )


def load_raw_weather(responses: DataFrame) -> DataFrame:
    return hourly_rows(responses).unionByName(current_rows(responses))


def first_raw_weather(responses: DataFrame) -> DataFrame:
    """``load_raw_weather`` with the first row of each hour of a response only, without a shuffle.

    Hours are one where they are the same time, however it is written; the first keeps its place. What
    deduplication by hour and file gives where each file is one response.
    """
    arrays = [F.col("hourly.time").alias("time")] + [F.col(f"hourly.{field}").alias(field) for field in MEASURES]
    hours = F.slice(F.arrays_zip(*arrays), 1, F.greatest(F.size("hourly.time"), F.lit(0)))
    first = first_in_array(hours, lambda hour: F.struct(parse_local(hour["time"]).alias("time")))
    once = responses.filter(F.col("hourly").isNotNull()).select("source_file", "event_time", F.inline(first))
    hourly = once.select(
        *[F.col(field).alias(name) for field, name in MEASURES.items()],
        F.col("time").alias("weather_timestamp"),
        "source_file",
        "event_time",
    )
    return hourly.unionByName(current_rows(responses).drop("feed_seq"))
