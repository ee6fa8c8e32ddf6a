"""Processed tables, the stops seed, the table catalog, discovery of new files."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from datetime import date
from importlib.resources import as_file, files
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from . import versions
from .scan import load_or_empty

# Layout columns the writers add; readers prune on them and leave them out of the contract.
RUN_COLUMN = "run_id"
DATE_COLUMN = "event_date"
NO_DATE = date(1970, 1, 1)
# Below a processed table: the part that a stream replaces in place (see ``versions``). Spark's readers pass it over.
STREAM_FOLDER = "_stream"

# Logical table names, their folders below a processed root, and their contracts.
TABLES = {
    "delays": schemas.DELAYS,
    "alerts": schemas.ALERTS,
    "weather": schemas.WEATHER,
    "vehicle_positions": schemas.POSITIONS,
}


def read_processed(
    spark: SparkSession,
    path: str,
    schema: str,
    since: date | str | None = None,
    until: date | str | None = None,
    dates: Iterable[date] | None = None,
) -> DataFrame:
    """Every run below ``path`` and what a stream keeps there; a table that was never written reads as empty.

    ``since`` and ``until`` (inclusive), or a set of ``dates``, prune whole date folders before any file is
    opened; NO_DATE stands for rows without a time.
    """
    layout = f"{schema.rstrip()}, {RUN_COLUMN} string, {DATE_COLUMN} date"
    table = load_or_empty(spark, lambda: spark.read.schema(layout).parquet(path), layout)
    kept = f"{path.rstrip('/')}/{STREAM_FOLDER}"
    if parts := versions.part_names(spark, kept):
        if dates is not None:
            parts = {name for name in parts if part_date(name) in set(dates)}
        streamed = versions.read(spark, kept, parts=parts).withColumn(RUN_COLUMN, F.lit(STREAM_FOLDER))
        table = table.unionByName(streamed.select(*table.columns))
    if since is not None:
        table = table.filter(F.col(DATE_COLUMN) >= F.lit(since).cast("date"))
    if until is not None:
        table = table.filter(F.col(DATE_COLUMN) <= F.lit(until).cast("date"))
    if dates is not None:
        wanted = F.col(DATE_COLUMN).isin(*dates)
        table = table.filter(wanted | F.col(DATE_COLUMN).isNull() if NO_DATE in set(dates) else wanted)
    return table.drop(RUN_COLUMN, DATE_COLUMN)


def part_date(name: str) -> date:
    """The date in the name of a stored part."""
    return date.fromisoformat(name.split("/")[0].removeprefix(f"{DATE_COLUMN}="))


def run_path(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/{RUN_COLUMN}={run_id}"


def vehicle_date(ts: Column) -> Column:
    """The layout date of positions, in batch and stream: that of the vehicle time."""
    return F.coalesce(F.to_date(ts), F.lit(NO_DATE))


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    """A stops seed: CSV with a header line; lines that start with # are remarks."""
    return spark.read.schema(schemas.STOPS).option("header", "true").option("comment", "#").csv(path)


def default_stops(spark: SparkSession) -> DataFrame:
    """The packaged seed. It is read here, so executors need not see the package folder."""
    with as_file(files("railgauge") / "seeds" / "stops.csv") as seed, Path(seed).open(encoding="utf-8", newline="") as lines:
        rows = list(csv.reader(line for line in lines if line.strip() and not line.startswith("#")))[1:]
    return spark.createDataFrame([tuple(row) for row in rows], schemas.STOPS)


def processed_paths(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{name}" for name in TABLES}


def open_catalog(spark: SparkSession, root: str, **between: date | str | None) -> dict[str, DataFrame]:
    """Logical name to DataFrame for the four processed tables; also registers each as a view."""
    catalog = {
        name: read_processed(spark, path, TABLES[name], **between) for name, path in processed_paths(root).items()
    }
    for name, table in catalog.items():
        table.createOrReplaceTempView(name)
    return catalog


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below ``path`` (listing only: the content column is never read)."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return listing.select(F.col("path").alias("source_file"), "modificationTime", "length")


def new_files(listing: DataFrame, processed: DataFrame) -> DataFrame:
    """Files of the listing that no processed row came from, matched by full path.

    The processed side holds one path many times; a semi or anti join needs no distinct, but
    reducing it first keeps the shuffle at one row per path and map task.
    """
    return listing.join(processed.select("source_file").distinct(), "source_file", "left_anti")
