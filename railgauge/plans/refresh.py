"""Features kept by date: only the dates that new rows touch are computed again.

Processed tables grow by runs and micro-batches. What changes with new rows is noted here as window
dates: their own, and for positions those of other copies of the same positions. The tables
are laid out by window date, and just those folders are replaced, so readers can prune on them too.

Positions lie under the date of the vehicle time, while windows follow the snapshot's. Notes of positions therefore
come with an index of which vehicle dates hold the rows of a window date, a few rows per run.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scan import load_or_empty
from ..sources.tables import TABLES, processed_paths, read_processed, vehicle_date
from ..streaming.windows import between_dates, dates_of, replace_dates, window_date
from . import marts

DONE, INDEX = "_done", "_vehicle_dates"
PAIRS = "window_date date, vehicle_date date"


def changed_dates(spark: SparkSession, log: str, name: str, run_id: str, rows: DataFrame) -> set[date]:
    """The window dates that new rows of the processed table ``name`` touch. Positions are indexed on the way."""
    if name == "weather":
        return dates_of(rows, "obs_hour")
    if name != "vehicle_positions":
        return dates_of(rows, "window_start")
    pairs = rows.select(window_date().alias("window_date"), vehicle_date(F.col("mta_timestamp")).alias("vehicle_date")).distinct().collect()
    spark.createDataFrame(pairs, PAIRS).coalesce(1).write.mode("overwrite").parquet(f"{log}{INDEX}/{run_id}")
    return {p["window_date"] for p in pairs} | _indexed(spark, log, "vehicle_date", {p["vehicle_date"] for p in pairs})


def _indexed(spark: SparkSession, log: str, by: str, dates: set[date]) -> set[date]:
    """The dates on the other side of the index."""
    pairs = load_or_empty(spark, lambda: spark.read.schema(PAIRS).option("recursiveFileLookup", "true").parquet(f"{log}{INDEX}"), PAIRS)
    other = "vehicle_date" if by == "window_date" else "window_date"
    return dates_of(pairs.filter(F.col(by).isin(*dates)), other) if dates else set()


def log_changes(spark: SparkSession, log: str, name: str, run_id: str, dates: set[date]) -> None:
    """Note the dates for the next refresh; a repeated run replaces its note."""
    rows = spark.createDataFrame([(d,) for d in sorted(dates)], "window_date date")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{log}/{name}/{run_id}")


def noted_dates(spark: SparkSession, log: str, name: str, run_id: str) -> set[date]:
    """The dates that a run has noted before."""
    layout = "window_date date"
    return dates_of(load_or_empty(spark, lambda: spark.read.schema(layout).parquet(f"{log}/{name}/{run_id}"), layout), "window_date")


def _noted(spark: SparkSession, log: str) -> DataFrame:
    def read() -> DataFrame:
        rows = spark.read.schema("window_date date").option("recursiveFileLookup", "true").parquet(log)
        return rows.select("window_date", F.col("_metadata.file_path").alias("note"))

    return load_or_empty(spark, read, "window_date date, note string")


def pending(spark: SparkSession, log: str) -> tuple[set[date], DataFrame]:
    """Dates noted and not yet refreshed, and the notes they stand in, as they are now: a few rows per run."""
    done = load_or_empty(spark, lambda: spark.read.schema("note string").parquet(f"{log}{DONE}"), "note string")
    rows = _noted(spark, log).join(done, "note", "left_anti").collect()
    names = spark.createDataFrame(sorted({(row["note"],) for row in rows}), "note string")
    return {row["window_date"] for row in rows}, names


def positions_of(spark: SparkSession, root: str, log: str, dates: set[date]) -> DataFrame:
    """All copies of the positions that windows of those dates show."""
    held = _indexed(spark, log, "window_date", dates)
    return read_processed(spark, processed_paths(root)["vehicle_positions"], TABLES["vehicle_positions"], dates=held)


def _rows_of(spark: SparkSession, root: str, log: str, dates: set[date]) -> dict[str, DataFrame]:
    """What the windows of those dates are made of."""
    paths = processed_paths(root)
    weather = read_processed(spark, paths["weather"], TABLES["weather"])
    return {
        "delays": read_processed(spark, paths["delays"], TABLES["delays"], dates=dates),
        "alerts": read_processed(spark, paths["alerts"], TABLES["alerts"], dates=dates),
        "vehicle_positions": positions_of(spark, root, log, dates),
        "weather": weather.filter(between_dates("obs_hour", dates)),
    }


def features_of(spark: SparkSession, root: str, log: str, dates: set[date]) -> DataFrame:
    """The features of those window dates."""
    rows = _rows_of(spark, root, log, dates)
    features = marts.combined_features(rows["delays"], rows["alerts"], rows["weather"], rows["vehicle_positions"])
    return features.filter(window_date().isin(*dates))


def mark_done(spark: SparkSession, log: str, notes: DataFrame) -> None:
    """Take notes off the list; ``notes`` holds one file name per run since the last refresh."""
    notes.coalesce(1).write.mode("append").parquet(f"{log}{DONE}")


def refresh(spark: SparkSession, root: str, log: str, features: str) -> set[date]:
    """Compute the noted dates again and replace them in the stored features. Safe to repeat at any point."""
    dates, notes = pending(spark, log)
    if dates:
        replace_dates(features_of(spark, root, log, dates), features, dates)
        mark_done(spark, log, notes)
    return dates
