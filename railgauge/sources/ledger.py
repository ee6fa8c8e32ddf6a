"""Which landed files have been processed, kept by landing date.

Polls land in folders named after their time. The ledger holds name, size and modification time of the processed files
in one part per date, so a poll lists the folders of its own dates, compares them with the same parts, and
opens neither older folders nor the processed rows. A file that has changed under a name already processed is told
apart from a new one: landed files are meant never to change.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions
from .scan import load_or_empty
from .tables import DATE_COLUMN, list_files

FILES = f"source_file string, modificationTime timestamp, length bigint, {DATE_COLUMN} date"
NEW, CHANGED = "new", "changed"


def _parts(dates: Iterable[date]) -> list[str]:
    return [versions.part(**{DATE_COLUMN: day.isoformat()}) for day in dates]


def landed_files(spark: SparkSession, landing: str, dates: Iterable[date], glob: str = "*") -> DataFrame:
    """The files of the polls of some dates; other folders are not listed. A date without polls has none."""
    found = spark.createDataFrame([], FILES)
    for day in sorted(set(dates)):
        pattern = f"{landing.rstrip('/')}/poll_{day:%Y%m%d}*"
        files = load_or_empty(spark, lambda p=pattern: list_files(spark, p, glob), FILES.rsplit(",", 1)[0])
        found = found.unionByName(files.withColumn(DATE_COLUMN, F.lit(day)))
    return found


def open_files(spark: SparkSession, landing: str, ledger: str, dates: Iterable[date], glob: str = "*.*") -> DataFrame:
    """The files of those dates that are to be processed, with state: new, or changed since they were."""
    dates = set(dates)
    known = versions.read(spark, ledger, FILES, _parts(dates)).select(
        "source_file", F.col("length").alias("_length"), F.col("modificationTime").alias("_modified")
    )
    files = landed_files(spark, landing, dates, glob).join(known, "source_file", "left")
    same = (F.col("length") == F.col("_length")) & (F.col("modificationTime") == F.col("_modified"))
    state = F.when(F.col("_length").isNull(), NEW).when(~same, CHANGED)
    return files.withColumn("state", state).filter("state is not null").drop("_length", "_modified")


def record_files(files: DataFrame, ledger: str) -> None:
    """Enter files as processed, in place of what the ledger says about the same names; safe to repeat."""
    spark = files.sparkSession
    rows = files.select("source_file", "modificationTime", "length", DATE_COLUMN)
    dates = {row[0] for row in rows.select(DATE_COLUMN).distinct().collect()}
    if dates:
        old = versions.read(spark, ledger, FILES, _parts(dates)).join(rows.select("source_file"), "source_file", "left_anti")
        versions.replace(old.unionByName(rows).coalesce(1), ledger, [DATE_COLUMN], _parts(dates))
