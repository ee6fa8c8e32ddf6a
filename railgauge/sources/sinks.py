"""Writers. Each write is a Spark job committed as a whole; row counts are checked after it."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import versions
from .storage import WriteValidationError, remove_folder, validate_count
from .tables import DATE_COLUMN, run_path


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")


def save_processed(
    df: DataFrame,
    path: str,
    run_id: str | None = None,
    time_column: str | Column = "event_time",
    rebalance: bool = True,
) -> str:
    """Add one run to a processed table, laid out by date (of a time column, or a date), and check its row count.

    * Every run has its own folder, written in overwrite mode: repeating a run id replaces
      that run instead of doubling it.
    * The rebalance hint gathers each date into few files; dates too big for one task are
      split by adaptive execution, small ones share a task.
    * The count is observed directly above the write, where each partition counts once even
      if a task is retried. A run that fails the check is removed again.
    """
    spark = df.sparkSession
    folder = run_path(path, run_id or new_run_id())
    dated = df.withColumn(DATE_COLUMN, F.to_date(time_column) if isinstance(time_column, str) else time_column)
    if rebalance:
        dated = dated.hint("rebalance", DATE_COLUMN)
    counted = Observation()
    dated.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy(DATE_COLUMN).parquet(folder)
    try:
        validate_count(spark, folder, counted.get["rows"], dated)
    except Exception:
        remove_folder(spark, folder)
        raise
    return folder


def save_features(df: DataFrame, path: str) -> str:
    """Replace the feature table in one step (``versions.read`` finds the newest); returns the folder of this state."""
    versions.replace(df, path)
    return versions.location(df.sparkSession, path)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """A named plan: nothing runs until it is read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A stored table, replaced as a whole; ``path`` keeps the files outside the warehouse folder.

    The new state is written beside the old one and the catalog entry is pointed at it, so a query of the name
    reads either. A table of other columns is registered anew.
    """
    spark = df.sparkSession
    root = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}_versions"
    versions.replace(df, root)
    folder = versions.location(spark, root).replace("'", "\\'")
    columns = [(field.name, field.dataType) for field in df.schema.fields]
    if spark.catalog.tableExists(name):
        if [(field.name, field.dataType) for field in spark.table(name).schema.fields] == columns:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return spark.table(name)
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=versions.location(spark, root), source="parquet", schema=df.schema)
    return spark.table(name)


def land_snapshots(snapshots: DataFrame, root: str, polled_at: str | None = None, fmt: str = "parquet") -> str:
    """Put raw snapshots into a landing folder named after the poll time; landed files never change."""
    path = f"{root.rstrip('/')}/poll_{polled_at or new_run_id()}"
    snapshots.write.mode("errorifexists").format(fmt).save(path)
    return path


__all__ = [
    "WriteValidationError",
    "land_snapshots",
    "materialize_table",
    "materialize_view",
    "new_run_id",
    "remove_folder",
    "save_features",
    "save_processed",
    "validate_count",
]
