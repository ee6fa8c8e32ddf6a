"""Delay windows kept by a watermarked streaming aggregation, and late rows counted all the same.

Spark holds the sums of the windows that are still open; when the watermark passes a window's end its
state is dropped, and rows that come after that would be lost. The stream therefore carries the rows beside
the updated windows: they are stored as runs of the processed table, and only windows that a row is
late for are computed again, from the stored rows of their dates. Everything else comes from state.

Which rows are late is judged by the newest time of the earlier batches, noted beside the stored rows. That is never
below Spark's own watermark, so each row that Spark may have dropped is among them; a window that is computed
again takes the place of what the state says about it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..fixed_values import WINDOW_MINUTES
from ..operators import aggregates
from ..sources import sinks
from ..sources.scan import load_or_empty
from ..sources.storage import remove_folder
from ..sources.tables import read_processed
from .sinks import BatchWriter, batch_run
from .windows import dates_of, read_windows, replace_dates

WINDOWS = "route_id string, window_start timestamp, avg_delay_sec double, max_delay_sec int, delay_records bigint"
KIND = "kind"
LENGTH = f"{WINDOW_MINUTES} minutes"


def windows_and_rows(delays: DataFrame, lateness: str) -> DataFrame:
    """A stream of cleaned delays as (kind, window, row): updated windows from state, and the rows themselves.

    For update mode. ``lateness`` is how long a window stays open after its end, such as "1 hour".
    """
    timed = delays.withWatermark("event_time", lateness)
    grouped = aggregates.delays_by_window(timed, [F.window("event_time", LENGTH).alias("_window"), "route_id"])
    names = [field.split()[0] for field in WINDOWS.split(", ")]
    window = F.struct(*[F.col("_window.start").alias(name) if name == "window_start" else F.col(name) for name in names])
    rows = timed.select(F.lit("row").alias(KIND), F.struct(*timed.columns).alias("row"))
    windows = grouped.select(F.lit("window").alias(KIND), window.alias("window"))
    return windows.unionByName(rows, allowMissingColumns=True)


def _noted_newest(spark: SparkSession, state: str, batch_id: int) -> Column | None:
    """The newest event time of the batches before; None before the first one with a time."""
    note = f"{state}/newest/{batch_run(batch_id - 1)}"
    rows = load_or_empty(spark, lambda: spark.read.schema("newest timestamp").parquet(note), "newest timestamp").collect()
    return F.lit(rows[0]["newest"]) if rows and rows[0]["newest"] is not None else None


def event_time_upserts(path: str, table: str, state: str, lateness: str) -> BatchWriter:
    """Write batches of ``windows_and_rows``: rows as runs below ``path``, windows into ``table``.

    ``state`` is a folder for the notes. A replayed batch replaces its run and its note, and gives the
    same windows again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, staged = batch.sparkSession, f"{state}/staged/{batch_run(batch_id)}"
        newest = Observation()
        # The batch is run once, as that updates the state; its two kinds are read back from here.
        observed = batch.observe(newest, F.max("row.event_time").alias("newest"))
        observed.write.mode("overwrite").partitionBy(KIND).parquet(staged)
        both = spark.read.schema(batch.schema).parquet(staged)
        rows = both.filter(F.col(KIND) == "row").select("row.*")
        windows = both.filter(F.col(KIND) == "window").select("window.*")
        sinks.save_processed(rows, path, batch_run(batch_id))

        before = _noted_newest(spark, state, batch_id)
        _merge(spark, rows, windows, path, table, None if before is None else before - F.expr(f"interval {lateness}"))

        latest = F.lit(newest.get["newest"]).cast("timestamp")
        note = spark.range(1).select((latest if before is None else F.greatest(latest, before)).alias("newest"))
        note.coalesce(1).write.mode("overwrite").parquet(f"{state}/newest/{batch_run(batch_id)}")
        remove_folder(spark, staged)

    return write


def _same_window() -> Column:
    return F.col("a.route_id").eqNullSafe(F.col("b.route_id")) & F.col("a.window_start").eqNullSafe(F.col("b.window_start"))


def _without(windows: DataFrame, others: DataFrame) -> DataFrame:
    return windows.alias("a").join(others.alias("b"), _same_window(), "left_anti")


def late_windows(rows: DataFrame, watermark: Column | None) -> DataFrame:
    """The windows of rows that came after the watermark passed them; rows without a time have no window in state."""
    late = F.col("event_time").isNull()
    if watermark is not None:
        late = late | (F.col("window_start") + F.expr(f"interval {LENGTH}") <= watermark)
    return rows.filter(late).select("route_id", "window_start").distinct()


def _merge(spark: SparkSession, rows: DataFrame, windows: DataFrame, path: str, table: str, watermark: Column | None) -> None:
    late = late_windows(rows, watermark)
    dates = dates_of(late, "window_start")
    changed = windows
    if dates:
        stored = aggregates.delays_by_window(read_processed(spark, path, schemas.DELAYS, dates=dates))
        again = stored.alias("a").join(late.alias("b"), _same_window(), "left_semi")
        changed = _without(windows, late).unionByName(again.select(*windows.columns))
    touched = dates | dates_of(windows, "window_start")
    if touched:
        kept = _without(read_windows(spark, table, touched, WINDOWS), changed)
        replace_dates(kept.unionByName(changed), table, touched)
