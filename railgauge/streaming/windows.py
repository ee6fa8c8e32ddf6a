"""Window tables kept up to date from arriving rows, whatever their lateness.

A micro-batch is cleaned and stored as a run of its processed table; then the dates it touches are
computed again from the stored rows and replaced. A window lies within one date, so that gives the
batch result: nothing is dropped for being late, and no state grows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import aggregates
from ..operators.filters import unnest_routes
from ..operators.joins import join_stops, join_weather
from ..plans.processing import clean_alerts, clean_delays
from ..sources import sinks, versions
from ..sources.scan import load_or_empty
from ..sources.tables import DATE_COLUMN, NO_DATE, read_processed, run_path
from .sinks import BatchWriter, batch_run

Clean = Callable[[DataFrame], DataFrame]


def window_date() -> Column:
    return F.coalesce(F.to_date("window_start"), F.lit(NO_DATE))


def dates_of(rows: DataFrame, column: str | Column = DATE_COLUMN) -> set[date]:
    """The distinct dates of a column, a bounded handful; rows without one count as NO_DATE."""
    column = F.col(column) if isinstance(column, str) else column
    return {row[0] for row in rows.select(F.coalesce(column.cast("date"), F.lit(NO_DATE))).distinct().collect()}


def run_dates(spark: SparkSession, path: str, run_id: str) -> set[date]:
    """The dates that a run has written, from the names of its folders."""
    layout = f"{DATE_COLUMN} date"
    return dates_of(load_or_empty(spark, lambda: spark.read.schema(layout).parquet(run_path(path, run_id)), layout))


def date_parts(dates: Iterable[date]) -> list[str]:
    return [versions.part(**{DATE_COLUMN: day.isoformat()}) for day in dates]


def replace_dates(table: DataFrame, path: str, dates: set[date]) -> None:
    """Replace those dates of a window table in one step; a date without rows is left empty."""
    dated = table.withColumn(DATE_COLUMN, window_date()).hint("rebalance", DATE_COLUMN)
    versions.replace(dated, path, [DATE_COLUMN], date_parts(dates))


def read_windows(spark: SparkSession, path: str, dates: set[date] | None = None, schema: str | None = None) -> DataFrame:
    """A window table, or some dates of it; ``schema`` is that of a table not yet written."""
    layout = None if schema is None else f"{schema.rstrip()}, {DATE_COLUMN} date"
    return versions.read(spark, path, layout, None if dates is None else date_parts(dates)).drop(DATE_COLUMN)


def window_batches(path: str, schema: str, clean: Clean, build: Clean, table: str) -> BatchWriter:
    """Store each cleaned batch as a run below ``path`` and keep ``table``, what ``build`` makes of its rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, batch_run(batch_id)
        sinks.save_processed(clean(batch), path, run)
        touched = run_dates(spark, path, run)
        if touched:
            replace_dates(build(read_processed(spark, path, schema, dates=touched)), table, touched)

    return write


def delay_windows(path: str, table: str) -> BatchWriter:
    """Raw delays to the delay windows. A snapshot file arrives whole, so copies meet in its batch."""
    return window_batches(path, schemas.DELAYS, clean_delays, aggregates.delays_by_window, table)


def alert_windows(path: str, table: str) -> BatchWriter:
    """Raw alerts to the alerts per window."""

    def build(alerts: DataFrame) -> DataFrame:
        return aggregates.alert_count_by_window(unnest_routes(alerts))

    return window_batches(path, schemas.ALERTS, clean_alerts, build, table)


def named_delays_stream(delays: DataFrame, stops: DataFrame) -> DataFrame:
    """Stream to static: stop names onto each micro-batch."""
    return join_stops(delays, stops)


def weather_onto_windows(windows: DataFrame, weather: DataFrame) -> DataFrame:
    """Hourly weather (one row per hour) onto windows, of a batch or a table."""
    return join_weather(windows, weather)


def between_dates(column: str, dates: Iterable[date]) -> Column:
    """Rows of those dates. The plain range in front reaches the scan's statistics."""
    dates = sorted(set(dates) - {NO_DATE})
    without = F.col(column).isNull()
    if not dates:
        return without
    low, high = (F.lit(d).cast("timestamp") for d in (dates[0], dates[-1]))
    within = (F.col(column) >= low) & (F.col(column) < high + F.expr("interval 1 day"))
    return (within & F.to_date(column).isin(*dates)) | without
