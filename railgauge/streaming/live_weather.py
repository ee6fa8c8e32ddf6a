"""Windows joined to weather while both arrive.

Two streams share one table of joined windows. A batch of delays joins its dates to the weather as it is stored by
then; a batch of weather merges its hours into the stored weather and joins their dates again, so weather that
comes after its windows still reaches them. Both read what the other has committed, and take turns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from ..operators import dedup
from ..operators.joins import join_weather
from ..plans import latest
from ..plans.processing import clean_weather
from .event_time import WINDOWS
from .sinks import BatchWriter, batch_run
from .windows import delay_windows, read_windows, replace_dates, run_dates

COLUMNS = ("temperature_c",)


def join_dates(spark: SparkSession, windows: str, weather: str, table: str, dates: set[date], columns: Sequence[str] = COLUMNS) -> None:
    """Replace the joined windows of some dates by what the two stored tables say now."""
    hourly = latest.latest_weather(spark, weather, dates).select("obs_hour", *columns)
    replace_dates(join_weather(read_windows(spark, windows, dates, WINDOWS), hourly), table, dates)


def live_weather(root: str, table: str, columns: Sequence[str] = COLUMNS, source_tz: str | None = None) -> tuple[BatchWriter, BatchWriter]:
    """Writers for a stream of raw delays and one of raw weather; ``table`` has the windows with the weather of their hour.

    Runs of delays, their windows and the weather by hour (of the newest poll) are kept below ``root``. Replayed
    batches change nothing.
    """
    runs, windows, weather = (f"{root}/{name}" for name in ("delays", "windows", "weather"))
    store_windows, turn = delay_windows(runs, windows), Lock()

    def write_delays(batch: DataFrame, batch_id: int) -> None:
        store_windows(batch, batch_id)
        dates = run_dates(batch.sparkSession, runs, batch_run(batch_id))
        if dates:
            with turn:
                join_dates(batch.sparkSession, windows, weather, table, dates, columns)

    def write_weather(batch: DataFrame, batch_id: int) -> None:
        with turn:
            dates = latest.upsert_weather(clean_weather(batch, source_tz), weather, dedup.latest_weather_snapshot)
            if dates:
                join_dates(batch.sparkSession, windows, weather, table, dates, columns)

    return write_delays, write_weather
