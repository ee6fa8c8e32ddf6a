"""Processed tables kept up to date from newly landed snapshots only.

A snapshot file arrives whole in one micro-batch, and delays, alerts and weather are deduplicated
within a file. So cleaning each batch on its own gives the rows that cleaning all of history would.
Gaps between positions reach across files; ``headway_tables`` takes care of those.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as fv
from ..plans import refresh
from ..plans.processing import clean_alerts, clean_delays, clean_weather
from ..sources import feeds, sinks
from ..sources.scan import load_or_empty
from ..sources.tables import processed_paths
from ..sources.weather import load_raw_weather, stream_weather
from .headway import headway_tables
from .sinks import BatchWriter, batch_run, run_stream


@dataclass(frozen=True)
class Landing:
    """Folders that snapshots land in, at any depth."""

    trip_updates: str
    alerts: str
    vehicle_positions: str
    weather: str


def processed_batches(
    path: str, clean: Callable[[DataFrame], DataFrame], noted: Callable[[DataFrame, int], None] | None = None
) -> BatchWriter:
    """Add each cleaned batch as a run of its own, checked like any run; a replay replaces it.

    ``noted`` is told the stored rows of each batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch)
        folder = sinks.save_processed(rows, path, batch_run(batch_id))
        if noted is not None:
            noted(load_or_empty(batch.sparkSession, lambda: batch.sparkSession.read.schema(rows.schema).parquet(folder), rows.schema), batch_id)

    return write


def process_streams(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    state: str,
    source_tz: str | None = None,
    interval: str | None = None,
    changes: str | None = None,
    features: str | None = None,
) -> list[StreamingQuery]:
    """Start one stream of raw rows per processed table below ``root``.

    ``changes`` is a folder in which each batch notes the window dates it touches, for ``plans.refresh``. With
    ``features`` each batch of any of the streams also brings the stored features of those dates up to date, so
    the joined windows follow all inputs without a call from outside. Batches take turns at that.
    """
    turn = Lock()
    paths = processed_paths(root)
    cleaners = {"delays": clean_delays, "alerts": clean_alerts, "weather": partial(clean_weather, source_tz=source_tz)}

    def noted(name: str) -> Callable[[DataFrame, int], None] | None:
        def note(rows: DataFrame, batch_id: int) -> None:
            run = batch_run(batch_id)
            with turn:
                refresh.log_changes(spark, changes, name, run, refresh.changed_dates(spark, changes, name, run, rows))
                if features:
                    refresh.refresh(spark, root, changes, features)

        return note if changes else None

    writers = {name: processed_batches(paths[name], clean, noted(name)) for name, clean in cleaners.items()}
    writers["vehicle_positions"] = headway_tables(
        f"{state}/stored_positions", paths["vehicle_positions"], noted("vehicle_positions")
    )
    return [run_stream(rows, writers[name], f"{state}/checkpoints/{name}", "append", interval) for name, rows in raw.items()]


def process_new(
    spark: SparkSession,
    landing: Landing,
    root: str,
    state: str,
    routes: Sequence[str] | None = fv.DEFAULT_ROUTES,
    fmt: str = "json",
    source_tz: str | None = None,
    interval: str | None = None,
    max_files: int | None = None,
    changes: str | None = None,
    features: str | None = None,
) -> list[StreamingQuery]:
    """Start one stream per processed table below ``root``.

    ``state`` holds the checkpoints (which files were seen) and the stored positions. Without an
    ``interval`` the streams take what has landed and stop. The tables read like those of
    ``warehouse.process``, through ``open_catalog``.
    """
    feed = partial(feeds.stream_feed, spark, fmt=fmt, max_files=max_files)
    raw = {
        "delays": feeds.load_raw_delays(feed(landing.trip_updates), routes),
        "alerts": feeds.load_raw_alerts(feed(landing.alerts), routes),
        "vehicle_positions": feeds.load_raw_positions(feed(landing.vehicle_positions), routes),
        "weather": load_raw_weather(stream_weather(spark, landing.weather, fmt, max_files)),
    }
    return process_streams(spark, raw, root, state, source_tz, interval, changes, features)
