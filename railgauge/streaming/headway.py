"""Headway gaps over arriving positions.

A late report changes two gaps: its own and the next one's, and only a gap up to the cap counts. So each
micro-batch is stored, and the hours it touches, with those that the cap reaches after them, are computed
again from the stored rows of these hours and those that the cap reaches before them. That
makes the table equal to the batch result for any lateness, and a replayed batch harmless. The table lies in parts of
some hours; a part's other hours are copied from its last state. All parts of a batch are replaced in one step, so a
reader sees the table before the batch or after it.

Rows without a time lie apart, in parts by a hash of their stop: a batch that has some computes the parts of
its own stops again and no others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .. import schemas
from ..functions.times import from_epoch
from ..plans.processing import clean_positions
from ..sources import versions
from ..sources.scan import load_or_empty
from ..sources.storage import validate_count
from ..sources.tables import DATE_COLUMN, NO_DATE, STREAM_FOLDER, read_processed, vehicle_date
from .sinks import BATCH_COLUMN, BatchWriter

PART_COLUMN = "event_part"
LAYOUT = (DATE_COLUMN, PART_COLUMN)
#: Hours in a part of the table, and parts of the rows without a time.
PART_HOURS, BUCKETS = 6, 64
#: Hours that the cap reaches over.
HALO = -(-fv.GAP_CAP_SECONDS // 3600)
#: A date and an hour of it; without a time NO_DATE and a bucket.
Slot = tuple[date, int]


def headway_tables(
    landing: str, table: str, noted: Callable[[DataFrame, int], None] | None = None
) -> BatchWriter:
    """A batch writer that keeps the streamed part of ``table`` (positions with gaps, by hour of the vehicle time).

    Stored rows lie under their date, then their batch, in order of time: a batch only opens the dates it needs,
    and a replayed batch replaces exactly its own folders. ``noted`` is told the rows that were replaced.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = _store(batch, landing, batch_id)
        if touched:
            kept = f"{table.rstrip('/')}/{STREAM_FOLDER}"
            replaced = _recompute(spark, landing, kept, touched)
            if noted is not None:
                rows = versions.read(spark, kept, parts=_parts(replaced))
                noted(rows.filter(_in_slots(F.col("mta_timestamp"), replaced)).drop(*LAYOUT), batch_id)

    return write


def _hour(time: Column) -> Column:
    bucket = F.pmod(F.xxhash64("stop_id"), F.lit(BUCKETS)).cast("int")
    return F.when(vehicle_date(time) == F.lit(NO_DATE), bucket).otherwise(F.hour(time))


def _store(batch: DataFrame, landing: str, batch_id: int) -> set[Slot]:
    """Write the batch's own folders and check their rows; returns the slots it touches, told by the write itself."""
    time = from_epoch("mta_timestamp")
    stored = batch.withColumns({DATE_COLUMN: vehicle_date(time), BATCH_COLUMN: F.lit(batch_id).cast("bigint")})
    seen = Observation()
    slots = F.array_join(F.collect_set(F.concat_ws("/", vehicle_date(time), _hour(time))), ",")
    observed = stored.observe(seen, F.count(F.lit(1)).alias("rows"), slots.alias("slots"))
    ordered = observed.sortWithinPartitions(DATE_COLUMN, BATCH_COLUMN, "mta_timestamp")
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DATE_COLUMN, BATCH_COLUMN).parquet(landing)
    touched = {(date.fromisoformat(day), int(hour)) for day, hour in (x.split("/") for x in (seen.get["slots"] or "").split(",") if x)}
    if touched:
        own = _stored_path(landing, {day for day, _ in touched}, f"{BATCH_COLUMN}={batch_id}")
        validate_count(batch.sparkSession, own, seen.get["rows"], batch)
    return touched


def _stored_path(landing: str, dates: Iterable[date], below: str = "*") -> str:
    listed = ",".join(sorted(day.isoformat() for day in set(dates)))
    return f"{landing}/{DATE_COLUMN}={{{listed}}}/{below}"


def _moved(slot: Slot, hours: int) -> set[Slot]:
    """The slots some hours later or earlier; rows without a time count as the whole first day."""
    day, hour = slot
    start = datetime(day.year, day.month, day.day)
    if day == NO_DATE:
        start += timedelta(days=1, hours=-1) if hours > 0 else timedelta(0)
    else:
        start += timedelta(hours=hour)
    moved = start + timedelta(hours=hours)
    return {(NO_DATE, b) for b in range(BUCKETS)} if moved.date() == NO_DATE else {(moved.date(), moved.hour)}


def reached(slots: Iterable[Slot], hours: int) -> set[Slot]:
    """The slots and those up to ``hours`` later (earlier where negative)."""
    step = 1 if hours > 0 else -1
    return set(slots).union(*(_moved(slot, k) for slot in slots for k in range(step, hours + step, step)))


def rows_of_slots(spark: SparkSession, landing: str, slots: set[Slot]) -> DataFrame:
    """The stored rows of some slots. Dates are folders; hours are ranges of time that reach the scan."""
    layout = f"{schemas.RAW_POSITIONS.rstrip()}, {DATE_COLUMN} date, {BATCH_COLUMN} bigint"
    reader = spark.read.schema(layout).option("basePath", landing)
    rows = load_or_empty(spark, lambda: reader.parquet(_stored_path(landing, {day for day, _ in slots})), layout)
    time, wanted = F.col("mta_timestamp"), F.lit(False)
    hours = sorted(datetime(d.year, d.month, d.day, h) for d, h in slots if d != NO_DATE)
    spans: list[list[datetime]] = []
    for hour in hours:
        if spans and spans[-1][1] == hour:
            spans[-1][1] += timedelta(hours=1)
        else:
            spans.append([hour, hour + timedelta(hours=1)])
    epoch = datetime(1970, 1, 1)
    for low, high in spans:
        first, last = (int((t - epoch).total_seconds()) for t in (low, high))
        wanted = wanted | ((time >= first) & (time < last))
    buckets = [hour for day, hour in slots if day == NO_DATE]
    if buckets:
        untimed = F.col(DATE_COLUMN) == F.lit(NO_DATE)
        wanted = wanted | (untimed & F.pmod(F.xxhash64("stop_id"), F.lit(BUCKETS)).isin(*buckets))
    return rows.filter(wanted).drop(DATE_COLUMN, BATCH_COLUMN)


def _part(day: date, hour: int) -> int:
    return hour if day == NO_DATE else hour // PART_HOURS


def _parts(slots: Iterable[Slot]) -> list[str]:
    """The parts of the table that hold some slots."""
    return sorted({versions.part(**{DATE_COLUMN: day.isoformat(), PART_COLUMN: _part(day, hour)}) for day, hour in slots})


def _in_slots(time: Column, slots: Iterable[Slot]) -> Column:
    by_date: dict[date, list[int]] = {}
    for day, hour in sorted(slots):
        by_date.setdefault(day, []).append(hour)
    days = [(vehicle_date(time) == F.lit(day)) & _hour(time).isin(*hours) for day, hours in by_date.items()]
    return reduce(or_, days, F.lit(False))


def _recompute(spark: SparkSession, landing: str, table: str, touched: set[Slot]) -> set[Slot]:
    """Replace the touched slots and those that the cap reaches after them; returns them."""
    replaced, time = reached(touched, HALO), F.col("mta_timestamp")
    gaps = clean_positions(rows_of_slots(spark, landing, reached(replaced, -HALO))).filter(_in_slots(time, replaced))
    layout = f"{schemas.POSITIONS.rstrip()}, {DATE_COLUMN} date, {PART_COLUMN} int"
    others = versions.read(spark, table, layout, _parts(replaced)).filter(~_in_slots(time, replaced)).drop(*LAYOUT)
    hour = _hour(time)
    number = F.when(vehicle_date(time) == F.lit(NO_DATE), hour).otherwise(F.floor(hour / PART_HOURS).cast("int"))
    dated = gaps.unionByName(others).withColumns({DATE_COLUMN: vehicle_date(time), PART_COLUMN: number})
    versions.replace(dated.hint("rebalance", *LAYOUT), table, LAYOUT, _parts(replaced))
    return replaced


def read_headways(spark: SparkSession, table: str) -> DataFrame:
    return read_processed(spark, table, schemas.POSITIONS)
