"""Event-time arithmetic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import WINDOW_MINUTES

MICROS = 1_000_000
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def instant(value: Column | str | datetime | None) -> Column:
    """A point in time: a column, an ISO literal, a datetime, or now when None.

    ``current_timestamp`` is one value for the whole query, so every row sees the same now.
    A literal lets Spark push comparisons down to the scan.
    """
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def window_floor(ts: Column | str, minutes: int = WINDOW_MINUTES) -> Column:
    """Start of the tumbling window that holds ``ts``; null stays null, pre-1970 works."""
    step = minutes * 60 * MICROS
    micros = F.unix_micros(as_column(ts).cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))


def hour_floor(ts: Column | str) -> Column:
    return F.date_trunc("hour", as_column(ts).cast("timestamp"))


def from_epoch(seconds: Column | str) -> Column:
    """Epoch seconds to timestamp; no whole number, or one outside the years 1 to 9999, becomes null."""
    whole = as_column(seconds).try_cast("bigint")
    return F.timestamp_seconds(F.when(whole.between(FIRST_SECOND, LAST_SECOND), whole))


def parse_instant(text: Column | str) -> Column:
    """ISO-8601 text with an offset, normalised to UTC; unreadable text becomes null."""
    return as_column(text).try_cast("timestamp")


def parse_local(text: Column | str) -> Column:
    """ISO-8601 text without an offset, kept as wall-clock time."""
    return as_column(text).try_cast("timestamp_ntz")


def local_to_instant(wall_clock: Column | str, zone: str | Column | None = None) -> Column:
    """Wall-clock time to an instant: labelled UTC, or shifted from ``zone`` when one is given."""
    labelled = as_column(wall_clock).cast("timestamp")
    return labelled if zone is None else F.to_utc_timestamp(labelled, zone)


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    """Signed fractional hours from ``earlier`` to ``later``."""
    micros = F.unix_micros(as_column(later).cast("timestamp")) - F.unix_micros(as_column(earlier).cast("timestamp"))
    return micros / F.lit(MICROS) / F.lit(3600)


def file_instant(path: Column | str, fallback: Column) -> Column:
    """Poll time in a snapshot's file name (``..._YYYYMMDD_HHMMSS.ext``), else in its folder's."""
    parts = (r"(\d{8}_\d{6})[^/]*$", r"(\d{8}_\d{6})[^/]*/[^/]*$")
    stamps = [F.nullif(F.regexp_extract(as_column(path), part, 1), F.lit("")) for part in parts]
    return F.coalesce(*[F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss")) for stamp in stamps], fallback)
