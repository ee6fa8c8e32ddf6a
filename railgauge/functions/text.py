"""Display text for the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .times import as_column

# Wording and marks shown to readers of the reports.
MISSING = "—"
HEAT_MARK = " 🔥"
RAIN_MARK = " 🌧"
DATE_FORMAT = "MMM dd HH:mm 'UTC'"
STAMP_FORMAT = "yyyy-MM-dd HH:mm 'UTC'"
NO_END = "TBD"


def prefix(text: Column | str, chars: int = fv.DESCRIPTION_CHARS) -> Column:
    return F.substring(as_column(text), 1, chars)


def title(text: Column | str, chars: int = fv.TITLE_CHARS) -> Column:
    return F.concat(prefix(text, chars), F.lit("..."))


def whole(value: Column) -> Column:
    """Double to whole number towards zero."""
    return value.cast("bigint")


def or_missing(text: Column, missing: str = MISSING) -> Column:
    return F.coalesce(text, F.lit(missing))


def minutes_seconds(seconds: Column | str) -> Column:
    seconds = as_column(seconds)
    shown = F.concat(whole(F.floor(seconds / 60)), F.lit("m "), whole(F.pmod(seconds, F.lit(60))), F.lit("s"))
    return or_missing(shown)


def minutes(seconds: Column | str) -> Column:
    return or_missing(F.concat(whole(F.floor(as_column(seconds) / 60)), F.lit("m")))


def days_hours(hours: Column | str) -> Column:
    """``3d 4h``, or ``4h`` below one day."""
    hours = as_column(hours)
    days = whole(F.floor(hours / 24))
    rest = F.concat(whole(F.pmod(hours, F.lit(24))), F.lit("h"))
    return F.when(days > 0, F.concat(days, F.lit("d "), rest)).otherwise(rest)


def starts_in(hours: Column | str) -> Column:
    """``in 3d 4h``, counted in whole hours."""
    return F.concat(F.lit("in "), days_hours(whole(as_column(hours))))


def utc_date(ts: Column | str, missing: str | None = None) -> Column:
    text = F.date_format(as_column(ts), DATE_FORMAT)
    return or_missing(text, missing) if missing else text


def utc_stamp(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), STAMP_FORMAT)


def measure(value: Column | str, unit: str, flag: Column | None = None, mark: str = "") -> Column:
    """One decimal and a unit, with a mark when the flag is set."""
    shown = F.format_string(f"%.1f{unit}", as_column(value))
    if flag is not None:
        shown = F.concat(shown, F.when(flag, F.lit(mark)).otherwise(F.lit("")))
    return F.when(as_column(value).isNull(), F.lit(MISSING)).otherwise(shown)


def count_text(value: Column | str) -> Column:
    return or_missing(whole(as_column(value)).cast("string"))
