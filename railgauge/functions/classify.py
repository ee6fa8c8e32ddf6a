"""Bucketing and labelling. Thresholds are parameters; defaults are the fixed values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .numbers import null_to_zero, round_scaled
from .times import as_column, instant

Bounds = Sequence[tuple[float, str]]


def bucket(value: Column, bounds: Bounds, over: str) -> Column:
    """First label whose inclusive upper bound holds the value, else ``over``."""
    (first_bound, first_label), *rest = bounds
    chain = F.when(value <= first_bound, first_label)
    for bound, label in rest:
        chain = chain.when(value <= bound, label)
    return chain.otherwise(over)


def delay_severity(delay: Column | str, bounds: Bounds = fv.DELAY_BOUNDS, over: str = fv.DELAY_OVER) -> Column:
    """Early and missing delays count as on time."""
    return bucket(null_to_zero(delay), bounds, over)


def headway_status(gap: Column | str, bounds: Bounds = fv.HEADWAY_BOUNDS, over: str = fv.HEADWAY_OVER) -> Column:
    gap = as_column(gap)
    return F.when(gap.isNull(), fv.HEADWAY_UNKNOWN).otherwise(bucket(gap, bounds, over))


def nullify_over(value: Column | str, cap: float = fv.GAP_CAP_SECONDS) -> Column:
    value = as_column(value)
    return F.when(value <= cap, value)


def null_or_within(value: Column | str, cap: float = fv.GAP_CAP_SECONDS) -> Column:
    value = as_column(value)
    return value.isNull() | (value <= cap)


def effect_label(effect: Column | str, labels: Mapping[int, str] = fv.EFFECT_LABELS, default: str = fv.UNKNOWN_EFFECT) -> Column:
    pairs = [F.lit(item) for pair in labels.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), as_column(effect)), F.lit(default))


def holds(condition: Column) -> Column:
    """A comparison where a missing measure means false."""
    return F.coalesce(condition, F.lit(False))


def is_extreme_heat(temperature: Column | str, threshold: float = fv.EXTREME_HEAT_C) -> Column:
    return holds(as_column(temperature) >= threshold)


def is_positive(measure: Column | str) -> Column:
    return holds(as_column(measure) > 0)


def weather_condition(
    temperature: Column | str = "temperature_c",
    precip: Column | str = "precip_mm",
    snowfall: Column | str = "snowfall_cm",
) -> Column:
    """Snow beats rain beats temperature; missing measures fall through to mild."""
    temperature, precip, snowfall = map(as_column, (temperature, precip, snowfall))
    return (
        F.when(snowfall > 0, "snow")
        .when(precip > fv.HEAVY_RAIN_MM, "heavy_rain")
        .when(precip > 0, "light_rain")
        .when(temperature >= fv.EXTREME_HEAT_C, "extreme_heat")
        .when(temperature >= fv.HOT_C, "hot")
        .when(temperature <= fv.FREEZING_C, "freezing")
        .otherwise("mild")
    )


def feels_like(temperature: Column | str = "temperature_c", humidity: Column | str = "humidity_pct") -> Column:
    """Warm and humid hours gain a tenth of a degree per percent above the humid mark."""
    temperature, humidity = map(as_column, (temperature, humidity))
    muggy = round_scaled(temperature + (humidity - fv.HUMID_PCT) * F.lit(0.1), 1)
    return F.when((temperature >= fv.HOT_C) & (humidity >= fv.HUMID_PCT), muggy).otherwise(temperature)


def wind_category(speed: Column | str = "wind_speed_kmh") -> Column:
    speed = as_column(speed)
    return F.when(speed >= fv.STRONG_WIND_KMH, "strong").when(speed >= fv.MODERATE_WIND_KMH, "moderate").otherwise("light")


def alert_status(
    start: Column | str = "start_time",
    end: Column | str = "end_time",
    as_of: Column | str | datetime | None = None,
) -> Column:
    """A missing start never makes an alert upcoming; one that ends exactly now is expired."""
    start, end, now = as_column(start), as_column(end), instant(as_of)
    return F.when(start > now, "upcoming").when(end.isNull(), "ongoing").when(end > now, "active").otherwise("expired")


def not_ended(end: Column | str = "end_time", as_of: Column | str | datetime | None = None) -> Column:
    """Open-ended or ending later; a plain comparison, so Parquet scans can skip on it."""
    end = as_column(end)
    return end.isNull() | (end > instant(as_of))


def is_relevant(
    start: Column | str = "start_time",
    end: Column | str = "end_time",
    as_of: Column | str | datetime | None = None,
) -> Column:
    """Everything but expired."""
    return holds(as_column(start) > instant(as_of)) | not_ended(end, as_of)
