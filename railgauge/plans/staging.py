"""Processed tables to staging views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import classify
from ..functions.numbers import null_to_zero
from ..operators import dedup
from ..operators.filters import any_present, on_routes, unnest_routes, within_gap_cap
from ..operators.joins import join_stops


def stg_delays(delays: DataFrame, stops: DataFrame) -> DataFrame:
    """The stop names join after the deduplication, onto the fewest rows."""
    known = any_present(delays, ["arrival_delay", "departure_delay"])
    return join_stops(dedup.earliest_delay(known), stops).select(
        "vehicle_id",
        "trip_id",
        "route_id",
        "stop_id",
        "stop_name",
        "direction",
        null_to_zero("arrival_delay").alias("arrival_delay"),
        null_to_zero("departure_delay").alias("departure_delay"),
        classify.delay_severity("arrival_delay").alias("delay_severity"),
        "source_file",
        "event_time",
        "window_start",
    )


def stg_alerts(alerts: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES) -> DataFrame:
    return dedup.latest_alert(unnest_routes(alerts, routes)).select(
        "alert_id", "route_id", "header", "description_short", "severity", "start_time", "end_time", "window_start"
    )


def stg_positions(positions: DataFrame, routes: Sequence[str] | None = fv.DEFAULT_ROUTES) -> DataFrame:
    """The cap drops rows here; on processed positions it finds none left to drop."""
    kept = within_gap_cap(on_routes(positions, routes))
    return dedup.latest_position(kept).select(
        "vehicle_id",
        "trip_id",
        "route_id",
        "stop_id",
        "current_stop_sequence",
        "current_status",
        "mta_timestamp",
        "headway_gap_sec",
        "headway_status",
        "window_start",
        classify.headway_status("headway_gap_sec").alias("occupancy_proxy"),
    )


def stg_weather(weather: DataFrame) -> DataFrame:
    return dedup.latest_observation(weather).select(
        "temperature_c",
        "humidity_pct",
        "precip_mm",
        "snowfall_cm",
        "wind_speed_kmh",
        "weather_timestamp",
        "obs_hour",
        "is_extreme_heat",
        "is_precip",
        "is_snow",
    )
