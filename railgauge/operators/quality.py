"""Table expectations and run metrics. Every check returns counts, computed in one pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..sources import versions
from .aggregates import SEVERITIES

HEADWAY_LABELS = tuple(label for _, label in fv.HEADWAY_BOUNDS) + (fv.HEADWAY_OVER, fv.HEADWAY_UNKNOWN)


@dataclass(frozen=True)
class Expectations:
    """What one table promises."""

    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    unique: Sequence[str] = ()


def standard_expectations(routes: Sequence[str] = fv.DEFAULT_ROUTES) -> dict[str, Expectations]:
    """The columns and labels each model is checked for."""
    return {
        "stg_delays": Expectations(
            not_null=(
                "vehicle_id",
                "trip_id",
                "route_id",
                "stop_id",
                "arrival_delay",
                "delay_severity",
                "window_start",
            ),
            accepted={"route_id": routes, "delay_severity": SEVERITIES},
        ),
        "stg_alerts": Expectations(
            not_null=("alert_id", "route_id", "severity", "window_start"),
            accepted={"route_id": routes},
        ),
        "stg_positions": Expectations(
            not_null=("vehicle_id", "route_id", "occupancy_proxy", "window_start"),
            accepted={"route_id": routes, "occupancy_proxy": HEADWAY_LABELS},
        ),
        "stg_weather": Expectations(
            not_null=("obs_hour", "temperature_c", "humidity_pct"),
            unique=("obs_hour",),
        ),
        "fct_performance": Expectations(
            not_null=("route_id", "window_start", "avg_delay_sec", "alerts_active"),
            accepted={"route_id": routes},
        ),
    }


def _one_pass(df: DataFrame, model: str, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(model, column_name, check_name, failures), one row per check, from one aggregation."""
    counted = df.agg(*[F.count_if(failing).alias(f"c{i}") for i, (_, _, failing) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(F.lit(column).alias("column_name"), F.lit(check).alias("check_name"), F.col(f"c{i}").alias("failures"))
            for i, (column, check, _) in enumerate(checks)
        ]
    )
    return counted.select(F.lit(model).alias("model"), F.inline(rows))


def check_not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    return _one_pass(df, model, [(column, "not_null", F.col(column).isNull()) for column in columns])


def stored_not_null(spark: SparkSession, root: str, model: str, columns: Sequence[str]) -> DataFrame:
    """``check_not_null`` of a versioned table, from what its writes have counted: no column is read."""
    nulls = versions.statistics(spark, root)["nulls"]
    rows = [(model, column, "not_null", nulls[column]) for column in columns]
    return spark.createDataFrame(rows, "model string, column_name string, check_name string, failures bigint")


def stored_freshness(spark: SparkSession, root: str, column: str = "window_start") -> DataFrame:
    """The newest time in a versioned table, from what its writes have noted: no column is read."""
    newest = versions.statistics(spark, root)["newest"][column]
    return spark.range(1).select(F.timestamp_micros(F.lit(newest).cast("bigint")).alias("newest_window"))


def check_accepted(df: DataFrame, model: str, accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """A null is no failure here; ``check_not_null`` counts those."""
    checks = [(column, "accepted_values", ~F.col(column).isin(*values)) for column, values in accepted.items()]
    return _one_pass(df, model, checks)


def check_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of values that occur more than once."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit("unique").alias("check_name"), "failures"
    )


def check_table(df: DataFrame, model: str, expected: Expectations) -> DataFrame:
    checks = [(column, "not_null", F.col(column).isNull()) for column in expected.not_null]
    checks += [
        (column, "accepted_values", ~F.col(column).isin(*values)) for column, values in expected.accepted.items()
    ]
    parts = [_one_pass(df, model, checks)] if checks else []
    parts += [check_unique(df, model, column) for column in expected.unique]
    return reduce(DataFrame.unionByName, parts)


def check_all(tables: Mapping[str, DataFrame], expected: Mapping[str, Expectations]) -> DataFrame:
    return reduce(DataFrame.unionByName, [check_table(tables[name], name, wants) for name, wants in expected.items()])


def epoch_starts(alerts: DataFrame) -> DataFrame:
    """Alerts whose start reads as the epoch or earlier: a start time left off the wire."""
    return alerts.agg(F.count_if(F.col("start_time") <= F.timestamp_seconds(F.lit(0))).alias("failures"))


def delay_metrics(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows in, rows kept."""
    before = raw.agg(F.count(F.lit(1)).alias("raw_records"))
    after = clean.agg(F.count(F.lit(1)).alias("clean_records"))
    return side_by_side(before, after)


def weather_metrics(weather: DataFrame) -> DataFrame:
    return weather.agg(
        F.count(F.lit(1)).alias("hourly_records"),
        F.count_if(F.col("precip_mm") > 0).alias("wet_hours"),
    )


def feed_metrics(feed: DataFrame) -> DataFrame:
    """Snapshots and entities, by payload, without flattening them."""
    def entities(payload: str) -> Column:
        return F.sum(F.size(F.filter("entity", lambda e: e[payload].isNotNull()))).alias(f"{payload}_entities")

    return feed.agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.sum(F.size("entity")).cast("bigint").alias("entities"),
        *[entities(payload) for payload in ("trip_update", "vehicle", "alert")],
    )


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row frames as one row."""
    columns = left.columns + right.columns
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(column).alias(column) for column in columns])
