"""One registered query per operator, table and report.

Each takes (spark, sf_dir) and returns a DataFrame over the whole of the given tables. Times
leave as zone-less UTC and arrays as text, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import classify, numbers, text, times
from ..operators import aggregates, dedup, filters, headway, joins, quality
from .. import schemas
from ..plans import increments, latest, marts, processing, refresh, reports, staging
from ..session import pin_utc, scratch_dir
from ..sources import feeds, sinks, tables, weather as weather_source
from ..streaming import event_time, live_weather
from ..streaming import headway as stream_headway_tables
from ..streaming import processing as stream_processing
from ..streaming import sinks as stream_sinks
from ..streaming import windows as stream_windows
from . import views
from .views import AS_OF, ROUTES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(field.name, ",").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return portable(build(spark, sf_dir))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


# --- projections and filters -------------------------------------------------------------

DELAY_COLUMNS = ["feed_seq", "vehicle_id", "trip_id", "route_id", "stop_id", "arrival_delay", "departure_delay"]


@query
def filter_routes(spark, sf_dir):
    return filters.on_routes(views.raw_delays(spark, sf_dir), ("click", "view")).select(*DELAY_COLUMNS)


@query
def filter_any_delay(spark, sf_dir):
    return filters.any_present(views.raw_delays(spark, sf_dir), ["arrival_delay", "departure_delay"]).select(
        *DELAY_COLUMNS
    )


@query
def filter_arrival_known(spark, sf_dir):
    return filters.all_present(views.raw_delays(spark, sf_dir), ["arrival_delay"]).select(*DELAY_COLUMNS)


@query
def project_rename(spark, sf_dir):
    positions = views.raw_positions(spark, sf_dir).withColumnRenamed("mta_timestamp", "reported_at")
    return positions.select("feed_seq", "vehicle_id", "route_id", "stop_id", "reported_at")


@query
def delay_severity(spark, sf_dir):
    return views.raw_delays(spark, sf_dir).select(
        "feed_seq", "arrival_delay", classify.delay_severity("arrival_delay").alias("delay_severity")
    )


@query
def null_to_zero(spark, sf_dir):
    return views.raw_delays(spark, sf_dir).select(
        "feed_seq",
        numbers.null_to_zero("arrival_delay", "int").alias("arrival_delay"),
        numbers.null_to_zero("departure_delay", "int").alias("departure_delay"),
    )


# --- time --------------------------------------------------------------------------------


@query
def window_15min(spark, sf_dir):
    return views.events(spark, sf_dir).select("event_id", times.window_floor("ts").alias("window_start"))


@query
def hour_floor(spark, sf_dir):
    return views.events(spark, sf_dir).select("event_id", times.hour_floor("ts").alias("obs_hour"))


@query
def epoch_parse(spark, sf_dir):
    """Also text that is no number: the event type as an epoch reads as null."""
    events = views.events(spark, sf_dir)
    return events.select(
        "event_id",
        times.from_epoch(F.unix_seconds("ts")).alias("second"),
        times.from_epoch("event_type").alias("unreadable"),
    )


@query
def epoch_bounds(spark, sf_dir):
    """The extremes of bigint, which feeds use for no end, and the first second past the last year."""
    second = (
        F.when(F.col("event_id") % 4 == 0, F.lit(9223372036854775807))
        .when(F.col("event_id") % 4 == 1, F.lit(-9223372036854775807))
        .when(F.col("event_id") % 4 == 2, F.lit(253402300800))
        .otherwise(F.unix_seconds("ts"))
    )
    return views.events(spark, sf_dir).select("event_id", times.from_epoch(second).alias("second"))


@query
def iso_parse(spark, sf_dir):
    stamped = views.events(spark, sf_dir).select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("local_text"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-04:00")).alias("offset_text"),
    )
    return stamped.select(
        "event_id",
        times.parse_local("local_text").alias("wall_clock"),
        times.parse_instant("offset_text").alias("instant"),
    )


@query
def local_to_utc(spark, sf_dir):
    """Labelled as UTC, and shifted from New York time."""
    wall_clock = F.col("ts").cast("timestamp_ntz")
    return views.events(spark, sf_dir).select(
        "event_id",
        times.local_to_instant(wall_clock).alias("labelled"),
        times.local_to_instant(wall_clock, "America/New_York").alias("shifted"),
    )


# --- nested snapshots --------------------------------------------------------------------


@query
def explode_stop_updates(spark, sf_dir):
    return feeds.load_raw_delays(views.feed(spark, sf_dir), ROUTES).drop("feed_seq")


@query
def explode_vehicles(spark, sf_dir):
    return feeds.load_raw_positions(views.feed(spark, sf_dir), ROUTES).drop("feed_seq")


@query
def flatten_alerts(spark, sf_dir):
    return feeds.load_raw_alerts(views.feed(spark, sf_dir), ROUTES).drop("feed_seq")


@query
def hourly_arrays_to_rows(spark, sf_dir):
    return weather_source.hourly_rows(views.weather_responses(spark, sf_dir)).drop("feed_seq")


@query
def weather_union_shapes(spark, sf_dir):
    return weather_source.load_raw_weather(views.weather_responses(spark, sf_dir)).drop("feed_seq")


@query
def landed_feed_scan(spark, sf_dir):
    """Snapshots written to a landing folder and read back from all its sub-folders."""
    root = scratch_dir(spark, "landing")
    sinks.land_snapshots(views.feed(spark, sf_dir), root)
    return feeds.load_raw_delays(feeds.read_feed(spark, root), ROUTES).drop("feed_seq")


@query
def landed_json_scan(spark, sf_dir):
    """The same snapshots landed as JSON text."""
    root = scratch_dir(spark, "landing")
    sinks.land_snapshots(views.feed(spark, sf_dir), root, fmt="json")
    return feeds.load_raw_positions(feeds.read_feed(spark, root, "json", "*.json"), ROUTES).drop("feed_seq")


@query
def corrupt_files_counted(spark, sf_dir):
    """JSON lines, every tenth of them cut short."""
    root = scratch_dir(spark, "corrupt")
    line = F.to_json(F.struct("event_id", "event_type"))
    whole = F.length(line) - F.when(F.col("event_id") % 10 == 0, 4).otherwise(0)
    views.events(spark, sf_dir).select(F.substring(line, F.lit(1), whole)).write.text(f"{root}/poll_1")
    counted = feeds.corrupt_lines(spark, root, "event_id bigint, event_type string", "*.txt")
    return counted.agg(F.sum("lines").alias("lines"), F.sum("corrupt").alias("corrupt"))


# --- sources and sinks -------------------------------------------------------------------


@query
def lineage_scan(spark, sf_dir):
    rows = feeds.with_lineage(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return rows.groupBy(F.regexp_extract("source_file", r"([^/]+\.parquet)", 1).alias("source_file")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def new_files_only(spark, sf_dir):
    """Files of four events each; those without an error event count as not yet processed."""
    events = views.events(spark, sf_dir).withColumn(
        "source_file", F.concat(F.lit("f"), F.floor(F.col("event_id") / 4))
    )
    listing = events.select("source_file").distinct()
    return tables.new_files(listing, events.filter(F.col("event_type") == "error"))


@query
def seed_scan(spark, sf_dir):
    """The stops dimension written as a CSV seed and read back with its contract."""
    path = scratch_dir(spark, "seed")
    views.stops(spark, sf_dir).write.option("header", "true").csv(path)
    return tables.read_stops(spark, path)


@query
def roundtrip_write_validate(spark, sf_dir):
    path = scratch_dir(spark, "processed")
    sinks.save_processed(views.delays(spark, sf_dir), path)
    return tables.read_processed(spark, path, tables.TABLES["delays"])


@query
def overwrite_features(spark, sf_dir):
    """Written twice: the second write replaces the first."""
    path = scratch_dir(spark, "features")
    delays = aggregates.delays_by_window(views.delays(spark, sf_dir))
    sinks.save_features(delays, path)
    return spark.read.parquet(sinks.save_features(delays, path))


@query
def materialize_view_table(spark, sf_dir):
    """A staging view, and a table built from it."""
    view = sinks.materialize_view(views.delays(spark, sf_dir), "railgauge_delays_view")
    path = scratch_dir(spark, "table")
    return sinks.materialize_table(aggregates.severity_counts(view), f"railgauge_{path[-32:]}", path)


@query
def source_catalog(spark, sf_dir):
    """Rows per logical source, through the registered names."""
    root = scratch_dir(spark, "catalog")
    built = {
        "delays": views.delays(spark, sf_dir),
        "alerts": views.alerts(spark, sf_dir),
        "weather": views.weather(spark, sf_dir),
        "vehicle_positions": views.positions(spark, sf_dir),
    }
    for name, path in tables.processed_paths(root).items():
        sinks.save_processed(built[name], path)
    tables.open_catalog(spark, root)
    counts = [
        spark.table(name).agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("rows")) for name in tables.TABLES
    ]
    first, *others = counts
    for other in others:
        first = first.unionByName(other)
    return first


@query
def empty_input(spark, sf_dir):
    """No snapshot has a wanted route: every later stage yields an empty table with its schema."""
    raw = feeds.load_raw_delays(views.feed(spark, sf_dir), ("no such route",))
    return aggregates.delays_by_window(processing.clean_delays(raw))


@query
def ingest_metrics(spark, sf_dir):
    raw = views.raw_delays(spark, sf_dir)
    kept = quality.delay_metrics(raw, processing.clean_delays(raw))
    wet = quality.weather_metrics(views.raw_weather(spark, sf_dir))
    return quality.side_by_side(kept, wet)


@query
def feed_entity_metrics(spark, sf_dir):
    return quality.feed_metrics(views.feed(spark, sf_dir))


# --- weather classes, labels, text -------------------------------------------------------


@query
def weather_flags(spark, sf_dir):
    return views.raw_weather(spark, sf_dir).select(
        "feed_seq",
        classify.is_extreme_heat("temperature_c").alias("is_extreme_heat"),
        classify.is_positive("precip_mm").alias("is_precip"),
        classify.is_positive("snowfall_cm").alias("is_snow"),
    )


@query
def weather_bucket(spark, sf_dir):
    return views.raw_weather(spark, sf_dir).select("feed_seq", classify.weather_condition().alias("condition_bucket"))


@query
def feels_like(spark, sf_dir):
    return views.raw_weather(spark, sf_dir).select(
        "feed_seq", "temperature_c", "humidity_pct", classify.feels_like().alias("feels_like_c")
    )


@query
def wind_category(spark, sf_dir):
    return views.raw_weather(spark, sf_dir).select(
        "feed_seq", "wind_speed_kmh", classify.wind_category().alias("wind_category")
    )


@query
def effect_label(spark, sf_dir):
    return views.raw_alerts(spark, sf_dir).select("feed_seq", "effect", classify.effect_label("effect").alias("severity"))


@query
def text_prefix(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", text.prefix("text").alias("description_short"), text.title("text").alias("title"))


# --- alerts ------------------------------------------------------------------------------

ALERT_ID = ["feed_seq", "alert_id", "header"]


def _timed_alerts(spark, sf_dir):
    return views.raw_alerts(spark, sf_dir).withColumns(
        {"start_time": times.from_epoch("start_time"), "end_time": times.from_epoch("end_time")}
    )


@query
def alert_status(spark, sf_dir):
    return _timed_alerts(spark, sf_dir).select(*ALERT_ID, classify.alert_status(as_of=AS_OF).alias("alert_status"))


@query
def alerts_relevant(spark, sf_dir):
    return _timed_alerts(spark, sf_dir).filter(classify.is_relevant(as_of=AS_OF)).select(*ALERT_ID)


@query
def alerts_not_ended(spark, sf_dir):
    return _timed_alerts(spark, sf_dir).filter(classify.not_ended(as_of=AS_OF)).select(*ALERT_ID)


@query
def alerts_with_status(spark, sf_dir):
    return filters.with_status(_timed_alerts(spark, sf_dir), ["ongoing", "upcoming"], AS_OF).select(*ALERT_ID)


@query
def alert_hours(spark, sf_dir):
    now = times.instant(AS_OF)
    return _timed_alerts(spark, sf_dir).select(
        *ALERT_ID,
        times.hours_between(now, "start_time").alias("hours_since_start"),
        times.hours_between("start_time", now).alias("hours_until_start"),
    )


@query
def unnest_routes(spark, sf_dir):
    return filters.unnest_routes(views.raw_alerts(spark, sf_dir)).select("route_id", *ALERT_ID)


@query
def epoch_start_alerts(spark, sf_dir):
    """A start left off the wire reads as zero, the epoch."""
    zeroed = views.raw_alerts(spark, sf_dir).withColumn("start_time", times.from_epoch(numbers.null_to_zero("start_time")))
    return quality.epoch_starts(zeroed)


# --- aggregations ------------------------------------------------------------------------


@query
def join_stop_dim(spark, sf_dir):
    return joins.join_stops(views.raw_delays(spark, sf_dir), views.stops(spark, sf_dir)).select(
        "feed_seq", "stop_id", "stop_name", "direction"
    )


@query
def agg_delays_by_window(spark, sf_dir):
    return aggregates.delays_by_window(views.delays(spark, sf_dir))


@query
def severity_counts(spark, sf_dir):
    return aggregates.severity_counts(views.delays(spark, sf_dir))


def _named_delays(spark, sf_dir):
    return joins.join_stops(views.delays(spark, sf_dir), views.stops(spark, sf_dir))


@query
def pct_delayed(spark, sf_dir):
    return aggregates.delay_profile(_named_delays(spark, sf_dir)).select(
        "route_id", "window_start", "delay_records", "pct_delayed"
    )


@query
def alerts_by_window(spark, sf_dir):
    return aggregates.alert_count_by_window(filters.unnest_routes(views.twice(views.alerts(spark, sf_dir))))


@query
def worst_severity(spark, sf_dir):
    return aggregates.worst_severity(filters.unnest_routes(views.alerts(spark, sf_dir)))


@query
def alert_headers(spark, sf_dir):
    return aggregates.alert_headers(filters.unnest_routes(views.alerts(spark, sf_dir)))


@query
def data_freshness(spark, sf_dir):
    return aggregates.freshness(aggregates.delays_by_window(views.delays(spark, sf_dir)))


@query
def stored_freshness(spark, sf_dir):
    """Of a window table of which a third of the dates has been replaced since."""
    root = scratch_dir(spark, "stored")
    windows = aggregates.delays_by_window(views.delays(spark, sf_dir))
    days = stream_windows.dates_of(windows, "window_start")
    stream_windows.replace_dates(windows, root, days)
    some = {day for day in days if day.day % 3 == 0}
    stream_windows.replace_dates(windows.filter(stream_windows.between_dates("window_start", some)), root, some)
    return quality.stored_freshness(spark, root)


@query
def stored_not_null(spark, sf_dir):
    """Windows without a gap or without weather, of the stored features."""
    root = scratch_dir(spark, "stored")
    sinks.save_features(_features(spark, sf_dir), root)
    return quality.stored_not_null(spark, root, "features", ["route_id", "avg_headway_gap_sec", "temperature_c"])


# --- headway -----------------------------------------------------------------------------

GAP_COLUMNS = ["feed_seq", "route_id", "stop_id", "mta_timestamp", "headway_gap_sec"]


def _gaps(spark, sf_dir, cap=None):
    return headway.headway_gaps(views.raw_positions(spark, sf_dir), identity=["feed_seq"], cap=cap)


@query
def headway_gap(spark, sf_dir):
    return _gaps(spark, sf_dir).select(*GAP_COLUMNS)


@query
def headway_cap_null(spark, sf_dir):
    return _gaps(spark, sf_dir, cap=1800).select(*GAP_COLUMNS)


@query
def headway_cap_filter(spark, sf_dir):
    return filters.within_gap_cap(_gaps(spark, sf_dir)).select(*GAP_COLUMNS)


@query
def headway_status(spark, sf_dir):
    return _gaps(spark, sf_dir, cap=1800).select(
        "feed_seq", classify.headway_status("headway_gap_sec").alias("headway_status")
    )


@query
def headway_by_window(spark, sf_dir):
    return aggregates.headway_by_window(views.positions(spark, sf_dir))


@query
def headway_per_visit(spark, sf_dir):
    """A vehicle's stay at a stop counts with its first report."""
    return processing.clean_positions(views.raw_positions(spark, sf_dir), per_visit=True).select(
        "vehicle_id", "trip_id", "route_id", "stop_id", "mta_timestamp", "headway_gap_sec"
    )


# --- deduplication -----------------------------------------------------------------------


@query
def dedup_first_delays(spark, sf_dir):
    return dedup.keep_first(views.twice(views.raw_delays(spark, sf_dir)), dedup.DELAY_KEY)


@query
def dedup_first_alerts(spark, sf_dir):
    return dedup.keep_first(views.twice(views.raw_alerts(spark, sf_dir)), dedup.ALERT_KEY)


@query
def dedup_first_weather(spark, sf_dir):
    return dedup.keep_first(views.twice(views.raw_weather(spark, sf_dir)), dedup.WEATHER_KEY)


@query
def dedup_first_positions(spark, sf_dir):
    return dedup.keep_first(views.twice(views.raw_positions(spark, sf_dir)), dedup.POSITION_KEY)


@query
def dedup_changed_weather(spark, sf_dir):
    """Copies that differ: only the right order finds the first."""
    rows = views.raw_weather(spark, sf_dir)
    return dedup.keep_first(views.changed(rows, temperature_c=F.col("temperature_c") + 1), dedup.WEATHER_KEY)


@query
def dedup_changed_positions(spark, sf_dir):
    rows = views.raw_positions(spark, sf_dir)
    return dedup.keep_first(views.changed(rows, current_status=F.col("current_status") + 10), dedup.POSITION_KEY)


@query
def dedup_changed_latest(spark, sf_dir):
    rows = views.raw_positions(spark, sf_dir)
    return dedup.latest_position(views.changed(rows, current_status=F.col("current_status") + 10))


@query
def dedup_rn_delays(spark, sf_dir):
    return dedup.earliest_delay(views.twice(views.raw_delays(spark, sf_dir)))


@query
def dedup_rn_alerts(spark, sf_dir):
    return dedup.latest_alert(filters.unnest_routes(views.twice(views.raw_alerts(spark, sf_dir))))


@query
def dedup_rn_positions(spark, sf_dir):
    return dedup.latest_position(views.twice(views.raw_positions(spark, sf_dir)))


@query
def dedup_rn_weather(spark, sf_dir):
    return dedup.latest_observation(views.twice(views.weather(spark, sf_dir)))


@query
def distinct_on_weather(spark, sf_dir):
    return dedup.latest_weather_snapshot(views.twice(views.weather(spark, sf_dir)))


@query
def worst_stop(spark, sf_dir):
    return aggregates.worst_stop(_named_delays(spark, sf_dir))


@query
def qualify_ongoing(spark, sf_dir):
    ongoing = filters.with_status(_timed_alerts(spark, sf_dir), ["ongoing"], AS_OF)
    return dedup.longest_running(filters.unnest_routes(ongoing))


@query
def qualify_upcoming(spark, sf_dir):
    upcoming = filters.with_status(_timed_alerts(spark, sf_dir), ["upcoming"], AS_OF)
    return dedup.soonest(filters.unnest_routes(upcoming))


# --- joins -------------------------------------------------------------------------------


def _delay_windows(spark, sf_dir):
    return aggregates.delays_by_window(views.delays(spark, sf_dir))


def _alert_windows(spark, sf_dir):
    return aggregates.alert_count_by_window(filters.unnest_routes(views.alerts(spark, sf_dir)))


@query
def join_alerts(spark, sf_dir):
    return joins.join_alerts(_delay_windows(spark, sf_dir), _alert_windows(spark, sf_dir))


@query
def join_positions(spark, sf_dir):
    return joins.join_on_grain(
        _delay_windows(spark, sf_dir), aggregates.headway_by_window(views.positions(spark, sf_dir))
    )


@query
def join_worst_stop(spark, sf_dir):
    return joins.join_on_grain(_delay_windows(spark, sf_dir), aggregates.worst_stop(_named_delays(spark, sf_dir)))


@query
def join_weather_hour(spark, sf_dir):
    weather = dedup.latest_weather_snapshot(views.weather(spark, sf_dir)).select("obs_hour", "temperature_c")
    return joins.join_weather(_delay_windows(spark, sf_dir), weather)


@query
def star_join(spark, sf_dir):
    weather = dedup.latest_weather_snapshot(views.weather(spark, sf_dir)).select("obs_hour", "temperature_c")
    return joins.star_join(
        _delay_windows(spark, sf_dir),
        _alert_windows(spark, sf_dir),
        aggregates.headway_by_window(views.positions(spark, sf_dir)),
        weather,
    )


# --- tables ------------------------------------------------------------------------------


@query
def processed_delays(spark, sf_dir):
    return processing.clean_delays(views.twice(views.raw_delays(spark, sf_dir)))


@query
def processed_alerts(spark, sf_dir):
    return processing.clean_alerts(views.twice(views.raw_alerts(spark, sf_dir)))


@query
def processed_positions(spark, sf_dir):
    return processing.clean_positions(views.twice(views.raw_positions(spark, sf_dir)))


@query
def processed_weather(spark, sf_dir):
    return processing.clean_weather(views.twice(views.raw_weather(spark, sf_dir)))


@query
def processed_weather_local(spark, sf_dir):
    """Hours stated in New York time, moved to true UTC."""
    return processing.clean_weather(views.raw_weather(spark, sf_dir), "America/New_York")


@query
def snapshot_delays(spark, sf_dir):
    """First reports taken inside each snapshot, before it becomes rows; each entity is there twice."""
    return processing.snapshot_delays(views.feed_twice(spark, sf_dir), ROUTES)


@query
def snapshot_alerts(spark, sf_dir):
    return processing.snapshot_alerts(views.feed_twice(spark, sf_dir), ROUTES)


@query
def snapshot_weather(spark, sf_dir):
    return processing.snapshot_weather(views.weather_responses(spark, sf_dir))


def once(df: DataFrame) -> DataFrame:
    """The rows of a single run."""
    return df


def _staged_delays(spark, sf_dir, runs=once):
    return staging.stg_delays(runs(views.delays(spark, sf_dir)), views.stops(spark, sf_dir))


def _staged_alerts(spark, sf_dir, runs=once):
    return staging.stg_alerts(runs(views.alerts(spark, sf_dir)), ROUTES)


def _staged_positions(spark, sf_dir, runs=once):
    return staging.stg_positions(runs(views.positions(spark, sf_dir)), ROUTES)


def _staged_weather(spark, sf_dir, runs=once):
    return staging.stg_weather(runs(views.weather(spark, sf_dir)))


@query
def stg_delays(spark, sf_dir):
    return _staged_delays(spark, sf_dir, views.twice)


@query
def stg_alerts(spark, sf_dir):
    return _staged_alerts(spark, sf_dir, views.twice)


@query
def stg_positions(spark, sf_dir):
    return _staged_positions(spark, sf_dir, views.twice)


@query
def stg_weather(spark, sf_dir):
    return _staged_weather(spark, sf_dir, views.twice)


def _fact(spark, sf_dir):
    return marts.fct_performance(
        _staged_delays(spark, sf_dir),
        _staged_alerts(spark, sf_dir),
        _staged_positions(spark, sf_dir),
        _staged_weather(spark, sf_dir),
    )


@query
def fct_performance(spark, sf_dir):
    """Without the build time, which differs on every run."""
    return _fact(spark, sf_dir).drop("dbt_updated_at")


@query
def dim_alerts_active(spark, sf_dir):
    return marts.dim_alerts_active(_staged_alerts(spark, sf_dir), AS_OF)


@query
def dim_alerts_seen_recently(spark, sf_dir):
    return marts.dim_alerts_active(_staged_alerts(spark, sf_dir), AS_OF, seen_within="1 day")


@query
def dim_weather_conditions(spark, sf_dir):
    return marts.dim_weather_conditions(_staged_weather(spark, sf_dir))


def _features(spark, sf_dir, runs=once, deduplicate=True):
    return marts.combined_features(
        runs(views.delays(spark, sf_dir)),
        runs(views.alerts(spark, sf_dir)),
        runs(views.weather(spark, sf_dir)),
        runs(views.positions(spark, sf_dir)),
        deduplicate,
    )


@query
def combined_features(spark, sf_dir):
    return _features(spark, sf_dir, views.twice)


@query
def combined_features_every_copy(spark, sf_dir):
    return _features(spark, sf_dir, views.twice, deduplicate=False)


# --- reports -----------------------------------------------------------------------------


@query
def report_latest(spark, sf_dir):
    return reports.latest_status(_features(spark, sf_dir))


@query
def report_series(spark, sf_dir):
    return reports.headway_weather_series(_features(spark, sf_dir))


@query
def report_last20(spark, sf_dir):
    return reports.recent_headways(_features(spark, sf_dir))


@query
def report_ongoing(spark, sf_dir):
    return reports.ongoing_disruptions(views.alerts(spark, sf_dir), AS_OF, ROUTES)


@query
def report_upcoming(spark, sf_dir):
    return reports.upcoming_work(views.alerts(spark, sf_dir), AS_OF, ROUTES)


@query
def report_heat(spark, sf_dir):
    return reports.extreme_heat_windows(_features(spark, sf_dir))


@query
def report_preview(spark, sf_dir):
    """The first rows of the listing, as a log line shows them."""
    return reports.preview(reports.newest_first(_features(spark, sf_dir)), 10)


@query
def report_all(spark, sf_dir):
    return reports.newest_first(_features(spark, sf_dir))


# --- checks ------------------------------------------------------------------------------

EXPECTED = quality.standard_expectations(ROUTES)


def _staged(spark, sf_dir):
    return {
        "stg_delays": _staged_delays(spark, sf_dir),
        "stg_alerts": _staged_alerts(spark, sf_dir),
        "stg_positions": _staged_positions(spark, sf_dir),
        "stg_weather": _staged_weather(spark, sf_dir),
        "fct_performance": _fact(spark, sf_dir),
    }


@query
def check_not_null(spark, sf_dir):
    """On raw delays, where both delay columns have gaps."""
    return quality.check_not_null(
        views.raw_delays(spark, sf_dir), "raw_delays", ["vehicle_id", "arrival_delay", "departure_delay"]
    )


@query
def check_accepted(spark, sf_dir):
    """Two routes and one severity left out on purpose, so that the check finds failures."""
    return quality.check_accepted(
        views.delays(spark, sf_dir),
        "delays",
        {"route_id": ["click", "error", "view"], "delay_severity": ["on_time", "minor", "moderate"]},
    )


@query
def check_unique(spark, sf_dir):
    """Observation hours before deduplication: most occur often."""
    return quality.check_unique(views.weather(spark, sf_dir), "weather", "obs_hour")


@query
def check_all_models(spark, sf_dir):
    return quality.check_all(_staged(spark, sf_dir), EXPECTED)


# --- streams -----------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    """The events table as a file stream. The path is a pattern because a file stream takes a
    folder or a pattern, and the table may be one file or a folder of them."""
    return spark.readStream.schema(views.EVENTS).parquet(f"{sf_dir}/events.{{parquet}}").withColumn("ts", F.col("ts").cast("timestamp"))


def _streamed(view, spark, sf_dir):
    """A view of ``views`` over the event stream instead of the event table."""
    return view(spark, sf_dir, _event_stream(spark, sf_dir))


GRAIN = list(aggregates.GRAIN)


# Whole source files, not in the order of their times: every slice spans all dates, so most rows are late.
SLICES = (2, 0, 3, 1)


def _slice(rows: DataFrame, number: int, slices: int = len(SLICES)) -> DataFrame:
    return rows.filter(F.pmod(F.hash("source_file"), F.lit(slices)) == number)


def _landed_stream(spark, landing, schema):
    return spark.readStream.schema(schema).options(**feeds.SCAN).parquet(landing)


def _in_rounds(spark, rows, schema, writer, root):
    """The slices land one after the other in sub-folders, and each is streamed when it has landed."""
    for number in SLICES:
        _slice(rows, number).write.parquet(f"{root}/landing/poll_{number}")
        stream = _landed_stream(spark, f"{root}/landing", schema)
        stream_sinks.drain(stream, writer, f"{root}/checkpoint", "append")


def _stream_delay_windows(spark, sf_dir):
    root = scratch_dir(spark, "stream")
    writer = stream_windows.delay_windows(f"{root}/delays", f"{root}/windows")
    _in_rounds(spark, views.twice(views.raw_delays(spark, sf_dir)), schemas.RAW_DELAYS, writer, root)
    return stream_windows.read_windows(spark, f"{root}/windows")


def _stream_positions(spark, sf_dir, root):
    writer = stream_headway_tables.headway_tables(f"{root}/stored", f"{root}/table")
    _in_rounds(spark, views.raw_positions(spark, sf_dir), schemas.RAW_POSITIONS, writer, root)
    return f"{root}/table"


@query
def stream_delays_15min(spark, sf_dir):
    """Each report twice, in four micro-batches out of time order."""
    return _stream_delay_windows(spark, sf_dir)


@query
def stream_alert_counts(spark, sf_dir):
    root = scratch_dir(spark, "stream")
    writer = stream_windows.alert_windows(f"{root}/alerts", f"{root}/windows")
    _in_rounds(spark, views.twice(views.raw_alerts(spark, sf_dir)), schemas.RAW_ALERTS, writer, root)
    return stream_windows.read_windows(spark, f"{root}/windows")


@query
def stream_weather_windows(spark, sf_dir):
    """Delays and weather as two streams; each round's weather comes after its windows, and both out of time order."""
    root = scratch_dir(spark, "stream")
    write_delays, write_weather = live_weather.live_weather(root, f"{root}/joined")
    inputs = {
        "delays": (views.twice(views.raw_delays(spark, sf_dir)), schemas.RAW_DELAYS, write_delays),
        "weather": (views.raw_weather(spark, sf_dir), schemas.RAW_WEATHER, write_weather),
    }
    for number in SLICES:
        for name, (rows, schema, writer) in inputs.items():
            _slice(rows, number).write.parquet(f"{root}/landing/{name}/poll_{number}")
            stream = _landed_stream(spark, f"{root}/landing/{name}", schema)
            stream_sinks.drain(stream, writer, f"{root}/checkpoints/{name}", "append")
    return stream_windows.read_windows(spark, f"{root}/joined")


@query
def stream_named_delays(spark, sf_dir):
    """Stop names joined onto each micro-batch."""
    root = scratch_dir(spark, "stream")
    named = stream_windows.named_delays_stream(_streamed(views.raw_delays, spark, sf_dir), views.stops(spark, sf_dir))
    stream_sinks.drain(named, stream_sinks.changes_to(f"{root}/rows"), f"{root}/checkpoint", "append")
    rows = spark.read.parquet(f"{root}/rows")
    return rows.select("feed_seq", "stop_id", "stop_name", "direction", "event_time")


@query
def stream_headway(spark, sf_dir):
    return stream_headway_tables.read_headways(spark, _stream_positions(spark, sf_dir, scratch_dir(spark, "stream")))


@query
def stream_then_batch_positions(spark, sf_dir):
    """A stream and then a batch run on one store, read from a date on; copies count once."""
    path = _stream_positions(spark, sf_dir, scratch_dir(spark, "stream"))
    day = tables.vehicle_date(F.col("mta_timestamp"))
    sinks.save_processed(views.positions(spark, sf_dir), path, "batch", day)
    return tables.read_processed(spark, path, schemas.POSITIONS, since=SINCE).distinct()


SINCE = "2024-01-05"


def _processed_by_stream(spark, sf_dir):
    """Two polls below one landing root, taken by one run of the streams."""
    root = scratch_dir(spark, "stream")
    feed, responses = views.feed(spark, sf_dir), views.weather_responses(spark, sf_dir)
    for number in SLICES:
        sinks.land_snapshots(_slice(feed, number), f"{root}/feed", str(number))
        sinks.land_snapshots(_slice(responses, number), f"{root}/weather", str(number))
    landing = stream_processing.Landing(*[f"{root}/feed"] * 3, f"{root}/weather")
    for stream in stream_processing.process_new(spark, landing, f"{root}/processed", f"{root}/state", ROUTES, "parquet"):
        stream.awaitTermination()
    return tables.open_catalog(spark, f"{root}/processed")


@query
def stream_processed_delays(spark, sf_dir):
    """Landed snapshots, streamed into the processed tables."""
    return _processed_by_stream(spark, sf_dir)["delays"]


@query
def stream_landing_root(spark, sf_dir):
    """Delay windows of what the streams have taken from a landing root."""
    return aggregates.delays_by_window(_processed_by_stream(spark, sf_dir)["delays"])


RAW = {
    "delays": (views.raw_delays, schemas.RAW_DELAYS),
    "alerts": (views.raw_alerts, schemas.RAW_ALERTS),
    "vehicle_positions": (views.raw_positions, schemas.RAW_POSITIONS),
    "weather": (views.raw_weather, schemas.RAW_WEATHER),
}


@query
def stream_features(spark, sf_dir):
    """Four streams in two rounds; each batch brings the features of the dates it touches up to date."""
    root = scratch_dir(spark, "stream")
    for number in (1, 0):
        streams = {}
        for name, (view, schema) in RAW.items():
            _slice(view(spark, sf_dir), number, 2).write.parquet(f"{root}/landing/{name}/poll_{number}")
            streams[name] = _landed_stream(spark, f"{root}/landing/{name}", schema)
        running = stream_processing.process_streams(
            spark, streams, f"{root}/processed", f"{root}/state", changes=f"{root}/changes", features=f"{root}/features"
        )
        for stream in running:
            stream.awaitTermination()
    return stream_windows.read_windows(spark, f"{root}/features")


@query
def stream_event_time_windows(spark, sf_dir):
    """Windows from state and a watermark over snapshots in four rounds out of order, so most rows are late."""
    root = scratch_dir(spark, "stream")
    writer = event_time.event_time_upserts(f"{root}/delays", f"{root}/windows", f"{root}/notes", "2 hours")
    feed = views.feed(spark, sf_dir)
    for number in SLICES:
        sinks.land_snapshots(_slice(feed, number), f"{root}/landing", str(number))
        reports = processing.snapshot_delays(feeds.stream_feed(spark, f"{root}/landing"), ROUTES)
        stream_sinks.drain(event_time.windows_and_rows(reports, "2 hours"), writer, f"{root}/checkpoint", "update")
    return stream_windows.read_windows(spark, f"{root}/windows")


def _runs_of(spark, sf_dir, root, names, note, runs=3):
    """Runs of other source files, each noted after it is saved."""
    built = {"delays": views.delays, "alerts": views.alerts, "vehicle_positions": views.positions, "weather": views.weather}
    layout = {"vehicle_positions": tables.vehicle_date(F.col("mta_timestamp"))}
    for run in range(runs):
        for name in names:
            rows = _slice(built[name](spark, sf_dir), run, runs)
            path = tables.processed_paths(f"{root}/processed")[name]
            folder = sinks.save_processed(rows, path, f"run_{run}", layout.get(name, "event_time"))
            note(name, f"run_{run}", spark.read.schema(rows.schema).parquet(folder))
        yield run


def _in_increments(spark, sf_dir):
    """Three batch runs of other source files; after each one only the touched dates are computed again."""
    root = scratch_dir(spark, "increments")
    processed, log = f"{root}/processed", f"{root}/changes"

    def note(name, run, rows):
        refresh.log_changes(spark, log, name, run, refresh.changed_dates(spark, log, name, run, rows))

    for _ in _runs_of(spark, sf_dir, root, tables.TABLES, note):
        refresh.refresh(spark, processed, log, f"{root}/features")
    return stream_windows.read_windows(spark, f"{root}/features")


@query
def incremental_features(spark, sf_dir):
    return _in_increments(spark, sf_dir)


def _incremental_marts(spark, sf_dir, names):
    """Three runs, the marts refreshed after each; the stops are the given ones."""
    root = scratch_dir(spark, "marts")

    def note(name, run, rows):
        increments.note_run(spark, f"{root}/state", name, run, rows)

    for _ in _runs_of(spark, sf_dir, root, names, note):
        increments.refresh_marts(spark, f"{root}/processed", f"{root}/state", f"{root}/marts", views.stops(spark, sf_dir), ROUTES)
    return root


@query
def incremental_fact(spark, sf_dir):
    root = _incremental_marts(spark, sf_dir, tables.TABLES)
    return increments.read_fact(spark, f"{root}/marts").drop("dbt_updated_at")


@query
def incremental_weather(spark, sf_dir):
    root = _incremental_marts(spark, sf_dir, ["weather"])
    return increments.read_dimension(spark, f"{root}/marts")


@query
def incremental_alerts(spark, sf_dir):
    """The newest row per alert and route, merged from three runs of which each is older in part than the one before."""
    root = _incremental_marts(spark, sf_dir, ["alerts"])
    return latest.latest_alerts(spark, f"{root}/state/alerts").drop("source_file", "event_time")
