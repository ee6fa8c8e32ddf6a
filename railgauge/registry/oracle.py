"""SQL (DuckDB dialect) that states each registered query's result over the same tables.

Written from the meaning of the query, not from its Spark plan: nested snapshots are checked
against the flat events they were built from, streams against the batch result.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-20 00:00:00'"
WEATHER = "temperature_c, humidity_pct, precip_mm, snowfall_cm, wind_speed_kmh, is_extreme_heat, is_precip, is_snow"


def quarter(column: str) -> str:
    return f"time_bucket(INTERVAL '15 minutes', {column})"


def severity(column: str) -> str:
    return (
        f"CASE WHEN coalesce({column}, 0) > 600 THEN 'severe' WHEN {column} > 300 THEN 'moderate' "
        f"WHEN {column} > 60 THEN 'minor' ELSE 'on_time' END"
    )


def gap_status(column: str) -> str:
    return (
        f"CASE WHEN {column} > 600 THEN 'sparse' WHEN {column} > 300 THEN 'normal' "
        f"WHEN {column} IS NOT NULL THEN 'bunched' ELSE 'unknown' END"
    )


# Effect codes and their labels.
LABELS = {
    1: "no_service",
    2: "reduced_service",
    3: "significant_delays",
    4: "detour",
    5: "additional_service",
    6: "modified_service",
    7: "other_effect",
    8: "unknown_effect",
    9: "stop_moved",
    10: "no_effect",
    11: "accessibility_issue",
}


def label(column: str) -> str:
    whens = " ".join(f"WHEN {code} THEN '{name}'" for code, name in LABELS.items())
    return f"CASE {column} {whens} ELSE 'unknown_effect' END"


def status(start: str = "start_time", end: str = "end_time") -> str:
    return (
        f"CASE WHEN {start} > {AS_OF} THEN 'upcoming' WHEN {end} IS NULL THEN 'ongoing' "
        f"WHEN {end} <= {AS_OF} THEN 'expired' ELSE 'active' END"
    )


def hours(later: str, earlier: str) -> str:
    return f"(epoch_us({later}) - epoch_us({earlier})) / 1000000 / 3600"


CONDITION = (
    "CASE WHEN snowfall_cm > 0 THEN 'snow' WHEN precip_mm > 5 THEN 'heavy_rain' WHEN precip_mm > 0 THEN 'light_rain' "
    "WHEN temperature_c >= 32.2 THEN 'extreme_heat' WHEN temperature_c >= 27 THEN 'hot' "
    "WHEN temperature_c <= 0 THEN 'freezing' ELSE 'mild' END"
)
FEELS_LIKE = (
    "CASE WHEN temperature_c >= 27 AND humidity_pct >= 60 "
    "THEN round(temperature_c + (humidity_pct - 60) * CAST(0.1 AS DOUBLE), 1) ELSE temperature_c END"
)
WIND = "CASE WHEN wind_speed_kmh >= 60 THEN 'strong' WHEN wind_speed_kmh >= 30 THEN 'moderate' ELSE 'light' END"
FLAGS = (
    "coalesce(temperature_c >= 32.2, false) AS is_extreme_heat, coalesce(precip_mm > 0, false) AS is_precip, "
    "coalesce(snowfall_cm > 0, false) AS is_snow"
)

ARRIVAL = "CASE WHEN event_id % 11 <> 0 THEN CAST(floor(value * 5) AS INTEGER) END"
DEPARTURE = "CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value * 4) AS INTEGER) END"
OTHER_ROUTE = "(['click', 'error', 'purchase', 'signup', 'view'])[user_id % 5 + 1]"
ROUTE_IDS = f"list_sort(list_distinct([event_type, {OTHER_ROUTE}]))"
SECOND = "(epoch_us(ts) // 1000000)"
START_EPOCH = f"CASE WHEN event_id % 13 <> 0 THEN {SECOND} + (event_id % 144 - 72) * 3600 END"
END_EPOCH = f"CASE WHEN event_id % 13 <> 0 AND event_id % 5 <> 0 THEN {SECOND} + event_id % 200 * 3600 END"
MEASURES = """
    floor(value * 2 - 50) / 10 AS temperature_c, CAST(user_id % 100 AS DOUBLE) AS humidity_pct,
    CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 80 AS DOUBLE) / 10 ELSE 0 END AS precip_mm,
    CASE WHEN event_id % 17 = 0 THEN CAST(0.5 AS DOUBLE) ELSE 0 END AS snowfall_cm,
    CAST(event_id % 90 AS DOUBLE) AS wind_speed_kmh"""


def plain_time(epoch: str) -> str:
    return f"make_timestamp(CAST({epoch} AS BIGINT) * 1000000)"


def first_row(source: str, keys: str, order: str) -> str:
    return f"SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS n FROM {source}) WHERE n = 1"


def copies(source: str, payload: str) -> str:
    """Each row and a copy that differs: an hour later where feed_seq is even, an hour earlier else."""
    moved = "event_time + CASE WHEN feed_seq % 2 = 0 THEN INTERVAL '1 hour' ELSE INTERVAL '-1 hour' END AS event_time"
    return f"(SELECT * FROM {source} UNION ALL SELECT * REPLACE ({moved}, {payload}) FROM {source})"


# Named relations; ``using`` puts the needed ones in front of a query.
RELATIONS: dict[str, str] = {
    "raw_delays": f"""
        SELECT CAST(user_id AS VARCHAR) AS vehicle_id, CAST(event_id % 500 AS VARCHAR) AS trip_id,
               event_type AS route_id, CAST(user_id % 30 AS VARCHAR) AS stop_id,
               {ARRIVAL} AS arrival_delay, {DEPARTURE} AS departure_delay,
               'f' || (event_id % 50) AS source_file, ts AS event_time, event_id AS feed_seq
        FROM events""",
    "raw_alerts": f"""
        SELECT 'A' || user_id AS alert_id, {ROUTE_IDS} AS route_ids, 'H' || (user_id % 12) AS header,
               repeat(props, 30) AS description, CAST(user_id % 13 AS INTEGER) AS effect,
               {START_EPOCH} AS start_time, {END_EPOCH} AS end_time,
               'f' || (event_id % 50) AS source_file, ts AS event_time, event_id AS feed_seq
        FROM events""",
    "raw_positions": f"""
        SELECT CAST(user_id AS VARCHAR) AS vehicle_id, CAST(event_id % 500 AS VARCHAR) AS trip_id,
               event_type AS route_id, 'S' || (user_id % 2) AS stop_id,
               CAST(event_id % 40 AS INTEGER) AS current_stop_sequence, CAST(event_id % 3 AS INTEGER) AS current_status,
               CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 7 AS INTEGER) END AS occupancy_status,
               {SECOND} AS mta_timestamp,
               'f' || (event_id % 50) AS source_file, ts AS event_time, event_id AS feed_seq
        FROM events""",
    "raw_weather": f"""
        SELECT {MEASURES}, strftime(ts, '%Y-%m-%dT%H:%M') AS weather_timestamp,
               'w' || (event_id % 50) AS source_file, ts AS event_time, event_id AS feed_seq
        FROM events""",
    "stops": """
        SELECT CAST(n_nationkey AS VARCHAR) AS stop_id, n_name AS stop_name, CAST(n_regionkey AS VARCHAR) AS line,
               CASE WHEN n_nationkey % 2 = 0 THEN 'Northbound' ELSE 'Southbound' END AS direction
        FROM nation""",
    "known_delays": "SELECT * FROM raw_delays WHERE NOT (arrival_delay IS NULL AND departure_delay IS NULL)",
    "first_delays": first_row("known_delays", "vehicle_id, trip_id, stop_id, source_file", "event_time, feed_seq"),
    "delays": f"""
        SELECT vehicle_id, trip_id, route_id, stop_id, coalesce(arrival_delay, 0) AS arrival_delay,
               coalesce(departure_delay, 0) AS departure_delay, source_file, event_time,
               {severity('arrival_delay')} AS delay_severity, {quarter('event_time')} AS window_start
        FROM first_delays""",
    "first_alerts": first_row("raw_alerts", "alert_id, source_file", "event_time, feed_seq"),
    "timed_alerts": f"""
        SELECT * REPLACE ({plain_time('start_time')} AS start_time, {plain_time('end_time')} AS end_time)
        FROM raw_alerts""",
    "alerts": f"""
        SELECT alert_id, route_ids, header, description, effect, {plain_time('start_time')} AS start_time,
               {plain_time('end_time')} AS end_time, source_file, event_time, {label('effect')} AS severity,
               left(description, 200) AS description_short, {quarter('event_time')} AS window_start
        FROM first_alerts""",
    "alert_routes": "SELECT unnest(route_ids) AS route_id, * EXCLUDE (route_ids) FROM alerts",
    "first_positions": first_row(
        "raw_positions", "vehicle_id, trip_id, stop_id, mta_timestamp", "event_time, feed_seq"
    ),
    "gapped": """
        SELECT *, CAST(mta_timestamp - lag(mta_timestamp) OVER (
                   PARTITION BY route_id, stop_id ORDER BY mta_timestamp, vehicle_id, trip_id) AS DOUBLE) AS gap
        FROM first_positions""",
    "positions": f"""
        SELECT vehicle_id, trip_id, route_id, stop_id, current_stop_sequence, current_status, occupancy_status,
               {plain_time('mta_timestamp')} AS mta_timestamp, source_file, event_time,
               CASE WHEN gap <= 1800 THEN gap END AS headway_gap_sec,
               {gap_status('CASE WHEN gap <= 1800 THEN gap END')} AS headway_status,
               {quarter('event_time')} AS window_start
        FROM gapped""",
    "timed_weather": """
        SELECT * REPLACE (CAST(weather_timestamp AS TIMESTAMP) AS weather_timestamp) FROM raw_weather""",
    "first_weather": first_row("timed_weather", "weather_timestamp, source_file", "event_time, feed_seq"),
    "weather": f"""
        SELECT temperature_c, humidity_pct, precip_mm, snowfall_cm, wind_speed_kmh, weather_timestamp, source_file,
               event_time, {quarter('event_time')} AS window_start,
               CAST(date_trunc('hour', weather_timestamp) AS TIMESTAMP) AS obs_hour, {FLAGS}
        FROM first_weather""",
    "stg_delays": """
        SELECT vehicle_id, trip_id, route_id, d.stop_id, stop_name, direction, arrival_delay, departure_delay,
               delay_severity, source_file, event_time, window_start
        FROM delays d LEFT JOIN stops s ON d.stop_id = s.stop_id""",
    "stg_alerts": f"""
        SELECT alert_id, route_id, header, description_short, severity, start_time, end_time, window_start
        FROM ({first_row('alert_routes', 'alert_id, route_id', 'event_time DESC')})""",
    "stg_positions": f"""
        SELECT vehicle_id, trip_id, route_id, stop_id, current_stop_sequence, current_status, mta_timestamp,
               headway_gap_sec, headway_status, window_start, {gap_status('headway_gap_sec')} AS occupancy_proxy
        FROM positions""",
    "hourly_weather": first_row("weather", "obs_hour", "weather_timestamp DESC, event_time DESC"),
    "stg_weather": "SELECT * EXCLUDE (source_file, event_time, window_start) FROM hourly_weather",
    "newest_weather": first_row("weather", "obs_hour", "event_time DESC"),
    "delay_windows": """
        SELECT route_id, window_start, avg(arrival_delay) AS avg_delay_sec, max(arrival_delay) AS max_delay_sec,
               count(*) AS delay_records
        FROM delays GROUP BY ALL""",
    "alert_windows": """
        SELECT route_id, window_start, count(DISTINCT alert_id) AS alerts_active FROM alert_routes GROUP BY ALL""",
    "gap_windows": """
        SELECT route_id, window_start, avg(headway_gap_sec) AS avg_headway_gap_sec,
               max(headway_gap_sec) AS max_headway_gap_sec
        FROM positions GROUP BY ALL""",
    "features": f"""
        SELECT route_id, window_start, avg_delay_sec, max_delay_sec, delay_records,
               coalesce(alerts_active, 0) AS alerts_active, avg_headway_gap_sec, max_headway_gap_sec, {WEATHER}
        FROM delay_windows
        LEFT JOIN alert_windows USING (route_id, window_start)
        LEFT JOIN gap_windows USING (route_id, window_start)
        LEFT JOIN newest_weather w ON date_trunc('hour', delay_windows.window_start) = w.obs_hour""".replace(
        "SELECT route_id, window_start", "SELECT delay_windows.route_id, delay_windows.window_start"
    ),
    "fact": f"""
        SELECT d.route_id, d.window_start, worst.stop_name AS worst_stop_name, worst.stop_id AS worst_stop_id,
               avg_delay_sec, max_delay_sec, delay_records, severe_count, moderate_count, minor_count, on_time_count,
               round((severe_count + moderate_count) / delay_records * 100, 2) AS pct_delayed,
               coalesce(alerts_active, 0) AS alerts_active, worst_severity, alert_headers,
               avg_headway_gap_sec, max_headway_gap_sec, bunched_count, sparse_count, {WEATHER}
        FROM (
            SELECT route_id, window_start, avg(arrival_delay) AS avg_delay_sec, max(arrival_delay) AS max_delay_sec,
                   count(*) AS delay_records,
                   count(*) FILTER (delay_severity = 'severe') AS severe_count,
                   count(*) FILTER (delay_severity = 'moderate') AS moderate_count,
                   count(*) FILTER (delay_severity = 'minor') AS minor_count,
                   count(*) FILTER (delay_severity = 'on_time') AS on_time_count
            FROM stg_delays GROUP BY ALL
        ) d
        LEFT JOIN worst_stops worst ON worst.route_id = d.route_id AND worst.window_start = d.window_start
        LEFT JOIN (
            SELECT route_id, window_start, count(DISTINCT alert_id) AS alerts_active, max(severity) AS worst_severity,
                   string_agg(DISTINCT header, ' | ' ORDER BY header) AS alert_headers
            FROM stg_alerts GROUP BY ALL
        ) a ON a.route_id = d.route_id AND a.window_start = d.window_start
        LEFT JOIN (
            SELECT route_id, window_start, avg(headway_gap_sec) AS avg_headway_gap_sec,
                   max(headway_gap_sec) AS max_headway_gap_sec,
                   count(*) FILTER (occupancy_proxy = 'bunched') AS bunched_count,
                   count(*) FILTER (occupancy_proxy = 'sparse') AS sparse_count
            FROM stg_positions GROUP BY ALL
        ) p ON p.route_id = d.route_id AND p.window_start = d.window_start
        LEFT JOIN stg_weather w ON w.obs_hour = date_trunc('hour', d.window_start)""",
    "worst_stops": first_row("stg_delays", "route_id, window_start", "arrival_delay DESC, stop_id DESC"),
    "snapshot_events": f"""
        SELECT *, event_id // 16 AS snapshot, {plain_time('min(' + SECOND + ') OVER (PARTITION BY event_id // 16)')} AS polled
        FROM events""",
    "response_events": f"""
        SELECT {MEASURES}, strftime(ts, '%Y-%m-%dT%H:%M') AS weather_timestamp, 'w' || (event_id // 24) AS source_file,
               CAST(date_trunc('second', min(ts) OVER (PARTITION BY event_id // 24)) AS TIMESTAMP) AS event_time,
               event_id // 24 % 10 = 0 AS only_current,
               event_id = max(event_id) OVER (PARTITION BY event_id // 24) AS is_last
        FROM events""",
}

# What each relation reads.
NEEDS = {
    "known_delays": ["raw_delays"],
    "first_delays": ["known_delays"],
    "delays": ["first_delays"],
    "first_alerts": ["raw_alerts"],
    "timed_alerts": ["raw_alerts"],
    "alerts": ["first_alerts"],
    "alert_routes": ["alerts"],
    "first_positions": ["raw_positions"],
    "gapped": ["first_positions"],
    "positions": ["gapped"],
    "timed_weather": ["raw_weather"],
    "first_weather": ["timed_weather"],
    "weather": ["first_weather"],
    "stg_delays": ["delays", "stops"],
    "stg_alerts": ["alert_routes"],
    "stg_positions": ["positions"],
    "hourly_weather": ["weather"],
    "stg_weather": ["hourly_weather"],
    "newest_weather": ["weather"],
    "delay_windows": ["delays"],
    "alert_windows": ["alert_routes"],
    "gap_windows": ["positions"],
    "features": ["delay_windows", "alert_windows", "gap_windows", "newest_weather"],
    "worst_stops": ["stg_delays"],
    "fact": ["stg_delays", "worst_stops", "stg_alerts", "stg_positions", "stg_weather"],
}


def using(*names: str, query: str) -> str:
    """The query behind a WITH clause that defines the relations and all they read."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in NEEDS.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    clauses = ",\n".join(f"{name} AS ({RELATIONS[name].strip()})" for name in ordered)
    body = query.strip()
    if body.startswith("WITH "):
        return f"WITH {clauses},\n{body[5:]}"
    return f"WITH {clauses}\n{body}"


def table(name: str, columns: str = "*", tail: str = "") -> str:
    return using(name, query=f"SELECT {columns} FROM {name} {tail}")


DELAY_COLUMNS = "feed_seq, vehicle_id, trip_id, route_id, stop_id, arrival_delay, departure_delay"
ALERT_COLUMNS = "feed_seq, alert_id, header"
LISTED_ROUTES = "array_to_string(route_ids, ',') AS route_ids"

# Gaps over every position, told apart by feed_seq.
ALL_GAPS = """
    SELECT feed_seq, route_id, stop_id, mta_timestamp,
           CAST(mta_timestamp - lag(mta_timestamp) OVER (
               PARTITION BY route_id, stop_id ORDER BY mta_timestamp, feed_seq) AS DOUBLE) AS gap
    FROM raw_positions"""
GAP_COLUMNS = "feed_seq, route_id, stop_id, mta_timestamp"


def failures(model: str, source: str, not_null=(), accepted=None, unique=()) -> str:
    parts = [
        f"SELECT '{model}' AS model, '{column}' AS column_name, 'not_null' AS check_name, "
        f"count(*) FILTER ({column} IS NULL) AS failures FROM {source}"
        for column in not_null
    ]
    for column, values in (accepted or {}).items():
        listed = ", ".join(f"'{value}'" for value in values)
        parts.append(
            f"SELECT '{model}', '{column}', 'accepted_values', "
            f"count(*) FILTER ({column} NOT IN ({listed})) FROM {source}"
        )
    for column in unique:
        parts.append(
            f"SELECT '{model}' AS model, '{column}' AS column_name, 'unique' AS check_name, count(*) AS failures FROM "
            f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
        )
    return " UNION ALL ".join(parts)


ALL_ROUTES = ["click", "error", "purchase", "signup", "view"]
SEVERITIES = ["on_time", "minor", "moderate", "severe"]
ALL_CHECKS = " UNION ALL ".join(
    [
        failures(
            "stg_delays",
            "stg_delays",
            ["vehicle_id", "trip_id", "route_id", "stop_id", "arrival_delay", "delay_severity", "window_start"],
            {"route_id": ALL_ROUTES, "delay_severity": SEVERITIES},
        ),
        failures("stg_alerts", "stg_alerts", ["alert_id", "route_id", "severity", "window_start"], {"route_id": ALL_ROUTES}),
        failures(
            "stg_positions",
            "stg_positions",
            ["vehicle_id", "route_id", "occupancy_proxy", "window_start"],
            {"route_id": ALL_ROUTES, "occupancy_proxy": ["bunched", "normal", "sparse", "unknown"]},
        ),
        failures("stg_weather", "stg_weather", ["obs_hour", "temperature_c", "humidity_pct"], unique=["obs_hour"]),
        failures(
            "fct_performance", "fact", ["route_id", "window_start", "avg_delay_sec", "alerts_active"], {"route_id": ALL_ROUTES}
        ),
    ]
)

HOUR_TEXT = "CASE WHEN {h} >= 24 THEN ({h} // 24) || 'd ' || ({h} % 24) || 'h' ELSE {h} || 'h' END"
SINCE = hours(AS_OF, "start_time")
UNTIL = hours("start_time", AS_OF)
DATE_TEXT = "'%b %d %H:%M UTC'"

FIRST_PERIOD = f"""
    SELECT unnest(route_ids) AS route_id, header, start_time, end_time, {status()} AS alert_status FROM alerts"""

SQL: dict[str, str] = {
    "filter_routes": table("raw_delays", DELAY_COLUMNS, "WHERE route_id IN ('click', 'view')"),
    "filter_any_delay": table("known_delays", DELAY_COLUMNS),
    "filter_arrival_known": table("raw_delays", DELAY_COLUMNS, "WHERE arrival_delay IS NOT NULL"),
    "project_rename": table("raw_positions", "feed_seq, vehicle_id, route_id, stop_id, mta_timestamp AS reported_at"),
    "delay_severity": table("raw_delays", f"feed_seq, arrival_delay, {severity('arrival_delay')} AS delay_severity"),
    "null_to_zero": table(
        "raw_delays",
        "feed_seq, coalesce(arrival_delay, 0) AS arrival_delay, coalesce(departure_delay, 0) AS departure_delay",
    ),
    "window_15min": f"SELECT event_id, {quarter('ts')} AS window_start FROM events",
    "hour_floor": "SELECT event_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS obs_hour FROM events",
    "epoch_parse": f"""
        SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS second,
               {plain_time("TRY_CAST(event_type AS BIGINT)")} AS unreadable
        FROM events""",
    "iso_parse": """
        SELECT event_id, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS wall_clock,
               CAST(date_trunc('second', ts) AS TIMESTAMP) + INTERVAL 4 HOURS AS instant
        FROM events""",
    "local_to_utc": """
        SELECT event_id, ts AS labelled, ts + INTERVAL 5 HOURS AS shifted FROM events""",
    "explode_stop_updates": using(
        "snapshot_events",
        query=f"""
        SELECT CAST(user_id AS VARCHAR) AS vehicle_id, CAST(event_id % 500 AS VARCHAR) AS trip_id,
               event_type AS route_id, CAST(user_id % 30 AS VARCHAR) AS stop_id, {ARRIVAL} AS arrival_delay,
               {DEPARTURE} AS departure_delay, 's' || snapshot AS source_file, polled AS event_time
        FROM snapshot_events
        UNION ALL
        SELECT CAST(user_id AS VARCHAR), CAST(event_id % 500 AS VARCHAR), event_type,
               CAST((user_id + 1) % 30 AS VARCHAR), {ARRIVAL} + 30, NULL, 's' || snapshot, polled
        FROM snapshot_events""",
    ),
    "explode_vehicles": using(
        "snapshot_events",
        query=f"""
        SELECT CAST(user_id AS VARCHAR) AS vehicle_id, CAST(event_id % 500 AS VARCHAR) AS trip_id,
               event_type AS route_id, 'S' || (user_id % 2) AS stop_id,
               CAST(event_id % 40 AS INTEGER) AS current_stop_sequence, CAST(event_id % 3 AS INTEGER) AS current_status,
               CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 7 AS INTEGER) END AS occupancy_status,
               {SECOND} AS mta_timestamp, 's' || snapshot AS source_file, polled AS event_time
        FROM snapshot_events""",
    ),
    "flatten_alerts": using(
        "snapshot_events",
        query=f"""
        SELECT 'A' || user_id AS alert_id,
               array_to_string(list_sort(list_distinct([event_type, list_extract({ROUTE_IDS}, -1)])), ',') AS route_ids,
               CASE WHEN event_id % 9 = 0 THEN '' ELSE 'H' || (user_id % 12) END AS header, '' AS description,
               CAST(user_id % 13 AS INTEGER) AS effect, {START_EPOCH} AS start_time, {END_EPOCH} AS end_time,
               's' || snapshot AS source_file, polled AS event_time
        FROM snapshot_events""",
    ),
    "hourly_arrays_to_rows": table("response_events", "* EXCLUDE (only_current, is_last)", "WHERE NOT only_current"),
    "weather_union_shapes": table(
        "response_events", "* EXCLUDE (only_current, is_last)", "WHERE is_last OR NOT only_current"
    ),
    "lineage_scan": "SELECT 'events.parquet' AS source_file, count(*) AS rows FROM events",
    "new_files_only": """
        SELECT 'f' || (event_id // 4) AS source_file FROM events
        GROUP BY event_id // 4 HAVING count(*) FILTER (event_type = 'error') = 0""",
    "seed_scan": table("stops"),
    "roundtrip_write_validate": table("delays"),
    "overwrite_features": table("delay_windows"),
    "materialize_view_table": table(
        "delays",
        "route_id, window_start, "
        + ", ".join(f"count(*) FILTER (delay_severity = '{name}') AS {name}_count" for name in SEVERITIES),
        "GROUP BY route_id, window_start",
    ),
    "source_catalog": using(
        "delays",
        "alerts",
        "weather",
        "positions",
        query="""
        SELECT 'delays' AS source, count(*) AS rows FROM delays UNION ALL SELECT 'alerts', count(*) FROM alerts
        UNION ALL SELECT 'weather', count(*) FROM weather UNION ALL SELECT 'vehicle_positions', count(*) FROM positions""",
    ),
    "empty_input": table("delay_windows", "*", "WHERE false"),
    "ingest_metrics": using(
        "raw_delays",
        "first_delays",
        "raw_weather",
        query="""
        SELECT (SELECT count(*) FROM raw_delays) AS raw_records, (SELECT count(*) FROM first_delays) AS clean_records,
               (SELECT count(*) FROM raw_weather) AS hourly_records,
               (SELECT count(*) FROM raw_weather WHERE precip_mm > 0) AS wet_hours""",
    ),
    "feed_entity_metrics": """
        SELECT count(DISTINCT event_id // 16) AS snapshots, 3 * count(*) AS entities, count(*) AS trip_update_entities,
               count(*) AS vehicle_entities, count(*) AS alert_entities
        FROM events""",
    "weather_flags": table("raw_weather", f"feed_seq, {FLAGS}"),
    "weather_bucket": table("raw_weather", f"feed_seq, {CONDITION} AS condition_bucket"),
    "feels_like": table("raw_weather", f"feed_seq, temperature_c, humidity_pct, {FEELS_LIKE} AS feels_like_c"),
    "wind_category": table("raw_weather", f"feed_seq, wind_speed_kmh, {WIND} AS wind_category"),
    "effect_label": table("raw_alerts", f"feed_seq, effect, {label('effect')} AS severity"),
    "text_prefix": """
        SELECT doc_id, left(text, 200) AS description_short, left(text, 80) || '...' AS title FROM documents""",
    "alert_status": table("timed_alerts", f"{ALERT_COLUMNS}, {status()} AS alert_status"),
    "alerts_relevant": table("timed_alerts", ALERT_COLUMNS, f"WHERE {status()} <> 'expired'"),
    "alerts_not_ended": table("timed_alerts", ALERT_COLUMNS, f"WHERE end_time IS NULL OR end_time > {AS_OF}"),
    "alerts_with_status": table("timed_alerts", ALERT_COLUMNS, f"WHERE {status()} IN ('ongoing', 'upcoming')"),
    "alert_hours": table("timed_alerts", f"{ALERT_COLUMNS}, {SINCE} AS hours_since_start, {UNTIL} AS hours_until_start"),
    "unnest_routes": table("raw_alerts", f"unnest(route_ids) AS route_id, {ALERT_COLUMNS}"),
    "epoch_start_alerts": table("raw_alerts", "count(*) FILTER (start_time IS NULL) AS failures"),
    "join_stop_dim": using(
        "raw_delays",
        "stops",
        query="""
        SELECT feed_seq, d.stop_id, stop_name, direction FROM raw_delays d LEFT JOIN stops s ON s.stop_id = d.stop_id""",
    ),
    "agg_delays_by_window": table("delay_windows"),
    "severity_counts": table(
        "delays",
        "route_id, window_start, "
        + ", ".join(f"count(*) FILTER (delay_severity = '{name}') AS {name}_count" for name in SEVERITIES),
        "GROUP BY route_id, window_start",
    ),
    "pct_delayed": table(
        "delays",
        "route_id, window_start, count(*) AS delay_records, "
        "round(count(*) FILTER (arrival_delay > 300) / count(*) * 100, 2) AS pct_delayed",
        "GROUP BY route_id, window_start",
    ),
    "alerts_by_window": table("alert_windows"),
    "worst_severity": table(
        "alert_routes", "route_id, window_start, max(severity) AS worst_severity", "GROUP BY route_id, window_start"
    ),
    "alert_headers": table(
        "alert_routes",
        "route_id, window_start, string_agg(DISTINCT header, ' | ' ORDER BY header) AS alert_headers",
        "GROUP BY route_id, window_start",
    ),
    "data_freshness": table("delays", "max(window_start) AS newest_window"),
    "headway_gap": using("raw_positions", query=f"SELECT {GAP_COLUMNS}, gap AS headway_gap_sec FROM ({ALL_GAPS})"),
    "headway_cap_null": using(
        "raw_positions",
        query=f"SELECT {GAP_COLUMNS}, CASE WHEN gap <= 1800 THEN gap END AS headway_gap_sec FROM ({ALL_GAPS})",
    ),
    "headway_cap_filter": using(
        "raw_positions",
        query=f"SELECT {GAP_COLUMNS}, gap AS headway_gap_sec FROM ({ALL_GAPS}) WHERE gap IS NULL OR gap <= 1800",
    ),
    "headway_status": using(
        "raw_positions",
        query=f"SELECT feed_seq, {gap_status('CASE WHEN gap <= 1800 THEN gap END')} AS headway_status FROM ({ALL_GAPS})",
    ),
    "headway_by_window": table("gap_windows"),
    "headway_per_visit": using(
        "first_positions",
        query=f"""
        SELECT vehicle_id, trip_id, route_id, stop_id, {plain_time('mta_timestamp')} AS mta_timestamp,
               CASE WHEN gap <= 1800 THEN gap END AS headway_gap_sec
        FROM (
            SELECT *, CAST(mta_timestamp - lag(mta_timestamp) OVER (
                       PARTITION BY route_id, stop_id ORDER BY mta_timestamp, vehicle_id, trip_id) AS DOUBLE) AS gap
            FROM ({first_row('first_positions', 'vehicle_id, trip_id, route_id, stop_id', 'mta_timestamp')})
        )""",
    ),
    "dedup_first_delays": using(
        "raw_delays",
        query=first_row("raw_delays", "vehicle_id, trip_id, stop_id, source_file", "event_time, feed_seq"),
    ),
    "dedup_first_alerts": table("first_alerts", f"* REPLACE ({LISTED_ROUTES})"),
    "dedup_first_weather": using(
        "raw_weather", query=first_row("raw_weather", "weather_timestamp, source_file", "event_time, feed_seq")
    ),
    "dedup_first_positions": table("first_positions"),
    "dedup_rn_delays": using(
        "raw_delays", query=first_row("raw_delays", "vehicle_id, trip_id, stop_id, source_file", "event_time")
    ),
    "dedup_rn_alerts": using(
        "raw_alerts",
        query=first_row(
            "(SELECT unnest(route_ids) AS route_id, * EXCLUDE (route_ids) FROM raw_alerts)",
            "alert_id, route_id",
            "event_time DESC",
        ),
    ),
    "dedup_rn_positions": using(
        "raw_positions",
        query=first_row("raw_positions", "vehicle_id, trip_id, stop_id, mta_timestamp", "event_time DESC"),
    ),
    "dedup_rn_weather": table("hourly_weather"),
    "distinct_on_weather": table("newest_weather"),
    "worst_stop": table(
        "worst_stops", "route_id, window_start, stop_id AS worst_stop_id, stop_name AS worst_stop_name"
    ),
    "qualify_ongoing": using(
        "timed_alerts",
        query=f"""
        SELECT route_id, header, min(start_time) AS start_time
        FROM (SELECT unnest(route_ids) AS route_id, header, start_time, {status()} AS s FROM timed_alerts)
        WHERE s = 'ongoing' GROUP BY route_id, header""",
    ),
    "qualify_upcoming": using(
        "timed_alerts",
        query=f"""
        SELECT route_id, header, start_time, end_time
        FROM (SELECT unnest(route_ids) AS route_id, header, start_time, end_time, {status()} AS s FROM timed_alerts)
        WHERE s = 'upcoming'
        QUALIFY row_number() OVER (PARTITION BY route_id, header ORDER BY start_time, end_time NULLS FIRST) = 1""",
    ),
    "join_alerts": using(
        "delay_windows",
        "alert_windows",
        query="""
        SELECT d.*, coalesce(a.alerts_active, 0) AS alerts_active FROM delay_windows d
        LEFT JOIN alert_windows a ON a.route_id = d.route_id AND a.window_start = d.window_start""",
    ),
    "join_positions": using(
        "delay_windows",
        "gap_windows",
        query="""
        SELECT d.*, p.avg_headway_gap_sec, p.max_headway_gap_sec FROM delay_windows d
        LEFT JOIN gap_windows p ON p.route_id = d.route_id AND p.window_start = d.window_start""",
    ),
    "join_worst_stop": using(
        "delay_windows",
        "worst_stops",
        query="""
        SELECT d.*, w.stop_id AS worst_stop_id, w.stop_name AS worst_stop_name FROM delay_windows d
        LEFT JOIN worst_stops w ON w.route_id = d.route_id AND w.window_start = d.window_start""",
    ),
    "join_weather_hour": using(
        "delay_windows",
        "newest_weather",
        query="""
        SELECT d.*, w.temperature_c FROM delay_windows d
        LEFT JOIN newest_weather w ON w.obs_hour = date_trunc('hour', d.window_start)""",
    ),
    "star_join": table(
        "features",
        "route_id, window_start, avg_delay_sec, max_delay_sec, delay_records, alerts_active, avg_headway_gap_sec, "
        "max_headway_gap_sec, temperature_c",
    ),
    "processed_delays": table("delays"),
    "processed_alerts": table("alerts", f"* REPLACE ({LISTED_ROUTES})"),
    "processed_positions": table("positions"),
    "processed_weather": table("weather"),
    "processed_weather_local": table("weather", "* REPLACE (obs_hour + INTERVAL 5 HOURS AS obs_hour)"),
    "stg_delays": table("stg_delays"),
    "stg_alerts": table("stg_alerts"),
    "stg_positions": table("stg_positions"),
    "stg_weather": table("stg_weather"),
    "fct_performance": table("fact"),
    "dim_alerts_active": table(
        "stg_alerts",
        f"alert_id, route_id, header, description_short, severity, start_time, end_time, {status()} AS alert_status, "
        f"{SINCE} AS hours_since_start, {UNTIL} AS hours_until_start, window_start",
        f"WHERE {status()} <> 'expired'",
    ),
    "dim_alerts_seen_recently": table(
        "stg_alerts",
        f"alert_id, route_id, header, description_short, severity, start_time, end_time, {status()} AS alert_status, "
        f"{SINCE} AS hours_since_start, {UNTIL} AS hours_until_start, window_start",
        f"WHERE {status()} <> 'expired' AND window_start >= {AS_OF} - INTERVAL 1 DAY",
    ),
    "dim_weather_conditions": table(
        "stg_weather",
        f"obs_hour, {WEATHER}, {CONDITION} AS condition_bucket, {FEELS_LIKE} AS feels_like_c, {WIND} AS wind_category",
    ),
    "combined_features": table("features"),
    "combined_features_every_copy": table("features", "* REPLACE (2 * delay_records AS delay_records)"),
    "report_latest": table(
        "features",
        """
        coalesce((CAST(floor(avg_headway_gap_sec) AS BIGINT) // 60) || 'm '
                 || (CAST(floor(avg_headway_gap_sec) AS BIGINT) % 60) || 's', '—') AS avg_headway_gap,
        coalesce((CAST(floor(max_headway_gap_sec) AS BIGINT) // 60) || 'm', '—') AS max_headway_gap,
        CAST(delay_records AS VARCHAR) AS delay_records, CAST(alerts_active AS VARCHAR) AS alerts,
        coalesce(printf('%.1f', temperature_c) || '°C' || CASE WHEN is_extreme_heat THEN ' 🔥' ELSE '' END, '—') AS temperature,
        coalesce(printf('%.1f', precip_mm) || 'mm' || CASE WHEN is_precip THEN ' 🌧' ELSE '' END, '—') AS precipitation,
        strftime(window_start, '%Y-%m-%d %H:%M UTC') AS last_run""",
        "ORDER BY window_start DESC, route_id LIMIT 1",
    ),
    "report_series": table(
        "features",
        "window_start, avg_headway_gap_sec, temperature_c",
        "WHERE NOT (avg_headway_gap_sec IS NULL AND temperature_c IS NULL)",
    ),
    "report_last20": table(
        "features",
        "window_start, avg_headway_gap_sec",
        "WHERE avg_headway_gap_sec IS NOT NULL ORDER BY window_start DESC, route_id DESC LIMIT 20",
    ),
    "report_ongoing": using(
        "alerts",
        query=f"""
        SELECT route_id, header, hours_since_start, {HOUR_TEXT.format(h='CAST(floor(hours_since_start) AS BIGINT)')} AS duration,
               left(header, 80) || '...' AS title
        FROM (
            SELECT route_id, header, max({SINCE}) AS hours_since_start FROM ({FIRST_PERIOD})
            WHERE alert_status = 'ongoing' GROUP BY route_id, header
        )""",
    ),
    "report_upcoming": using(
        "alerts",
        query=f"""
        SELECT route_id, header, hours_until_start, start_time, end_time,
               'in ' || {HOUR_TEXT.format(h='CAST(floor(hours_until_start) AS BIGINT)')} AS eta,
               strftime(start_time, {DATE_TEXT}) AS starts, coalesce(strftime(end_time, {DATE_TEXT}), 'TBD') AS ends,
               left(header, 80) || '...' AS title
        FROM (
            SELECT *, {UNTIL} AS hours_until_start FROM ({FIRST_PERIOD}) WHERE alert_status = 'upcoming'
            QUALIFY row_number() OVER (PARTITION BY route_id, header ORDER BY start_time, end_time NULLS FIRST) = 1
        )""",
    ),
    "report_heat": table(
        "features", "window_start, route_id, avg_headway_gap_sec, temperature_c, alerts_active", "WHERE is_extreme_heat"
    ),
    "report_all": table("features"),
    "check_not_null": using(
        "raw_delays", query=failures("raw_delays", "raw_delays", ["vehicle_id", "arrival_delay", "departure_delay"])
    ),
    "check_accepted": using(
        "delays",
        query=f"""SELECT * FROM ({failures(
            "delays", "delays",
            accepted={"route_id": ["click", "error", "view"], "delay_severity": SEVERITIES[:3]},
        )}) AS found(model, column_name, check_name, failures)""",
    ),
    "check_unique": using("weather", query=failures("weather", "weather", unique=["obs_hour"])),
    "check_all_models": using("fact", query=ALL_CHECKS),
    "stream_delays_15min": table("delay_windows"),
    "stream_alert_counts": table("alert_windows"),
    "stream_weather_windows": using(
        "delay_windows",
        "newest_weather",
        query="""
        SELECT d.*, w.temperature_c FROM delay_windows d
        LEFT JOIN newest_weather w ON date_trunc('hour', d.window_start) = w.obs_hour""",
    ),
    "stream_features": table("features"),
    "incremental_features": table("features"),
    "stream_then_batch_positions": table("positions", "*", "WHERE mta_timestamp >= TIMESTAMP '2024-01-05 00:00:00'"),
    "epoch_bounds": """
        SELECT event_id, CASE WHEN event_id % 4 = 3 THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS second
        FROM events""",
    "corrupt_files_counted": "SELECT count(*) AS lines, count(*) FILTER (event_id % 10 = 0) AS corrupt FROM events",
    "dedup_changed_weather": using(
        "raw_weather",
        query=first_row(
            copies("raw_weather", "temperature_c + 1 AS temperature_c"),
            "weather_timestamp, source_file",
            "event_time, feed_seq",
        ),
    ),
    "dedup_changed_positions": using(
        "raw_positions",
        query=first_row(
            copies("raw_positions", "CAST(current_status + 10 AS INTEGER) AS current_status"),
            "vehicle_id, trip_id, stop_id, mta_timestamp",
            "event_time, feed_seq",
        ),
    ),
    "dedup_changed_latest": using(
        "raw_positions",
        query=first_row(
            copies("raw_positions", "CAST(current_status + 10 AS INTEGER) AS current_status"),
            "vehicle_id, trip_id, stop_id, mta_timestamp",
            "event_time DESC",
        ),
    ),
    "stream_headway": table("positions"),
}

SQL["stream_processed_delays"] = using(
    "snapshot_events",
    query=f"""
    WITH updates AS (
        SELECT CAST(user_id AS VARCHAR) AS vehicle_id, CAST(event_id % 500 AS VARCHAR) AS trip_id,
               event_type AS route_id, CAST(user_id % 30 AS VARCHAR) AS stop_id, {ARRIVAL} AS arrival_delay,
               {DEPARTURE} AS departure_delay, 's' || snapshot AS source_file, polled AS event_time,
               2 * event_id AS place
        FROM snapshot_events
        UNION ALL
        SELECT CAST(user_id AS VARCHAR), CAST(event_id % 500 AS VARCHAR), event_type,
               CAST((user_id + 1) % 30 AS VARCHAR), {ARRIVAL} + 30, NULL, 's' || snapshot, polled, 2 * event_id + 1
        FROM snapshot_events
    ),
    known AS (SELECT * FROM updates WHERE NOT (arrival_delay IS NULL AND departure_delay IS NULL))
    SELECT * EXCLUDE (place) REPLACE (
               coalesce(arrival_delay, 0) AS arrival_delay, coalesce(departure_delay, 0) AS departure_delay),
           {severity('arrival_delay')} AS delay_severity, {quarter('event_time')} AS window_start
    FROM ({first_row('known', 'vehicle_id, trip_id, stop_id, source_file', 'place')})""",
)
SQL["landed_feed_scan"] = SQL["explode_stop_updates"]
SQL["landed_json_scan"] = SQL["explode_vehicles"]
SQL["report_preview"] = table("features", "*", "ORDER BY window_start DESC, route_id LIMIT 10")
SQL["stream_named_delays"] = using(
    "raw_delays",
    "stops",
    query="""
    SELECT feed_seq, d.stop_id, stop_name, direction, event_time
    FROM raw_delays d LEFT JOIN stops s ON s.stop_id = d.stop_id""",
)
SQL["stream_landing_root"] = f"""
    SELECT route_id, window_start, avg(arrival_delay) AS avg_delay_sec, max(arrival_delay) AS max_delay_sec,
           count(*) AS delay_records
    FROM ({SQL["stream_processed_delays"]}) GROUP BY ALL"""

SQL["snapshot_delays"] = SQL["stream_processed_delays"]
SQL["snapshot_alerts"] = using(
    "snapshot_events",
    query=f"""
    WITH shown AS (
        SELECT 'A' || user_id AS alert_id, list_sort(list_distinct([event_type, list_extract({ROUTE_IDS}, -1)])) AS route_ids,
               CASE WHEN event_id % 9 = 0 THEN '' ELSE 'H' || (user_id % 12) END AS header, '' AS description,
               CAST(user_id % 13 AS INTEGER) AS effect, {START_EPOCH} AS start_time, {END_EPOCH} AS end_time,
               's' || snapshot AS source_file, polled AS event_time, event_id AS place
        FROM snapshot_events
    )
    SELECT * EXCLUDE (place) REPLACE ({LISTED_ROUTES}, {plain_time('start_time')} AS start_time, {plain_time('end_time')} AS end_time),
           {label('effect')} AS severity, description AS description_short, {quarter('event_time')} AS window_start
    FROM ({first_row('shown', 'alert_id, source_file', 'place')})""",
)
SQL["snapshot_weather"] = f"""
    WITH hours AS (
        SELECT {MEASURES}, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS weather_timestamp, 'w' || (event_id // 24) AS source_file,
               CAST(date_trunc('second', min(ts) OVER (PARTITION BY event_id // 24)) AS TIMESTAMP) AS event_time,
               event_id // 24 % 10 = 0 AS only_current, event_id = max(event_id) OVER (PARTITION BY event_id // 24) AS is_last,
               event_id AS place
        FROM events
    ),
    shown AS (SELECT * EXCLUDE (only_current, is_last) FROM hours WHERE is_last OR NOT only_current)
    SELECT * EXCLUDE (place), {quarter('event_time')} AS window_start,
           CAST(date_trunc('hour', weather_timestamp) AS TIMESTAMP) AS obs_hour, {FLAGS}
    FROM ({first_row('shown', 'weather_timestamp, source_file', 'place')})"""
SQL["stream_event_time_windows"] = SQL["stream_landing_root"]
SQL["incremental_fact"] = SQL["fct_performance"]
SQL["incremental_weather"] = SQL["dim_weather_conditions"]
SQL["incremental_alerts"] = SQL["stg_alerts"]
SQL["stored_freshness"] = SQL["data_freshness"]
SQL["stored_not_null"] = using(
    "features", query=failures("features", "features", ["route_id", "avg_headway_gap_sec", "temperature_c"])
)
