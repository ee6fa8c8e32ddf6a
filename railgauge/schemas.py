"""Table contracts, as Spark DDL strings usable with ``spark.read.schema``."""

FEED = """
    source_file string,
    header struct<timestamp: bigint>,
    entity array<struct<
        id: string,
        trip_update: struct<
            trip: struct<trip_id: string, route_id: string>,
            stop_time_update: array<struct<
                stop_id: string,
                arrival: struct<delay: int>,
                departure: struct<delay: int>>>>,
        vehicle: struct<
            trip: struct<trip_id: string, route_id: string>,
            stop_id: string,
            current_stop_sequence: int,
            current_status: int,
            occupancy_status: int,
            `timestamp`: bigint>,
        alert: struct<
            informed_entity: array<struct<route_id: string>>,
            header_text: struct<translation: array<struct<text: string>>>,
            description_text: struct<translation: array<struct<text: string>>>,
            effect: int,
            active_period: array<struct<`start`: bigint, `end`: bigint>>>>>
"""

WEATHER_RESPONSE = """
    latitude double,
    longitude double,
    elevation double,
    generationtime_ms double,
    utc_offset_seconds int,
    timezone string,
    timezone_abbreviation string,
    hourly struct<
        time: array<string>,
        temperature_2m: array<double>,
        relative_humidity_2m: array<double>,
        precipitation: array<double>,
        snowfall: array<double>,
        wind_speed_10m: array<double>>,
    current struct<
        time: string,
        `interval`: int,
        temperature_2m: double,
        relative_humidity_2m: double,
        precipitation: double,
        snowfall: double,
        wind_speed_10m: double>
"""

STOPS = "stop_id string, stop_name string, line string, direction string"

RAW_DELAYS = """
    vehicle_id string, trip_id string, route_id string, stop_id string,
    arrival_delay int, departure_delay int,
    source_file string, event_time timestamp, feed_seq bigint
"""

RAW_ALERTS = """
    alert_id string, route_ids array<string>, header string, description string, effect int,
    start_time bigint, end_time bigint,
    source_file string, event_time timestamp, feed_seq bigint
"""

RAW_POSITIONS = """
    vehicle_id string, trip_id string, route_id string, stop_id string,
    current_stop_sequence int, current_status int, occupancy_status int, mta_timestamp bigint,
    source_file string, event_time timestamp, feed_seq bigint
"""

RAW_WEATHER = """
    temperature_c double, humidity_pct double, precip_mm double, snowfall_cm double,
    wind_speed_kmh double, weather_timestamp string,
    source_file string, event_time timestamp, feed_seq bigint
"""

DELAYS = """
    vehicle_id string, trip_id string, route_id string, stop_id string,
    arrival_delay int, departure_delay int,
    source_file string, event_time timestamp, delay_severity string, window_start timestamp
"""

ALERTS = """
    alert_id string, route_ids array<string>, header string, description string, effect int,
    start_time timestamp, end_time timestamp, source_file string, event_time timestamp,
    severity string, description_short string, window_start timestamp
"""

POSITIONS = """
    vehicle_id string, trip_id string, route_id string, stop_id string,
    current_stop_sequence int, current_status int, occupancy_status int, mta_timestamp timestamp,
    source_file string, event_time timestamp,
    headway_gap_sec double, headway_status string, window_start timestamp
"""

WEATHER = """
    temperature_c double, humidity_pct double, precip_mm double, snowfall_cm double,
    wind_speed_kmh double, weather_timestamp timestamp_ntz, source_file string,
    event_time timestamp, window_start timestamp, obs_hour timestamp,
    is_extreme_heat boolean, is_precip boolean, is_snow boolean
"""
