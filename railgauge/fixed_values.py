"""Constants that results depend on and that must not drift."""

# The two routes watched by default. Every reader takes its own set.
DEFAULT_ROUTES = ("J", "Z")

# GTFS-realtime alert effect codes and their labels.
EFFECT_LABELS = {
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
UNKNOWN_EFFECT = "unknown_effect"

# GTFS-realtime defaults a reader sees for fields left off the wire.
WIRE_DEFAULT_EFFECT = 8
WIRE_DEFAULT_STOP_STATUS = 2

# Inclusive upper bounds, in seconds.
DELAY_BOUNDS = ((60, "on_time"), (300, "minor"), (600, "moderate"))
DELAY_OVER = "severe"
HEADWAY_BOUNDS = ((300, "bunched"), (600, "normal"))
HEADWAY_OVER = "sparse"
HEADWAY_UNKNOWN = "unknown"
GAP_CAP_SECONDS = 1800

# Weather thresholds (degrees C, mm, cm, percent, km/h).
EXTREME_HEAT_C = 32.2
HOT_C = 27
FREEZING_C = 0
HEAVY_RAIN_MM = 5
HUMID_PCT = 60
STRONG_WIND_KMH = 60
MODERATE_WIND_KMH = 30

# Grain of the fact, and text widths.
WINDOW_MINUTES = 15
DESCRIPTION_CHARS = 200
TITLE_CHARS = 80
