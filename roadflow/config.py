"""Default parameters. Every operator takes them as arguments; nothing is read from the clock."""

# --- Fixed values: they must equal the published method for equal results. ---

# Profile
PROFILE_WEEKS = 4
FULL_PROFILE_WEEKS = 26
FULL_PROFILE_MIN_WEEKS = 10
PROFILE_LEAD_HOURS = 48
PROFILE_LIFETIME_DAYS = 7
SAMPLE_MINUTES = 5
SAMPLES_PER_HOUR = 60 // SAMPLE_MINUTES
VALIDATION_HISTORY_WEEKS = 4
DEAD_HOURS_IN_A_ROW = 5
DEAD_HOUR_RUN = 60
MISSING_RUN_Q95 = 60.0
MISSING_MEAN_MEDIAN = 0.0
USABLE_RUN_Q95 = 35.0
MIN_USABLE_BUCKETS = 30

# Closure status
MAX_PROFILE = 54.0
COVERAGE_DROP = 8.0
COVERAGE_HIGH = 6.0
MIN_PROFILE = 5.0
ZEROS_OR_ONES_BELOW = 3.0
CLOSED_ABOVE = 0.75
OPEN_BELOW = 0.15
DECAY = 0.5
K_START = 0.025
K_MAX = 10.0
INITIAL_MEAN = 0.5
NULL_PROFILE = 60.0
DROP_WEIGHT = 10.0

# Geometry (metres; plane EPSG:3879)
DISTURBANCE_BUFFER = 20.0
REPLACEMENT_BUFFER = 5.0
REPLACEMENT_THRESHOLD = 0.7
SCORE_TOLERANCE = 1e-9
DISTURBANCE_CELL = 250.0
REPLACEMENT_CELL = 100.0

# Tables
HISTORY_START = "2025-01-01"
CHANGELOG_VERSIONS = 50
SERIES_BUCKETS = 16
PROFILE_BUCKETS = 16
HEALTHY_MINUTES = 90
DEGRADED_MINUTES = 180
COLLISIONS_MAX_AGE_MINUTES = 120
LAYER_CACHE_HOURS = 24
# Names of the report layers.
DISTURBANCE_LAYERS = ["Kaivuilmoitus_alue", "Aluevuokraus_alue"]

# Gap classes of the replacement analysis: name, upper limit in seconds (inclusive).
GAP_CLASSES = [
    ("same cycle (<=1m)", 60),
    ("<1h", 3600),
    ("1-6h", 6 * 3600),
    ("6-24h", 24 * 3600),
    ("1-7d", 7 * 86400),
    (">7d", None),
]


def min_weeks_for(profile_weeks: int) -> int:
    """Weeks a bucket needs: the 10-of-26 rule scaled to the profile length, at least one."""
    return max(1, int(FULL_PROFILE_MIN_WEEKS / FULL_PROFILE_WEEKS * profile_weeks))
