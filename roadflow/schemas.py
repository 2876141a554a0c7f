"""Declared schemas (DDL) of all inputs and tables."""

COORDS = "array<struct<lon:double,lat:double>>"
RINGS = "array<array<array<struct<lon:double,lat:double>>>>"

# One landed snapshot document. Times come from the file name.
SNAPSHOT = """
    detailedSegments array<struct<
        segmentIdStr: string,
        segmentId: string,
        currentSpeed: double,
        averageSpeed: double,
        typicalSpeed: double,
        confidence: double,
        shape: array<struct<longitude: double, latitude: double>>>>
"""

FCD_OBS = f"""
    segment_id string, time timestamp, fcd_coverage int, average_speed double,
    typical_speed double, current_speed double, confidence_level int,
    coords {COORDS}, source_file string, position int
"""

OBS_FIELDS = [
    "fcd_coverage",
    "average_speed",
    "typical_speed",
    "current_speed",
    "confidence_level",
]

# One landed GeoJSON layer document; geometry stays text until its type is known.
FEATURE_COLLECTION = """
    features array<struct<
        type: string,
        id: string,
        properties: map<string,string>,
        geometry: struct<type: string, coordinates: string>>>
"""

DISTURBANCE = f"""
    disturbance_id string, type string, application_id string, start_text string,
    end_text string, address string, district string, polygons {RINGS}, layer string
"""

CHANGELOG = f"""
    segment_id string, coords {COORDS}, current_hash string, date_added timestamp,
    history array<struct<date_archived: timestamp, coords: {COORDS}>>,
    geo_inherited_from string, timeseries_migrated_at timestamp
"""

ARCHIVE = CHANGELOG + ", date_archived timestamp"

PROFILE = """
    segment_id string, day_of_week string, hour_of_day int, fcd_mean_median double,
    max_consecutive_zeros_q95 double, max_consecutive_zeros_or_ones_q95 double,
    number_of_hours bigint
"""

VALIDATION = """
    segment_id string, time timestamp, fcd int, consecutive_zeros int, consecutive_low int,
    day_of_week string, hour_of_day int, fcd_mean_median double,
    max_consecutive_zeros_q95 double, max_consecutive_zeros_or_ones_q95 double,
    running_mean double, segment_closure_status string
"""

RENAME_REPORT = """
    measurement string, old_id string, new_id string, original_count bigint,
    retagged_count bigint, deleted boolean
"""

VALIDATION_STATE = """
    segment_id string, time timestamp, consecutive_zeros int, consecutive_low int,
    max_consecutive_zeros_q95 double, max_consecutive_zeros_or_ones_q95 double,
    running_mean double, batch_id bigint
"""
