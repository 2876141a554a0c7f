"""Scalar column functions: coverage, names and times, calendar, hashes, time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow import config as cfg

# Fixed value: time stamp inside a file name; ``:`` may be written ``-`` on local disks.
FILE_TIME = r"(\d{4}-\d{2}-\d{2})T(\d{2})[:\-](\d{2})[:\-](\d{2})(\.\d{1,6})?"


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once per row, however often they are used later.

    The optimizer merges projections and copies a filter's expressions below them, which
    repeats costly ones (JSON parsing, geometry). A generator of one row is a border it keeps.
    """
    made = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    kept = [F.col(c) for c in df.columns if c not in columns]
    out = df.select("*", F.explode_outer(F.array(made)).alias("_made"))
    return out.select(*kept, *[F.col(f"_made.{name}").alias(name) for name in columns])


def confidence_to_fcd(confidence: Column) -> Column:
    """Confidence 0..100 to coverage 0..10: up to 70 is 0, the rest linear, ties to even."""
    scaled = F.bround((confidence.cast("double") - 70) / 30 * 10)
    return (
        F.when(confidence <= 70, F.lit(0))
        .when(confidence.isNotNull(), F.least(F.lit(10), scaled.cast("int")))
        .cast("int")
    )


def time_from_file_name(name: Column, keep_fraction: bool = False) -> Column:
    """The UTC time stamped into a file name, or null when absent or not a real date."""
    part = lambda i: F.regexp_extract(name, FILE_TIME, i)
    text = F.concat(part(1), F.lit(" "), F.concat_ws(":", part(2), part(3), part(4)))
    if keep_fraction:
        text = F.concat(text, part(5))
    return F.when(part(1) != "", text.try_cast("timestamp"))


def iso_to_timestamp(text: Column) -> Column:
    """ISO text with ``Z``, offset or no zone (then UTC by session zone); null if malformed."""
    return text.try_cast("timestamp")


def as_id(col: Column) -> Column:
    """Ids stay strings: 19-digit numbers do not fit a double."""
    return col.cast("string")


def zero_fill(fcd: Column) -> Column:
    return F.coalesce(fcd, F.lit(0)).cast("smallint")


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def floor_hour(time: Column) -> Column:
    return F.date_trunc("hour", time)


def day_name(time: Column) -> Column:
    return F.date_format(time, "EEEE")


def day_index(time: Column) -> Column:
    """0 is Monday."""
    return F.weekday(time)


def hour_of_day(time: Column) -> Column:
    return F.hour(time)


def slot_start(time: Column, minutes: int = cfg.SAMPLE_MINUTES) -> Column:
    """Start of the epoch-aligned ``minutes`` window a time falls into."""
    size = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_micros(time) / (size * 1000000)) * size)


def coords_text(coords: Column) -> Column:
    """Canonical text of a line: ``lon lat`` with seven decimals, points joined by commas."""
    point = lambda p: F.format_string("%.7f %.7f", p["lon"], p["lat"])
    return F.array_join(F.transform(coords, point), ",")


def geometry_hash(coords: Column) -> Column:
    return F.sha2(coords_text(coords), 256)


def bbox(coords: Column) -> Column:
    """Bounding box of a point list as a struct; null for no points."""
    xs = F.transform(coords, lambda p: p["lon"])
    ys = F.transform(coords, lambda p: p["lat"])
    return F.when(
        F.size(coords) > 0,
        F.struct(
            F.array_min(xs).alias("min_x"),
            F.array_max(xs).alias("max_x"),
            F.array_min(ys).alias("min_y"),
            F.array_max(ys).alias("max_y"),
        ),
    )


def geojson_points(kind: Column, coordinates: Column) -> Column:
    """All points of a GeoJSON geometry (coordinates as text), whatever its nesting."""
    one, line = "array<double>", "array<array<double>>"
    pairs = (
        F.when(kind == "Point", F.array(F.from_json(coordinates, one)))
        .when(kind == "LineString", F.from_json(coordinates, line))
        .when(
            kind.isin("MultiLineString", "Polygon"),
            F.flatten(F.from_json(coordinates, f"array<{line}>")),
        )
        .when(
            kind == "MultiPolygon",
            F.flatten(F.flatten(F.from_json(coordinates, f"array<array<{line}>>"))),
        )
    )
    return F.transform(pairs, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))


def profiling_end(start: Column, as_of: Column, lead_hours: int = cfg.PROFILE_LEAD_HOURS) -> Column:
    """Lead time before the disturbance if it began before today, else today 00:00."""
    lead = F.make_interval(hours=F.lit(lead_hours))
    today = F.date_trunc("day", as_of)
    return F.when(start - lead < today - lead, start - lead).otherwise(today)


def profiling_start(end: Column, weeks: int = cfg.PROFILE_WEEKS) -> Column:
    return end - F.make_interval(weeks=F.lit(weeks))


def validation_start(
    profile_end: Column,
    as_of: Column,
    weeks: int = cfg.VALIDATION_HISTORY_WEEKS,
    step_minutes: int = cfg.SAMPLE_MINUTES,
) -> Column:
    """First time to validate: after the profile, not further back than ``weeks``."""
    one_step = as_of - F.make_interval(mins=F.lit(step_minutes))
    if weeks == 0:
        return one_step
    after_profile = F.greatest(
        profile_end + F.make_interval(days=F.lit(1)), as_of - F.make_interval(weeks=F.lit(weeks))
    )
    return F.when(F.to_date(profile_end) < F.to_date(as_of), after_profile).otherwise(one_step)


def closure_status(mean: Column) -> Column:
    return (
        F.when(mean < cfg.OPEN_BELOW, "open")
        .when(mean > cfg.CLOSED_ABOVE, "closed")
        .otherwise("undetermined")
    )


def age_grade(minutes: Column) -> Column:
    return (
        F.when(minutes < cfg.HEALTHY_MINUTES, "healthy")
        .when(minutes < cfg.DEGRADED_MINUTES, "degraded")
        .otherwise("unhealthy")
    )


def minutes_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60e6)


def gap_class(seconds: Column) -> Column:
    """Class of a replacement gap; negative gaps count as zero."""
    expr = None
    for name, upper in cfg.GAP_CLASSES[:-1]:
        hit = seconds <= upper
        expr = F.when(hit, name) if expr is None else expr.when(hit, name)
    return expr.otherwise(cfg.GAP_CLASSES[-1][0])
