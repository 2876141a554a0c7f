"""Roadwork reports: date rules, envelopes, collisions, plans for segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow import config as cfg
from roadflow.functions import scalars as S

# Defaults for absent report columns.
UNKNOWN_TYPE = "Unknown Type"
UNKNOWN_ID = "Unknown ID"
UNKNOWN_APPLICATION = "Unknown App ID"


def report_date(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-M-d")


def classify_disturbances(
    reports: DataFrame,
    validation_date: Column,
    as_of: Column,
    start: str = "start_text",
    end: str = "end_text",
) -> DataFrame:
    """Add both dates and ``verdict``: malformed, ended, inverted, future, current or too_old."""
    today = F.to_date(as_of)
    verdict = (
        F.when(F.col("start_date").isNull() | F.col("end_date").isNull(), "malformed")
        .when(F.col("end_date") < today, "ended")
        .when(F.col("start_date") > F.col("end_date"), "inverted")
        .when(F.col("start_date") > today, "future")
        .when(F.col("start_date") >= F.to_date(validation_date), "current")
        .otherwise("too_old")
    )
    return (
        reports.withColumn("start_date", report_date(F.col(start)))
        .withColumn("end_date", report_date(F.col(end)))
        .withColumn("verdict", verdict)
    )


def valid_disturbances(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("verdict").isin("future", "current"))


def report_rejects(classified: DataFrame) -> DataFrame:
    """Reports that the date rules turn away, with the verdict as reason."""
    return classified.filter(~F.col("verdict").isin("future", "current")).withColumn("reason", F.col("verdict"))


def validation_totals(classified: DataFrame) -> DataFrame:
    v = F.col("verdict")
    return classified.agg(
        F.count_if(~v.isin("future", "current")).alias("invalid"),
        F.count_if(v == "current").alias("valid_now"),
        F.count_if(v == "future").alias("valid_in_future"),
        F.count_if(v.isin("future", "current")).alias("kept"),
    )


def disturbance_envelope(
    hits: DataFrame,
    as_of: Column,
    segments: DataFrame | None = None,
    start: str = "start_text",
    end: str = "end_text",
) -> DataFrame:
    """Earliest start and latest end per segment.

    A bad start gives ``as_of`` for both, only a bad end for the end; so does a segment of
    ``segments`` without any report.
    """
    first, last = report_date(F.col(start)), report_date(F.col(end))
    per_segment = hits.groupBy("segment_id").agg(
        F.min(first).cast("timestamp").alias("_s"),
        F.max(last).cast("timestamp").alias("_e"),
        F.bool_or(first.isNull()).alias("_bad_s"),
        F.bool_or(first.isNull() | last.isNull()).alias("_bad_e"),
    )
    if segments is not None:
        per_segment = segments.select("segment_id").join(per_segment, "segment_id", "left")
    good = lambda c, bad: F.when(~F.coalesce(bad, F.lit(True)), F.col(c)).otherwise(as_of)
    return per_segment.select(
        "segment_id",
        good("_s", F.col("_bad_s")).alias("disturbance_start"),
        good("_e", F.col("_bad_e")).alias("disturbance_end"),
    )


def profiling_windows(
    envelopes: DataFrame,
    as_of: Column,
    weeks: int = cfg.PROFILE_WEEKS,
    lead_hours: int = cfg.PROFILE_LEAD_HOURS,
    history_weeks: int = cfg.VALIDATION_HISTORY_WEEKS,
) -> DataFrame:
    """Profile start and end and first time to validate for each segment's envelope."""
    end = S.profiling_end(F.col("disturbance_start"), as_of, lead_hours)
    return (
        envelopes.withColumn("profiling_end", end)
        .withColumn("profiling_start", S.profiling_start(F.col("profiling_end"), weeks))
        .withColumn("validation_start", S.validation_start(F.col("profiling_end"), as_of, history_weeks))
    )


def collision_properties(columns: list[str]) -> Column:
    """Report properties under their published names.

    A column that the reports do not have at all gets its default; a null value stays null, but
    for the id.
    """
    held = lambda c, d: F.col(c) if c in columns else F.lit(d).cast("string")
    return F.struct(
        held("type", UNKNOWN_TYPE).alias("traffic_disturbance_type"),
        F.coalesce(held("disturbance_id", UNKNOWN_ID), F.lit(UNKNOWN_ID)).alias("traffic_disturbance_id"),
        held("application_id", UNKNOWN_APPLICATION).alias("application_id"),
        held("start_text", None).alias("star_date"),
        held("end_text", None).alias("end_date"),
        held("address", None).alias("address"),
        held("district", None).alias("district"),
    )


def collisions(hits: DataFrame, disturbances: DataFrame) -> DataFrame:
    """Flat collisions: one row per (segment, disturbance) with the report and its polygons.

    This is the form to store: it has one shape, however many disturbances hit a segment.
    """
    columns = disturbances.columns
    return hits.join(disturbances, "disturbance_id", "left").withColumn(
        "properties", collision_properties(columns)
    )


def disturbances_by_segment(flat: DataFrame) -> DataFrame:
    """Nested form for readers of single segments: one row per segment with all of its collisions."""
    entry = F.struct("disturbance_id", "properties", "polygons")
    return flat.groupBy("segment_id").agg(
        F.any_value("coords").alias("coords"),
        F.array_sort(F.collect_list(entry)).alias("detailed_collisions"),
    )


def plan_segments(active: DataFrame, current: DataFrame) -> DataFrame:
    """What to do with each segment: deactivate, update or create; keeps ``current``'s columns."""
    marked = active.select("segment_id").distinct().withColumn("_active", F.lit(True))
    joined = marked.join(current.withColumn("_current", F.lit(True)), "segment_id", "full_outer")
    action = (
        F.when(F.col("_current").isNull(), "deactivate")
        .when(F.col("_active").isNull(), "create")
        .otherwise("update")
    )
    return joined.withColumn("action", action).drop("_active", "_current")


def refresh_plan(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed start day: profile again; only the end day changed: keep the profile."""
    before = old.select(
        "segment_id",
        F.to_date("disturbance_start").alias("_old_start"),
        F.to_date("disturbance_end").alias("_old_end"),
    )
    start, end = F.to_date("disturbance_start"), F.to_date("disturbance_end")
    action = (
        F.when(start != F.col("_old_start"), "reprofile")
        .when(end != F.col("_old_end"), "extend")
        .otherwise("keep")
    )
    return new.join(before, "segment_id").withColumn("action", action).drop("_old_start", "_old_end")
