"""Series access: slices, downsampling, pivot, first/last/latest, dense grid, eligibility."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow import config as cfg
from roadflow.functions import scalars as S


def series_slice(
    obs: DataFrame,
    segments: list[str] | DataFrame | None = None,
    start: datetime | None = None,
    stop: datetime | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """Rows in ``[start, stop)`` of the chosen segments and fields; empty when start >= stop.

    With a ``date`` partition column the days are pruned as well.
    """
    out = obs
    if start is not None and stop is not None and start >= stop:
        out = out.filter(F.lit(False))
    if start is not None:
        out = out.filter(F.col("time") >= F.lit(start))
    if stop is not None:
        out = out.filter(F.col("time") < F.lit(stop))
    if "date" in obs.columns:
        if start is not None:
            out = out.filter(F.col("date") >= F.lit(start.date()))
        if stop is not None:
            out = out.filter(F.col("date") <= F.lit(stop.date()))
    out = target_segments(out, segments)
    return out.select("segment_id", "time", *fields) if fields else out


def target_segments(rows: DataFrame, segments: list[str] | DataFrame | None) -> DataFrame:
    """Optional allow-list: a short Python list becomes a predicate, a table a semi join."""
    if segments is None or (isinstance(segments, list) and not segments):
        return rows
    if isinstance(segments, list):
        return rows.filter(F.col("segment_id").isin(segments))
    return rows.join(segments.select("segment_id"), "segment_id", "left_semi")


def downsample_last(
    obs: DataFrame,
    fields: list[str],
    minutes: int = cfg.SAMPLE_MINUTES,
    label: str = "start",
    tie: str | None = None,
) -> DataFrame:
    """Last non-null value of every field in each window; empty windows are left out.

    Each field is taken on its own, so a row may mix times. ``tie`` names a column that decides
    between equal times. Partial aggregation leaves at most one row per window and map task.
    """
    order = F.struct("time", tie) if tie else F.col("time")
    slot = S.slot_start(F.col("time"), minutes)
    if label == "end":
        slot = slot + F.make_interval(mins=F.lit(minutes))
    last = [
        F.max_by(f, F.when(F.col(f).isNotNull(), order)).alias(f)
        for f in fields
    ]
    any_value = F.coalesce(*[F.col(f).cast("string") for f in fields]).isNotNull()
    return (
        obs.filter(any_value)
        .groupBy("segment_id", slot.alias("_slot"))
        .agg(*last)
        .withColumnRenamed("_slot", "time")
    )


def fields_to_columns(points: DataFrame, fields: list[str]) -> DataFrame:
    """Long ``segment_id, time, field, value`` to one column per field (declared, so one pass)."""
    return points.groupBy("segment_id", "time").pivot("field", fields).agg(F.max("value"))


def columns_to_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Wide to long; null fields give no point."""
    return (
        rows.select("segment_id", "time", *[F.col(f).cast("double") for f in fields])
        .unpivot(["segment_id", "time"], fields, "field", "value")
        .filter(F.col("value").isNotNull())
    )


def first_last_seen(obs: DataFrame, as_of: Column | None = None, days: int | None = None) -> DataFrame:
    """Earliest and latest time per segment; ``days`` bounds the latest to a look-back window."""
    latest = F.max("time")
    if days is not None:
        latest = F.max(F.when(F.col("time") >= as_of - F.make_interval(days=F.lit(days)), F.col("time")))
    return obs.groupBy("segment_id").agg(
        F.min("time").alias("first_time"), latest.alias("last_time")
    )


def first_last_overall(
    obs: DataFrame, as_of: Column | None = None, days: int | None = None
) -> DataFrame:
    """Earliest and latest time of a table; with ``days`` only the look-back window is read."""
    rows = obs
    if days is not None:
        rows = rows.filter(F.col("time") >= as_of - F.make_interval(days=F.lit(days)))
    return rows.agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"))


def concat_parts(parts: list[DataFrame]) -> DataFrame:
    """Chunks of one series or frame put together by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def latest_point(
    obs: DataFrame,
    fields: list[str],
    as_of: Column | None = None,
    days: int | None = None,
    tie: str | None = None,
    per_segment: bool = True,
) -> DataFrame:
    """Newest row, per segment or overall."""
    rows = obs
    if days is not None:
        rows = rows.filter(F.col("time") >= as_of - F.make_interval(days=F.lit(days)))
    order = F.struct("time", tie) if tie else F.col("time")
    if per_segment:
        best = F.max_by(F.struct("time", *fields), order)
        return rows.groupBy("segment_id").agg(best.alias("_p")).select("segment_id", "_p.*")
    best = F.max_by(F.struct("segment_id", "time", *fields), order)
    return rows.agg(best.alias("_p")).filter(F.col("_p").isNotNull()).select("_p.*")


def count_points(obs: DataFrame, measurement: str) -> DataFrame:
    return obs.groupBy("segment_id").agg(F.count("*").alias("points")).withColumn(
        "measurement", F.lit(measurement)
    )


def dense_grid(
    series: DataFrame,
    start: Column,
    end: Column,
    fields: list[str],
    minutes: int = cfg.SAMPLE_MINUTES,
    closed: bool = True,
) -> DataFrame:
    """One row per segment and window from start to end, missing values null.

    Grid rows are added to the series and collapse with it in one aggregation, so there is a
    single shuffle and no join. ``closed`` keeps the end point. The series must hold one row
    per (segment, window); rows off the grid have no place in it.
    """
    step = F.make_interval(mins=F.lit(minutes))
    stop = end if closed else end - step
    off_grid = (F.unix_micros(F.col("time")) - F.unix_micros(start)) % (minutes * 60_000_000)
    inside = (F.col("time") >= start) & (F.col("time") <= stop) & (off_grid == 0)
    values = series.filter(inside).select("segment_id", "time", *fields)
    grid = (
        series.select("segment_id")
        .distinct()
        .select("segment_id", F.explode(F.sequence(start, stop, step)).alias("time"))
    )
    rows = values.unionByName(grid, allowMissingColumns=True)
    return rows.groupBy("segment_id", "time").agg(
        *[F.max(f).alias(f) for f in fields], F.count("*").alias("_n")
    ).drop("_n")


def eligible_segments(seen: DataFrame, as_of: Column, weeks: int = cfg.PROFILE_WEEKS) -> DataFrame:
    """Segments with enough history: first time + weeks <= as_of."""
    return seen.filter(F.col("first_time") + F.make_interval(weeks=F.lit(weeks)) <= as_of)


def due_for_validation(windows: DataFrame, as_of: Column) -> DataFrame:
    return windows.filter(F.to_date("profiling_end") <= F.to_date(as_of))


def period_violations(
    obs: DataFrame, start: datetime | None, end: datetime | None, weeks: int = cfg.PROFILE_WEEKS
) -> DataFrame:
    """Broken rules of a profile period: both ends or none, exact length, data inside it."""
    if start is None and end is None:
        return obs.agg(F.min("time").alias("first_time"), F.max("time").alias("last_time")).filter(
            F.lit(False)
        ).withColumn("rule", F.lit(""))
    if start is None or end is None:
        raise ValueError("start and end must be given together")
    s, e = F.lit(start), F.lit(end)
    rules = F.array(
        F.when(s + F.make_interval(weeks=F.lit(weeks)) != e, "wrong_length"),
        F.when(F.col("first_time") < s, "data_before_start"),
        F.when(F.col("last_time") > e, "data_after_end"),
    )
    return first_last_overall(obs).withColumn("rule", F.explode(F.array_compact(rules)))


def day_chunks(ranges: DataFrame, days: int = 1) -> DataFrame:
    """Half-open chunks ``[chunk_start, chunk_end)`` of each ``start, end`` range (end exclusive)."""
    step = F.make_interval(days=F.lit(days))
    starts = F.explode(F.sequence(F.col("start"), F.col("end"), step))
    return (
        ranges.withColumn("chunk_start", starts)
        .filter(F.col("chunk_start") < F.col("end"))
        .withColumn("chunk_end", F.least(F.col("chunk_start") + step, F.col("end")))
    )
