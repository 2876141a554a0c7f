"""Data quality: freshness, integrity, row counts, comparison of data sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow import config as cfg
from roadflow.functions import scalars as S
from roadflow.sources import tables


def series_freshness(
    series: DataFrame,
    as_of: Column,
    fresh_minutes: float,
    lookback_days: int = 7,
    keys: list[str] | None = None,
) -> DataFrame:
    """Mode of each key (or of the whole table): real_time, backfill or no_data, with its age."""
    last = series.groupBy(*(keys or [])).agg(
        F.max(F.when(F.col("time") <= as_of, F.col("time"))).alias("last_time")
    )
    age = S.minutes_between(as_of, F.col("last_time"))
    mode = (
        F.when(age <= fresh_minutes, "real_time")
        .when(age <= lookback_days * 1440, "backfill")
        .otherwise("no_data")
    )
    known = F.col("mode") != "no_data"
    return (
        last.withColumn("mode", mode)
        .withColumn("age_minutes", F.when(known, age))
        .withColumn("last_time", F.when(known, F.col("last_time")))
    )


def map_integrity(segment_map: DataFrame, changelog: DataFrame | None = None) -> DataFrame:
    """Size of the map, entries without a geometry, history entries and the verdict."""
    empty = F.col("coords").isNull() | (F.size("coords") == 0)
    out = segment_map.agg(
        F.count("*").alias("segments"), F.count_if(empty).alias("without_geometry")
    )
    verdict = (
        F.when(F.col("segments") == 0, "empty")
        .when(F.col("without_geometry") > 0, "missing_geometry")
        .otherwise("ok")
    )
    out = out.withColumn("verdict", verdict)
    if changelog is None:
        return out
    return out.withColumn("history_entries", changelog.agg(F.count("*")).scalar())


def collisions_quality(
    collisions: DataFrame | None,
    written_at: Column,
    as_of: Column,
    max_age_minutes: int = cfg.COLLISIONS_MAX_AGE_MINUTES,
) -> DataFrame:
    """Segments with collisions and the verdict: missing (no table), empty, stale or ok."""
    if collisions is None:
        one = SparkSession.active().range(1)
        return one.select(
            F.lit(0).cast("bigint").alias("segments"),
            F.lit("missing").alias("verdict"),
            F.lit(None).cast("double").alias("age_minutes"),
        )
    age = S.minutes_between(as_of, written_at)
    verdict = (
        F.when(F.col("segments") == 0, "empty").when(age > max_age_minutes, "stale").otherwise("ok")
    )
    return (
        collisions.agg(F.count_distinct("segment_id").alias("segments"))
        .withColumn("verdict", verdict)
        .withColumn("age_minutes", age)
    )


def min_rows(tables: dict[str, DataFrame], minimums: dict[str, int]) -> DataFrame:
    """Row count of each table against its minimum."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"),
            "rows",
            F.lit(minimums.get(name, 0)).cast("bigint").alias("minimum"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("enough", F.col("rows") >= F.col("minimum"))


def validation_recent(validation: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Whether any validation row lies in the last ``hours``; with a date partition it is pruned."""
    recent = validation.filter(F.col("time") >= as_of - F.make_interval(hours=F.lit(hours)))
    return recent.agg(F.count("*").alias("recent_rows")).withColumn(
        "recent", F.col("recent_rows") > 0
    )


def rejects(parts: dict[str, DataFrame], key: str = "row_key") -> DataFrame:
    """All dropped rows of several stages as ``stage, row_key, reason``."""
    frames = [
        df.select(F.lit(stage).alias("stage"), F.col(key).cast("string").alias("row_key"), "reason")
        for stage, df in parts.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _canonical(points: DataFrame, keys: list[str]) -> DataFrame:
    rounded = [
        F.round(f.name, 3).alias(f.name)
        if f.dataType.typeName() in ("double", "float") and f.name not in keys
        else F.col(f.name)
        for f in points.schema.fields
    ]
    return points.select(*rounded)


def _both_sides(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Every distinct row of either side with ``_a`` and ``_b``, how often each side has it: one pass."""
    left = _canonical(a, keys).withColumns({"_a": F.lit(1), "_b": F.lit(0)})
    right = _canonical(b, keys).withColumns({"_a": F.lit(0), "_b": F.lit(1)})
    both = left.unionByName(right.select(*left.columns))
    columns = [c for c in left.columns if c not in ("_a", "_b")]
    return both.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))


def same_rows(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Order-free comparison, reals rounded to 3: rows only in one side, with the side."""
    one = (F.col("_a") == 0) | (F.col("_b") == 0)
    side = F.when(F.col("_b") == 0, "a").otherwise("b")
    return _both_sides(a, b, keys).filter(one).withColumn("only_in", side).drop("_a", "_b")


def unequal_parts(a: DataFrame, b: DataFrame) -> list[tuple]:
    """(date, bucket) of parts whose digests differ, or that one side lacks; at most days times buckets."""
    both = a.join(b.toDF("date", "bucket", "_rows", "_digest"), ["date", "bucket"], "full_outer")
    differ = ~(F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest")))
    return [(r.date, r.bucket) for r in both.filter(differ).select("date", "bucket").collect()]


def same_rows_of_tables(spark: SparkSession, path_a: str, path_b: str) -> DataFrame:
    """``same_rows`` of two series tables; only the parts whose digests differ are read and compared."""
    parts = unequal_parts(tables.series_digests(spark, path_a), tables.series_digests(spark, path_b))
    a, b = (tables.in_parts(spark.read.parquet(p), parts).drop("date", "bucket") for p in (path_a, path_b))
    return same_rows(a, b, ["segment_id", "time"])


def freshness_of_table(
    spark: SparkSession, path: str, segments: DataFrame, as_of: Column, fresh_minutes: float, lookback_days: int = 7
) -> DataFrame:
    """``series_freshness`` of each of ``segments`` from a series table, read from its newest day backwards.

    A segment whose last row is older than the look-back is ``no_data``, like one without rows, so
    no day before it is read.
    """
    newest = tables.newest_rows(spark, path, segments, as_of, lookback_days + 1)
    rows = segments.select("segment_id").distinct().join(newest.select("segment_id", "time"), "segment_id", "left")
    out = series_freshness(rows, as_of, fresh_minutes, lookback_days, ["segment_id"])
    return out.withColumn("mode", F.coalesce("mode", F.lit("no_data")))


def compare_counts(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows of both sides, distinct rows only in either, and whether the sides are equal."""
    counts = _both_sides(a, b, keys).agg(
        F.coalesce(F.sum("_a"), F.lit(0)).alias("rows_a"),
        F.coalesce(F.sum("_b"), F.lit(0)).alias("rows_b"),
        F.count_if(F.col("_b") == 0).alias("only_a"),
        F.count_if(F.col("_a") == 0).alias("only_b"),
    )
    return counts.withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))
