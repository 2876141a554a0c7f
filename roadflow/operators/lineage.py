"""Segment lineage: differences, inheritance, retention, renaming of series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadflow import config as cfg
from roadflow.functions import scalars as S
from roadflow.operators import spatial

LOG_COLUMNS = [
    "segment_id",
    "coords",
    "current_hash",
    "date_added",
    "history",
    "geo_inherited_from",
    "timeseries_migrated_at",
]


def _version(archived_at: Column, coords: Column) -> Column:
    return F.array(F.struct(archived_at.alias("date_archived"), coords.alias("coords")))


def diff_segments(fresh: DataFrame, changelog: DataFrame, as_of: Column) -> DataFrame:
    """The fresh map against the log: every id with ``change`` and its next log record.

    ``fresh`` holds ``segment_id, coords``. Added ids start an empty history, modified ones
    append their old line, removed ones keep their record and get ``date_archived``.
    """
    now = fresh.filter(F.col("coords").isNotNull()).select(
        "segment_id",
        F.col("coords").alias("_coords"),
        S.geometry_hash(F.col("coords")).alias("_hash"),
    )
    change = (
        F.when(F.col("_hash").isNull(), "removed")
        .when(F.col("current_hash").isNull(), "added")
        .when(F.col("current_hash") != F.col("_hash"), "modified")
        .otherwise("unchanged")
    )
    kept_history = F.coalesce(F.col("history"), F.array())
    history = F.when(
        F.col("change") == "modified", F.concat(kept_history, _version(as_of, F.col("coords")))
    ).otherwise(kept_history)
    gone = F.col("change") == "removed"
    take_new = F.col("change").isin("added", "modified")
    return (
        now.join(changelog.select(*LOG_COLUMNS), "segment_id", "full_outer")
        .withColumn("change", change)
        .withColumn("history", history)
        .withColumn("coords", F.when(take_new, F.col("_coords")).otherwise(F.col("coords")))
        .withColumn("current_hash", F.when(take_new, F.col("_hash")).otherwise(F.col("current_hash")))
        .withColumn("date_added", F.when(F.col("change") == "added", as_of).otherwise(F.col("date_added")))
        .withColumn("date_archived", F.when(gone, as_of))
        .select(*LOG_COLUMNS, "change", "date_archived")
    )


def next_changelog(diff: DataFrame) -> DataFrame:
    return diff.filter(F.col("change") != "removed").select(*LOG_COLUMNS)


def next_archive(diff: DataFrame, archive: DataFrame) -> DataFrame:
    """Removed records join the archive; an id archived again replaces its old archive row."""
    removed = diff.filter(F.col("change") == "removed").select(*LOG_COLUMNS, "date_archived")
    kept = archive.join(removed.select("segment_id"), "segment_id", "left_anti")
    return kept.select(*LOG_COLUMNS, "date_archived").unionByName(removed)


def removed_ids(diff: DataFrame) -> DataFrame:
    return diff.filter(F.col("change") == "removed").select("segment_id")


def added_ids(diff: DataFrame) -> DataFrame:
    return diff.filter(F.col("change") == "added").select("segment_id")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ids of ``left`` that are not in ``right``."""
    return left.select("segment_id").distinct().join(
        right.select("segment_id"), "segment_id", "left_anti"
    )


def replacement_candidates(
    archive: DataFrame,
    changelog: DataFrame,
    removed_now: DataFrame,
    as_of: Column,
    lookback_hours: float | None,
) -> DataFrame:
    """Archived records a new segment may inherit from.

    Removals of this cycle always; with a look-back also records archived within it, unless
    somebody inherited from them already.
    """
    same_cycle = archive.join(removed_now.select("segment_id"), "segment_id", "left_semi")
    if lookback_hours is None:
        return same_cycle
    cutoff = as_of - F.make_interval(secs=F.lit(lookback_hours * 3600))
    used = (
        changelog.filter(F.col("geo_inherited_from").isNotNull())
        .select(F.col("geo_inherited_from").alias("segment_id"))
        .distinct()
    )
    earlier = (
        archive.filter(F.col("date_archived") >= cutoff)
        .join(removed_now.select("segment_id"), "segment_id", "left_anti")
        .join(used, "segment_id", "left_anti")
    )
    return same_cycle.unionByName(earlier)


def inherit_history(changelog: DataFrame, archive: DataFrame, matches: DataFrame) -> DataFrame:
    """Matched new segments: old history, old line, own history; source id remembered."""
    old = archive.select(
        F.col("segment_id").alias("old_id"),
        F.concat(
            F.coalesce("history", F.array()), _version(F.col("date_archived"), F.col("coords"))
        ).alias("_inherited"),
    )
    heirs = matches.select(F.col("new_id").alias("segment_id"), "old_id").join(old, "old_id")
    joined = changelog.join(heirs, "segment_id", "left")
    inherited = F.col("_inherited").isNotNull()
    return joined.withColumn(
        "history", F.when(inherited, F.concat("_inherited", "history")).otherwise(F.col("history"))
    ).withColumn("geo_inherited_from", F.coalesce("old_id", "geo_inherited_from")).select(*LOG_COLUMNS)


def pending_migrations(changelog: DataFrame) -> DataFrame:
    """Inherited but not yet migrated: ``old_id, new_id``."""
    return changelog.filter(
        F.col("geo_inherited_from").isNotNull() & F.col("timeseries_migrated_at").isNull()
    ).select(F.col("geo_inherited_from").alias("old_id"), F.col("segment_id").alias("new_id"))


def keep_newest_versions(
    versions: DataFrame, keep: int = cfg.CHANGELOG_VERSIONS, tie: str | None = None
) -> DataFrame:
    """At most ``keep`` versions per segment; every map task drops the rest before the shuffle."""
    order = [F.col("recorded_at").desc()] + ([F.col(tie).desc()] if tie else [])
    rank = F.row_number().over(W.partitionBy("segment_id").orderBy(*order))
    return versions.withColumn("_rank", rank).filter(F.col("_rank") <= keep).drop("_rank")


def changelog_view(versions: DataFrame, tie: str | None = None) -> DataFrame:
    """Newest version as the current one, the others (newest first) as history.

    Takes versions cut by ``keep_newest_versions``, whose ``keep`` is the only limit.
    """
    order = F.struct("recorded_at", tie) if tie else F.struct("recorded_at")
    every = F.reverse(F.array_sort(F.collect_list(F.struct(order.alias("at"), "coords", "geometry_hash"))))
    return (
        versions.groupBy("segment_id")
        .agg(every.alias("_all"))
        .select(
            "segment_id",
            F.col("_all")[0]["coords"].alias("coords"),
            F.col("_all")[0]["geometry_hash"].alias("current_hash"),
            F.col("_all")[0]["at"]["recorded_at"].alias("date_added"),
            F.transform(
                F.slice("_all", 2, F.size("_all")),
                lambda v: F.struct(
                    v["at"]["recorded_at"].alias("recorded_at"),
                    v["coords"].alias("coords"),
                    v["geometry_hash"].alias("geometry_hash"),
                ),
            ).alias("history"),
        )
    )


def keep_history(changelog: DataFrame, keep: int = cfg.CHANGELOG_VERSIONS) -> DataFrame:
    """Changelog rows with their newest ``keep`` versions: the current line and ``keep - 1`` before it."""
    size = F.size("history")
    newest = F.slice("history", F.greatest(size - (keep - 2), F.lit(1)), keep - 1)
    return changelog.withColumn("history", F.when(size >= keep, newest).otherwise(F.col("history")))


def one_heir_per_source(renames: DataFrame) -> DataFrame:
    """Points can move only once: of several heirs of one old id the smallest gets them."""
    if {"old_id", "new_id"} - set(renames.columns):
        raise ValueError("renames need old_id and new_id")
    return renames.filter(F.col("old_id") != F.col("new_id")).groupBy("old_id").agg(
        F.min("new_id").alias("new_id")
    )


def check_renames(renames: DataFrame) -> DataFrame:
    """Rows asking to rename an id to itself: an error of the caller, listed not applied."""
    return renames.filter(F.col("old_id") == F.col("new_id")).withColumn(
        "reason", F.lit("old_id_equals_new_id")
    )


def retag_series(series: DataFrame, renames: DataFrame) -> DataFrame:
    """Series with old ids rewritten; where both ids have a point at one time the moved one stays.

    The rename table is left to Catalyst: broadcast if measured small, else a shuffle join whose
    skewed partitions the adaptive executor splits. Duplicates fold by aggregation.
    """
    heirs = one_heir_per_source(renames).withColumnRenamed("old_id", "segment_id")
    fields = [c for c in series.columns if c not in ("segment_id", "time")]
    moved = series.join(heirs, "segment_id", "left").select(
        F.coalesce("new_id", "segment_id").alias("segment_id"),
        "time",
        F.struct(F.col("new_id").isNotNull().alias("moved"), F.col("segment_id").alias("origin")).alias("_order"),
        F.struct(*fields).alias("_row"),
    )
    kept = moved.groupBy("segment_id", "time").agg(F.max_by("_row", "_order").alias("_row"))
    return kept.select("segment_id", "time", "_row.*")


def retag_report(series: DataFrame, renames: DataFrame, measurement: str) -> DataFrame:
    """Per rename: points before and after, and whether the old points may go (after >= before)."""
    heirs = one_heir_per_source(renames)
    before = series.select("segment_id", "time").groupBy("segment_id", "time").agg(
        F.count("*").alias("_n")
    )
    counts_before = before.groupBy("segment_id").agg(F.count("*").alias("original_count"))
    after = retag_series(series.select("segment_id", "time"), renames)
    counts_after = after.groupBy("segment_id").agg(F.count("*").alias("retagged_count"))
    zero = F.lit(0).cast("bigint")
    report = (
        heirs.join(counts_before.withColumnRenamed("segment_id", "old_id"), "old_id", "left")
        .join(counts_after.withColumnRenamed("segment_id", "new_id"), "new_id", "left")
        .select(
            F.lit(measurement).alias("measurement"),
            "old_id",
            "new_id",
            F.coalesce("original_count", zero).alias("original_count"),
            F.when(F.col("original_count").isNotNull(), F.coalesce("retagged_count", zero))
            .otherwise(zero)
            .alias("retagged_count"),
        )
    )
    moved = (F.col("original_count") > 0) & (F.col("retagged_count") >= F.col("original_count"))
    return report.withColumn("deleted", moved)


def stamp_migrated(changelog: DataFrame, reports: DataFrame, at: Column) -> DataFrame:
    """Mark pending rows whose moves did not fail in any table; the others stay pending."""
    failed = (
        reports.filter((F.col("original_count") > 0) & ~F.col("deleted"))
        .select(F.col("new_id").alias("segment_id"))
        .distinct()
        .withColumn("_failed", F.lit(True))
    )
    pending = (
        F.col("geo_inherited_from").isNotNull()
        & F.col("timeseries_migrated_at").isNull()
        & (F.col("geo_inherited_from") != F.col("segment_id"))
        & F.col("_failed").isNull()
    )
    return (
        changelog.join(failed, "segment_id", "left")
        .withColumn("timeseries_migrated_at", F.when(pending, at).otherwise(F.col("timeseries_migrated_at")))
        .select(*LOG_COLUMNS)
    )


def segment_cycle(
    fresh: DataFrame,
    changelog: DataFrame,
    archive: DataFrame,
    as_of: Column,
    lookback_hours: float | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One lineage cycle: next log (with inheritance), next archive, and the diff itself."""
    diff = diff_segments(fresh, changelog, as_of)
    log, archived = next_changelog(diff), next_archive(diff, archive)
    new = diff.filter(F.col("change") == "added").select("segment_id", "coords")
    candidates = replacement_candidates(archived, log, removed_ids(diff), as_of, lookback_hours)
    matches = spatial.match_replacements(new, candidates)
    return inherit_history(log, archived, matches), archived, diff
