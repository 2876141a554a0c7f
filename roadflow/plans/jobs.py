"""The three jobs end to end: ingest, affected segments, profile and validate."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow import config as cfg
from roadflow import schemas
from roadflow.functions import scalars as S
from roadflow.operators import disturbances as D
from roadflow.operators import lineage as L
from roadflow.operators import observations as O
from roadflow.operators import presence, series, spatial, validation
from roadflow.operators import profile as P
from roadflow.sources import snapshots, tables


def ingest(
    spark: SparkSession, landing: str, start: datetime | None = None, end: datetime | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Observations, unusable files and the report of a landing folder."""
    files = snapshots.read_fcd_snapshots(spark, landing, start, end)
    good, bad = snapshots.split_good(files)
    obs = O.merge_observations(O.snapshots_to_obs(good))
    return obs, bad, O.ingest_report(files)


def affected_segments(
    reports: DataFrame, segment_map: DataFrame, validation_date: Column, as_of: Column
) -> DataFrame:
    """Date rules, widened spatial join and collisions in one plan, flat."""
    valid = D.valid_disturbances(D.classify_disturbances(reports, validation_date, as_of))
    hits = spatial.segments_hit_by(segment_map, valid)
    return D.collisions(hits, valid)


def profile_and_validate(
    obs: DataFrame,
    profile_start: Column,
    profile_end: Column,
    as_of: Column,
    weeks: int = cfg.PROFILE_WEEKS,
    stored: DataFrame | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Normal week of every segment, then the status of its rows from the profile's end on."""
    profiles = P.build_profiles(obs, profile_start, profile_end, cfg.min_weeks_for(weeks), tie=tie)
    live = obs.filter((F.col("time") >= profile_end) & (F.col("time") < as_of))
    slots = series.downsample_last(live, ["fcd_coverage"], tie=tie)
    accepted = slots.join(profiles.select("segment_id").distinct(), "segment_id", "left_semi")
    fcd = accepted.withColumnRenamed("fcd_coverage", "fcd")
    return validation.validate(fcd, profiles, stored)


def run_lineage(
    spark: SparkSession,
    root: str,
    fresh: DataFrame,
    as_of: datetime,
    series_tables: dict[str, tuple[str, list[str]]],
    lookback_hours: float | None = None,
    keep_versions: int = cfg.CHANGELOG_VERSIONS,
) -> DataFrame:
    """One lineage cycle on stored tables: diff, inherit, rename series, stamp, save.

    Each segment keeps its newest ``keep_versions`` versions. A table whose renames fail leaves
    its pairs pending and does not stop the others; the last failure is raised after the log is saved.

    ``series_tables`` maps a measurement to its path and value fields. A rename copies, counts
    and then deletes; if that fails the log keeps the pair pending and the next cycle tries
    again. The archive is saved only when something was removed. Returns the rename report.
    """
    at = F.lit(as_of)
    log = tables.load_table(spark, f"{root}/changelog", schemas.CHANGELOG)
    archive = tables.load_table(spark, f"{root}/archive", schemas.ARCHIVE)
    next_log, next_archive, diff = L.segment_cycle(fresh, log, archive, at, lookback_hours)
    # Saved before use: the renames read files, not the matching plan again.
    tables.save_table(next_log, f"{root}/changelog_inherited")
    if not L.removed_ids(diff).isEmpty():
        tables.save_table(next_archive, f"{root}/archive")
    next_log = tables.load_table(spark, f"{root}/changelog_inherited")
    renames = L.pending_migrations(next_log)
    reports = spark.createDataFrame([], schemas.RENAME_REPORT)
    failure = None
    for measurement, (path, fields) in series_tables.items():
        try:
            reports = reports.unionByName(tables.move_segments(spark, path, renames, fields, measurement))
        except Exception as e:  # noqa: BLE001
            failure = e
            lost = renames.select(F.lit(measurement).alias("measurement"), "old_id", "new_id")
            lost = lost.withColumns({"original_count": F.lit(1).cast("bigint"), "retagged_count": F.lit(0).cast("bigint"), "deleted": F.lit(False)})
            reports = reports.unionByName(lost)
    if series_tables:
        next_log = L.stamp_migrated(next_log, reports, at)
    tables.save_table(L.keep_history(next_log, keep_versions), f"{root}/changelog")
    if failure is not None:
        raise failure
    return reports


CYCLES = """
    batch_id bigint, now timestamp, until timestamp, gone timestamp, files bigint, waiting bigint,
    present bigint, left_map bigint, skipped string
"""


def _network_changed(fresh: DataFrame, changelog: DataFrame) -> bool:
    """Whether a lineage cycle has anything to do: a segment new, gone or redrawn, or a rename pending."""
    now = fresh.select("segment_id", S.geometry_hash(F.col("coords")).alias("now"))
    both = now.join(changelog.select("segment_id", "current_hash"), "segment_id", "full_outer")
    if not both.filter(~F.col("now").eqNullSafe(F.col("current_hash"))).isEmpty():
        return True
    return not L.pending_migrations(changelog).isEmpty()


def refresh_map_and_lineage(
    root: str,
    series_tables: dict[str, tuple[str, list[str]]],
    lookback_hours: float | None = None,
    window_minutes: float = 60,
    gap_minutes: float = 45,
    keep_tables: int = 12,
) -> Callable[[DataFrame, int], None]:
    """What follows the storing of a streamed batch: replace the map, run a lineage cycle.

    The fresh map is every segment that the feed has reported within its last ``window_minutes``, not
    the batch alone: each segment's newest line and time is carried along. ``presence`` tells the
    feed's time: a pause counts for at most ``gap_minutes``, less than the window, so the first file
    after an outage takes nobody off the map, and a stamp far ahead waits and moves no clock. Rows
    that wait are kept beside and count once the clock gets there.

    Most batches change nothing in the network; they end with one comparison of the map with the log.
    Every batch adds a row to ``{root}/cycles``, also where the cycle was skipped, with the reason.
    A batch repeated starts from the arrivals before it and changes nothing. Of each table the
    newest ``keep_tables`` versions stay.
    """
    window, gap = timedelta(minutes=window_minutes), timedelta(minutes=gap_minutes)
    if not gap < window:
        raise ValueError("gap_minutes must be less than window_minutes")

    def after(obs: DataFrame, batch_id: int) -> None:
        spark = obs.sparkSession
        save = lambda df, name: tables.save_table(df, f"{root}/{name}")
        load = lambda name, schema=None: tables.load_table(spark, f"{root}/{name}", schema)
        # A row per file, and of stored ones those of the last hour of feed.
        new = [tuple(r) for r in presence.arrivals_of(obs, batch_id).collect()]
        if not new:
            return
        stored = [tuple(r) for r in load("arrivals", presence.ARRIVALS).collect()]
        before = [r for r in stored if r[1] < batch_id]
        clock = presence.feed_clock(before, new, window, gap)
        now = None if clock is None else clock.now
        kept = presence.arrivals_to_keep(before + [(*r, clock and clock.base) for r in new], clock, batch_id)

        lines = obs.select("segment_id", "coords", "time")
        rows = load("seen", presence.SEEN).unionByName(load("waiting", presence.SEEN)).unionByName(lines)
        reached, waiting = presence.split_by_clock(rows, clock)
        save(presence.last_seen(reached), "seen_all")
        save(waiting.dropDuplicates(["segment_id", "time"]), "waiting")
        fresh, left_map, skipped = load("seen_all"), 0, "no stamp to believe"
        if clock is not None:
            everyone = fresh
            fresh = presence.present(everyone, clock)
            left_map = everyone.count() - fresh.count()
            skipped = None if any(r[0] <= clock.until for r in new) else "all stamps ahead"
        save(fresh, "seen")
        fresh = load("seen")
        if clock is not None:
            drawn = fresh.filter(F.col("coords").isNotNull()).select("segment_id", "coords")
            save(O.segment_map(drawn, F.lit(now)), "map")
            if _network_changed(drawn, load("changelog", schemas.CHANGELOG)):
                run_lineage(spark, root, drawn, now, series_tables, lookback_hours)
        save(spark.createDataFrame(kept, presence.ARRIVALS), "arrivals")
        cycle = (
            batch_id, now, clock and clock.until, clock and clock.gone, len(new),
            load("waiting").count(), fresh.count(), left_map, skipped,
        )
        spark.createDataFrame([cycle], CYCLES).drop("batch_id").write.mode("overwrite").parquet(f"{root}/cycles/batch_id={batch_id}")
        for name in ("seen_all", "seen", "waiting", "arrivals", "map", "changelog_inherited", "changelog", "archive"):
            tables.trim_versions(spark, f"{root}/{name}", keep_tables)

    return after
