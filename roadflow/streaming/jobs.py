"""Streaming jobs: follow landed files, tumbling last value, duplicates, status, static join."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadflow import config as cfg
from roadflow import schemas
from roadflow.functions import scalars as S
from roadflow.operators import observations, validation
from roadflow.sources import snapshots, tables

LATE = "1 hour"


def _start(writer, checkpoint: str, follow: bool, every: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = dict(processingTime=every) if follow else dict(availableNow=True)
    return writer.trigger(**trigger).start()


def stream_fcd(
    spark: SparkSession,
    landing: str,
    obs_path: str,
    checkpoint: str,
    follow: bool = True,
    files_per_batch: int = 50,
    every: str = "5 minutes",
    after_batch: Callable[[DataFrame, int], None] | None = None,
    one_per_file: bool = True,
    rejects_path: str | None = None,
    report_path: str | None = None,
) -> StreamingQuery:
    """Landed snapshot files to the keyed series table.

    ``follow=False`` works through what is there and ends (backfill); started again with the
    same checkpoint and ``follow=True`` it goes on from that point. A batch may be repeated:
    the table is keyed by (segment, time). ``after_batch`` refreshes the map and the lineage.
    Unusable files go to ``rejects_path`` with their reasons and the ingest report to
    ``report_path``, a folder per batch each, so a repeated batch replaces its own.
    """
    files = snapshots.stream_fcd_snapshots(spark, landing, files_per_batch, one_per_file)

    def store(batch: DataFrame, batch_id: int) -> None:
        good, bad = snapshots.split_good(batch)
        if rejects_path is not None:
            bad.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        if report_path is not None:
            observations.ingest_report(batch).write.mode("overwrite").parquet(f"{report_path}/batch={batch_id}")
        obs = observations.merge_observations(observations.snapshots_to_obs(good))
        tables.write_fcd_obs(obs, obs_path, only_new=True)
        if after_batch is not None:
            # A batch has few files, so what is known of them is small beside their rows.
            arrived = good.groupBy(F.col("file_name").alias("source_file")).agg(F.max("modified_at").alias("arrived_at"))
            after_batch(obs.join(F.broadcast(arrived), "source_file", "left"), batch_id)

    return _start(files.writeStream.foreachBatch(store), checkpoint, follow, every)


def backfill_then_follow(
    spark: SparkSession, landing: str, obs_path: str, checkpoint: str, **options
) -> StreamingQuery:
    """All history first, then new files as they land, on one checkpoint."""
    stream_fcd(spark, landing, obs_path, checkpoint, follow=False, **options).awaitTermination()
    return stream_fcd(spark, landing, obs_path, checkpoint, follow=True, **options)


def tumbling_last(
    obs: DataFrame,
    field: str,
    minutes: int = cfg.SAMPLE_MINUTES,
    late: str = LATE,
    tie: str | None = None,
) -> DataFrame:
    """Last non-null value per segment and window on a stream; windows close after ``late``."""
    order = F.struct("time", tie) if tie else F.col("time")
    return (
        obs.withWatermark("time", late)
        .filter(F.col(field).isNotNull())
        .groupBy("segment_id", F.window("time", f"{minutes} minutes").alias("_w"))
        .agg(F.max_by(field, order).alias(field))
        .select("segment_id", F.col("_w.start").alias("time"), field)
    )


def drop_late_and_duplicate(obs: DataFrame, late: str = LATE) -> DataFrame:
    """First arrival of each (segment, time) within the allowed lateness."""
    return obs.withWatermark("time", late).dropDuplicatesWithinWatermark(["segment_id", "time"])


def too_late(obs: DataFrame, stored: DataFrame) -> DataFrame:
    """Repair path: keys of a batch re-read that the stream did not store."""
    return obs.join(stored.select("segment_id", "time"), ["segment_id", "time"], "left_anti")


def write_updates(
    updates: DataFrame, path: str, checkpoint: str, follow: bool = False, every: str = "5 minutes"
) -> StreamingQuery:
    """Rows an ``update`` query changes, kept with their batch number; readers take the newest."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = updates.writeStream.outputMode("update").foreachBatch(store)
    return _start(writer, checkpoint, follow, every)


def newest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest state of every key written by ``write_updates``."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in [*keys, "batch"]]
    newest = F.max_by(F.struct(*values), "batch")
    return rows.groupBy(*keys).agg(newest.alias("_v")).select(*keys, "_v.*")


def write_rows(
    rows: DataFrame, path: str, checkpoint: str, follow: bool = False, every: str = "5 minutes"
) -> StreamingQuery:
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, checkpoint, follow, every)


def store_closed(
    windows: DataFrame, path: str, field: str, checkpoint: str, follow: bool = False, every: str = "5 minutes"
) -> StreamingQuery:
    """Windows of ``tumbling_last`` to a keyed series table, each once, when the watermark has passed its end.

    State holds open windows only. A repeated batch finds its keys stored and adds nothing; no
    history of updates is kept. ``tables.merge_small_files`` joins the files of days gone by.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            tables.write_series(batch, path, [field], only_new=True)

    return _start(windows.writeStream.outputMode("append").foreachBatch(store), checkpoint, follow, every)


def save_profile_version(profiles: DataFrame, path: str, valid_from: datetime) -> None:
    """Profiles in force from ``valid_from`` (UTC) until the next version's moment."""
    stamp = int(valid_from.replace(tzinfo=timezone.utc).timestamp())
    profiles.write.mode("overwrite").parquet(f"{path}/valid_from={stamp}")


def profile_versions(spark: SparkSession, path: str) -> list[int]:
    """Moments (seconds) from which the stored versions are valid."""
    fs, p = tables.file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[11:]) for n in names if n.startswith("valid_from=") and tables.exists(spark, f"{path}/{n}/_SUCCESS"))


def profile_in_force(live: DataFrame, path: str) -> DataFrame:
    """``with_profile`` by each row's own time: the version valid then, whichever is newest now.

    So a batch repeated or a day replayed after the profile was replaced gives the same rows.
    Only versions valid within the rows' time are read; rows before the first have no profile.
    """
    spark = live.sparkSession
    versions = profile_versions(spark, path)
    if not versions:
        raise FileNotFoundError(path)
    seconds = F.unix_timestamp("time")
    low, high = live.agg(F.min(seconds), F.max(seconds)).first()
    parts = []
    for i, start in enumerate(versions):
        end = versions[i + 1] if i + 1 < len(versions) else None
        if low is not None and (high < start or (end is not None and low >= end)):
            continue
        rows = live.filter((seconds >= start) & (F.lit(end is None) | (seconds < F.lit(end))))
        parts.append(with_profile(rows, spark.read.parquet(f"{path}/valid_from={start}")))
    first = spark.read.parquet(f"{path}/valid_from={versions[0]}")
    out = with_profile(live.filter(seconds < versions[0]), first.limit(0))
    for part in parts:
        out = out.unionByName(part)
    return out


def stream_profiled(
    live: DataFrame, versions_path: str, path: str, checkpoint: str, follow: bool = False, every: str = "5 minutes"
) -> StreamingQuery:
    """Live rows with the bucket of the profile in force; versions are looked up anew for every micro-batch."""

    def store(batch: DataFrame, batch_id: int) -> None:
        profile_in_force(batch, versions_path).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(live.writeStream.foreachBatch(store), checkpoint, follow, every)


def with_profile(live: DataFrame, profile: DataFrame) -> DataFrame:
    """Stream-static left join: live rows with the bucket of the profile in force.

    Inside ``foreachBatch`` pass a freshly read profile to pick up replaced ones.
    """
    time = F.col("time")
    return (
        live.withColumn("day_of_week", S.day_name(time))
        .withColumn("hour_of_day", S.hour_of_day(time))
        .join(
            profile.select("segment_id", "day_of_week", "hour_of_day", *validation.PROFILE_VALUES),
            ["segment_id", "day_of_week", "hour_of_day"],
            "left",
        )
    )


def stream_status(
    validated: DataFrame, path: str, checkpoint: str, follow: bool = False, every: str = "5 minutes"
) -> StreamingQuery:
    """Newest status per segment as a table replaced after every batch."""
    spark = validated.sparkSession
    schema = "segment_id string, time timestamp, running_mean double, segment_closure_status string"

    def store(batch: DataFrame, batch_id: int) -> None:
        columns = ["segment_id", "time", "running_mean", "segment_closure_status"]
        before = tables.load_table(spark, path, schema)
        rows = before.unionByName(batch.select(*columns))
        tables.save_table(validation.current_status(rows), path)

    return _start(validated.writeStream.foreachBatch(store), checkpoint, follow, every)


def stream_validation(
    spark: SparkSession,
    live: DataFrame,
    profiles_path: str,
    validation_path: str,
    status_path: str,
    checkpoint: str,
    follow: bool = False,
    every: str = "5 minutes",
    repair_path: str | None = None,
) -> StreamingQuery:
    """Validate each micro-batch with the batch plan; the state is the last stored row per segment.

    Profiles are read anew per batch. Counters start at zero in every batch while the mean goes
    on, as a cycle of the batch job does; ``ClosureProcessor`` carries the counters as well.
    The state rows are read from the status table, one row per segment. Rows not newer than their
    segment's state are not validated; ``repair_path`` lists them, a folder per batch.
    """
    fields = ["time", *validation.STATE]

    def store(batch: DataFrame, batch_id: int) -> None:
        profiles = tables.load_table(spark, profiles_path)
        done = tables.load_table(spark, status_path, schemas.VALIDATION_STATE)
        # A repeated batch must start from the state before its first try, so each segment keeps
        # its last row and the one before.
        newest = F.max_by(F.struct(*fields, "batch_id"), "batch_id").alias("_s")
        before = (
            done.filter(F.col("batch_id") < batch_id)
            .groupBy("segment_id")
            .agg(newest)
            .select("segment_id", "_s.*")
        )
        if repair_path is not None:
            old = validation.replayed_rows(batch.select("segment_id", "time", "fcd"), before)
            old.write.mode("overwrite").parquet(f"{repair_path}/batch={batch_id}")
        rows = validation.validate(batch.select("segment_id", "time", "fcd"), profiles, before)
        tables.write_validation(rows, validation_path)
        last = (
            rows.groupBy("segment_id")
            .agg(F.max_by(F.struct(*fields), "time").alias("_s"))
            .select("segment_id", "_s.*", F.lit(batch_id).cast("bigint").alias("batch_id"))
        )
        tables.save_table(before.unionByName(last), status_path)

    return _start(live.writeStream.foreachBatch(store), checkpoint, follow, every)
