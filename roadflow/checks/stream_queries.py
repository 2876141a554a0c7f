"""Streaming jobs run to the end of the available data, then compared with the batch SQL."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import functions as F

from roadflow.checks import adapters as A
from roadflow.checks import series_queries as SQ
from roadflow.checks.registry import query
from roadflow.functions import scalars as S
from roadflow.operators import validation as V
from roadflow.plans import jobs as lineage_jobs
from roadflow.session import shared_dir
from roadflow.sources import tables
from roadflow.streaming import jobs
from roadflow.streaming.closure import stream_closure


def _event_stream(spark, d):
    """The events table as a stream of observations, one segment per event type."""
    schema = A.table(spark, d, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return events.select(
        F.col("event_type").alias("segment_id"),
        F.col("ts").cast("timestamp").alias("time"),
        "event_id",
        S.confidence_to_fcd(100 - F.col("event_id") % 61).alias("fcd_coverage"),
    )


def _steps(rows, steps=3):
    """Rows in steps of time, cut at equal distances between the first and the last one."""
    second = F.unix_timestamp("time")
    low, high = rows.agg(F.min(second), F.max(second)).first()
    cuts = [low + (high - low + 1) * i // steps for i in range(steps + 1)] if low is not None else [0] * (steps + 1)
    return [rows.filter((second >= a) & (second < b)) for a, b in zip(cuts, cuts[1:])], high or 0


def _landed_stream(spark, rows, files=4, files_per_batch=4):
    """Rows landed in three steps of time, each split by segment, and read back as a stream.

    A segment is in one file per step, so files taken one after another keep its time order.
    """
    folder = shared_dir(spark, "live")
    for part in _steps(rows)[0]:
        part.repartition(files, "segment_id").write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _follow(spark, rows, run, files=4, closing=None, before=lambda step: None):
    """The same steps, each landed and then streamed to its end by ``run(stream)`` before the next one lands.

    ``closing``: seconds after the last row at which one more row moves the watermark on, as a
    live feed would.
    """
    folder = shared_dir(spark, "live")
    parts, high = _steps(rows)
    for step, part in enumerate(parts):
        if closing is not None and step == len(parts) - 1:
            values = {"segment_id": F.lit("~"), "time": F.timestamp_seconds(F.lit(high + closing))}
            columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema]
            part = part.unionByName(spark.range(1).select(*columns))
        part.repartition(files, "segment_id").write.mode("append").parquet(folder)
        before(step)
        run(spark.readStream.schema(rows.schema).parquet(folder)).awaitTermination()


@contextmanager
def rocksdb(spark):
    """The state store that stateful processors need, for as long as a query runs; the caller's setting comes back."""
    name, own = "spark.sql.streaming.stateStore.providerClass", None
    own = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, own)


def _check(spark):
    return shared_dir(spark, "check")


LANDED_KEYS = f"WITH {SQ.LANDED} SELECT DISTINCT segment_id, time FROM landed"


@query("stream_fcd", LANDED_KEYS)
def stream_fcd(spark, d):
    path = shared_dir(spark, "obs")
    jobs.stream_fcd(
        spark, SQ.land_documents(spark, d), path, _check(spark), follow=False, one_per_file=False
    ).awaitTermination()
    return tables.read_series(spark, path).select("segment_id", "time")


@query("backfill_in_batches", LANDED_KEYS)
def backfill_in_batches(spark, d):
    """History in batches of a dozen files, then a second start that finds nothing new."""
    path, check, landing = shared_dir(spark, "obs"), _check(spark), SQ.land_documents(spark, d)
    for _ in range(2):
        jobs.stream_fcd(
            spark, landing, path, check, follow=False, files_per_batch=12, one_per_file=False
        ).awaitTermination()
    return tables.read_series(spark, path).select("segment_id", "time")


def _land_map(spark, rows, folder, stamps):
    """Snapshots of a network: a document for each stamp and quarter of its segments."""
    point = lambda p: F.struct(p["lon"].alias("longitude"), p["lat"].alias("latitude"))
    entry = F.struct(F.col("segment_id").alias("segmentIdStr"), F.lit(95).alias("confidence"), F.transform("coords", point).alias("shape"))
    stamped = rows.withColumn("day", F.explode(F.array(*[F.lit(s) for s in stamps])))
    documents = stamped.groupBy("day", F.pmod(F.xxhash64("segment_id"), F.lit(4)).alias("part")).agg(
        F.to_json(F.struct(F.collect_list(entry).alias("detailedSegments"))).alias("value")
    )
    documents.drop("part").repartition("day").write.mode("append").partitionBy("day").text(folder)


@query(
    "stream_map_and_lineage",
    f"""WITH {A.LINE_SQL}, {A.FRESH_SQL}
    SELECT segment_id, 'log' AS place, {A.HASH_SQL} AS geometry_hash, CAST(NULL AS TIMESTAMP) AS date_archived FROM fresh
    UNION ALL SELECT segment_id, 'archive', {A.HASH_SQL}, TIMESTAMP '2024-01-08 14:20:00' FROM lines WHERE s_nationkey < 5""",
)
def stream_map_and_lineage(spark, d):
    """A network that changes between snapshots, and a file stamped a year ahead in between: log and archive."""
    landing, root, obs, check = (shared_dir(spark, n) for n in ("landing", "network", "obs", "check"))
    after = lineage_jobs.refresh_map_and_lineage(root, {"fcd": (obs, ["fcd_coverage"])}, 24)
    lines = A.lines(spark, d)
    steps = [
        (lines.filter(~F.col("s_nationkey").between(5, 9)), [f"2024-01-08T12-{m}-00" for m in ("00", "20", "40")]),
        (lines, ["2025-01-08T12-00-00"]),
        (A.fresh_map(spark, d), [f"2024-01-08T{t}-00" for t in ("13-00", "13-20", "13-40", "14-00", "14-20")]),
    ]
    for rows, stamps in steps:
        _land_map(spark, rows, landing, stamps)
        jobs.stream_fcd(spark, landing, obs, check, follow=False, one_per_file=False, after_batch=after).awaitTermination()
    log = tables.load_table(spark, f"{root}/changelog").select(
        "segment_id", F.lit("log").alias("place"), F.col("current_hash").alias("geometry_hash"), F.lit(None).cast("timestamp").alias("date_archived")
    )
    archive = tables.load_table(spark, f"{root}/archive").select(
        "segment_id", F.lit("archive").alias("place"), F.col("current_hash").alias("geometry_hash"), "date_archived"
    )
    return log.unionByName(archive)


@query("tumbling_last_stream", f"WITH {A.SLOTS} SELECT segment_id, time, fcd_coverage FROM slots")
def tumbling_last_stream(spark, d):
    path = shared_dir(spark, "windows")
    windows = jobs.tumbling_last(_event_stream(spark, d), "fcd_coverage", tie="event_id")
    jobs.write_updates(windows, path, _check(spark)).awaitTermination()
    return jobs.newest_updates(spark, path, ["segment_id", "time"])


@query(
    "tumbling_last_closed",
    f"""WITH {A.SLOTS} SELECT segment_id, time, fcd_coverage FROM slots
      WHERE time + INTERVAL 5 MINUTE <= (SELECT max(time) FROM obs) - INTERVAL 1 HOUR""",
)
def tumbling_last_closed(spark, d):
    """Windows appended once each when they close; the files of finished days are merged, then all is read."""
    path, check = shared_dir(spark, "closed"), _check(spark)
    obs = A.type_obs(spark, d).select("segment_id", "time", "event_id", "fcd_coverage")
    _follow(spark, obs, lambda s: jobs.store_closed(jobs.tumbling_last(s, "fcd_coverage", tie="event_id"), path, "fcd_coverage", check))
    tables.merge_small_files(spark, path, tables.read_series(spark, path).agg(F.max("date")).first()[0])
    return tables.read_series(spark, path).select("segment_id", "time", "fcd_coverage")


LATE_CUT = "2024-01-16 00:00:00"


@query(
    "late_and_duplicate",
    f"""WITH {A.TYPE_OBS}, hours AS (SELECT DISTINCT segment_id, date_trunc('hour', time) AS time FROM obs)
    SELECT segment_id, time, CASE WHEN time >= TIMESTAMP '{LATE_CUT}' THEN 'stored' ELSE 'repair' END AS part
    FROM hours""",
)
def late_and_duplicate(spark, d):
    """The later half lands first, each row twice; the earlier half is then too late for the stream.

    What the stream stored and what the repair path finds are told apart.
    """
    folder, path = shared_dir(spark, "landed"), shared_dir(spark, "unique")
    hours = A.type_obs(spark, d).select("segment_id", F.date_trunc("hour", F.col("time")).alias("time"))
    late = F.col("time") < A.ts(LATE_CUT)
    unique = None
    check = _check(spark)
    for part in (hours.filter(~late), hours.filter(late)):
        part.unionByName(part).repartition(4, "segment_id", "time").write.mode("append").parquet(folder)
        unique = jobs.drop_late_and_duplicate(spark.readStream.schema(hours.schema).parquet(folder))
        jobs.write_rows(unique, path, check).awaitTermination()
    stored = spark.read.schema(unique.schema).parquet(path)
    repaired = jobs.too_late(hours, stored).select("segment_id", "time").distinct()
    mark = lambda rows, part: rows.select("segment_id", "time", F.lit(part).alias("part"))
    return mark(stored, "stored").unionByName(mark(repaired, "repair"))


def _stored_profile(spark, d):
    path = shared_dir(spark, "profiles")
    tables.save_table(A.profile(spark, d), path)
    return path


@query(
    "stream_static_profile",
    f"""WITH {SQ.COUNTED} SELECT segment_id, time, fcd, day_of_week, hour_of_day, fcd_mean_median
      FROM matched""",
)
def stream_static_profile(spark, d):
    path = shared_dir(spark, "joined")
    profile = tables.load_table(spark, _stored_profile(spark, d))
    joined = jobs.with_profile(_landed_stream(spark, A.live(spark, d)), profile)
    jobs.write_rows(joined, path, _check(spark)).awaitTermination()
    columns = ["segment_id", "time", "fcd", "day_of_week", "hour_of_day", "fcd_mean_median"]
    return spark.read.parquet(path).select(*columns)


SECOND_PROFILE = datetime(2024, 1, 16)


@query(
    "stream_profile_in_force",
    f"""WITH {SQ.COUNTED} SELECT segment_id, time, fcd, day_of_week, hour_of_day,
      fcd_mean_median + CASE WHEN time >= TIMESTAMP '{SECOND_PROFILE}' THEN 1 ELSE 0 END AS fcd_mean_median FROM matched""",
)
def stream_profile_in_force(spark, d):
    """The profile is replaced between two micro-batches; each row has the one in force at its time."""
    path, versions, check = shared_dir(spark, "joined"), shared_dir(spark, "versions"), _check(spark)
    profile = tables.load_table(spark, _stored_profile(spark, d))
    second = profile.withColumn("fcd_mean_median", F.col("fcd_mean_median") + 1)

    def replace(step):
        if step == 0:
            jobs.save_profile_version(profile, versions, datetime(2023, 12, 31))
        if step == 1:
            jobs.save_profile_version(second, versions, SECOND_PROFILE)

    _follow(spark, A.live(spark, d), lambda s: jobs.stream_profiled(s, versions, path, check), before=replace)
    columns = ["segment_id", "time", "fcd", "day_of_week", "hour_of_day", "fcd_mean_median"]
    return spark.read.parquet(path).select(*columns)


STATUS_SQL = f"""WITH {SQ.WALK} SELECT segment_id, time, fcd, consecutive_zeros, consecutive_low,
  round(running_mean, 6) AS running_mean, segment_closure_status FROM status"""
STATUS_COLUMNS = [
    "segment_id",
    "time",
    "fcd",
    "consecutive_zeros",
    "consecutive_low",
    "running_mean",
    "segment_closure_status",
]


def _status(rows):
    return rows.select(*STATUS_COLUMNS).withColumn("running_mean", F.round("running_mean", 6))


#: Seconds in which a day's lateness and a retired segment's timer are surely over.
CLOSING = 60 * 86_400


def _validator(spark, rows, profile, retire_days):
    path, check = shared_dir(spark, "closure"), _check(spark)

    def run(stream):
        matched = jobs.with_profile(stream, profile)
        return jobs.write_rows(stream_closure(matched, late="1 day", retire_days=retire_days), path, check)

    _follow(spark, rows, run, closing=CLOSING)
    return _status(spark.read.parquet(path))


@query("stream_validator", STATUS_SQL)
def stream_validator(spark, d):
    """Counters, k and mean carried in state over several micro-batches equal one batch run.

    The session needs the RocksDB state store.
    """
    with rocksdb(spark):
        return _validator(spark, A.live(spark, d), tables.load_table(spark, _stored_profile(spark, d)), 40)


HOLE = ("2024-01-12 00:00:00", "2024-01-16 00:00:00")
RETIRED_WALK = (
    SQ.WALK.replace(
        "numbered_live AS (",
        f"""parts AS (
  SELECT segment_id || CASE WHEN time < TIMESTAMP '{HOLE[0]}' THEN '#0' ELSE '#1' END AS segment_id, time, fcd_coverage
  FROM slots WHERE time < TIMESTAMP '{HOLE[0]}' OR time >= TIMESTAMP '{HOLE[1]}'), numbered_live AS (""",
    )
    .replace("AS rn FROM slots)", "AS rn FROM parts)")
    .replace("p.segment_id = c.segment_id", "p.segment_id = split_part(c.segment_id, '#', 1)")
)


@query(
    "stream_validator_retired",
    f"""WITH {RETIRED_WALK} SELECT split_part(segment_id, '#', 1) AS segment_id, time, fcd, consecutive_zeros, consecutive_low,
      round(running_mean, 6) AS running_mean, segment_closure_status FROM status""",
)
def stream_validator_retired(spark, d):
    """Segments silent for more than three days have lost their state and start anew."""
    live = A.live(spark, d)
    live = live.filter((F.col("time") < A.ts(HOLE[0])) | (F.col("time") >= A.ts(HOLE[1])))
    with rocksdb(spark):
        return _validator(spark, live, tables.load_table(spark, _stored_profile(spark, d)), 3)


@query("stream_validation", STATUS_SQL)
def stream_validation(spark, d):
    """The batch plan inside ``foreachBatch``; all landed files make one micro-batch here."""
    path, state = shared_dir(spark, "validation"), shared_dir(spark, "state")
    live = _landed_stream(spark, A.live(spark, d), files_per_batch=1000)
    jobs.stream_validation(
        spark, live, _stored_profile(spark, d), path, state, _check(spark)
    ).awaitTermination()
    return _status(tables.read_series(spark, path))


@query("stream_status", SQ.CURRENT_STATUS)
def stream_status(spark, d):
    path = shared_dir(spark, "status")
    rows = V.validate(A.live(spark, d), A.profile(spark, d))
    stored = shared_dir(spark, "rows")
    rows.write.parquet(stored)
    stream = _landed_stream(spark, spark.read.parquet(stored))
    jobs.stream_status(stream, path, _check(spark)).awaitTermination()
    return tables.load_table(spark, path).withColumn("running_mean", F.round("running_mean", 6))
