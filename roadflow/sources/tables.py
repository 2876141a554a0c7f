"""Tables on shared storage: keyed series by day, and tables that are replaced as a whole."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow import config as cfg
from roadflow import schemas
from roadflow.functions import scalars as S
from roadflow.operators.lineage import one_heir_per_source
from roadflow.session import shared_dir


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path, as the JVM knows them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions of a replaced table: folders ``v=<n>`` that hold a success marker."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    found = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("v=") and exists(spark, f"{path}/{name}/_SUCCESS"):
            found.append(int(name[2:]))
    return sorted(found)


def save_table(df: DataFrame, path: str) -> int:
    """Replace a table: write the next version beside the current one, so it may be read meanwhile.

    An empty result is written too: it replaces what was there. Older versions stay until
    ``expire_versions`` is called.
    """
    done = versions(df.sparkSession, path)
    number = done[-1] + 1 if done else 1
    df.write.mode("overwrite").parquet(f"{path}/v={number}")
    return number


def expire_versions(spark: SparkSession, path: str, before: datetime) -> list[int]:
    """Remove versions replaced before a moment; the newest one always stays.

    ``before`` must lie further back than any reader holds a version.
    """
    gone, done = [], versions(spark, path)
    for number, after in zip(done, done[1:]):
        fs, p = file_system(spark, f"{path}/v={after}/_SUCCESS")
        if fs.getFileStatus(p).getModificationTime() < before.timestamp() * 1000:
            fs.delete(file_system(spark, f"{path}/v={number}")[1], True)
            gone.append(number)
    return gone


def trim_versions(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Remove all but the newest ``keep`` versions; a reader may hold one for as many saves."""
    gone = versions(spark, path)[: -max(keep, 1)]
    for number in gone:
        fs, p = file_system(spark, f"{path}/v={number}")
        fs.delete(p, True)
    return gone


def load_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The newest finished version; with a schema a missing table reads as empty."""
    done = versions(spark, path)
    if not done:
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return spark.read.parquet(f"{path}/v={done[-1]}")


def check_series(df: DataFrame) -> None:
    missing = {"segment_id", "time"} - set(df.columns)
    if missing:
        raise ValueError(f"series lacks {sorted(missing)}")


def clean_points(obs: DataFrame, fields: list[str]) -> DataFrame:
    """Points worth storing: a time, and at least one field that is not null."""
    some = F.coalesce(*[F.col(f).cast("string") for f in fields]).isNotNull()
    return obs.filter(F.col("time").isNotNull() & some)


def bucket_of(segment: Column, buckets: int = cfg.SERIES_BUCKETS) -> Column:
    """Storage bucket of a segment; of a literal id Spark folds it, so lookups prune by it."""
    return F.pmod(F.xxhash64(segment), F.lit(buckets).cast("bigint")).cast("int")


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", F.to_date("time")).withColumn(
        "bucket", bucket_of(F.col("segment_id"))
    )


def _write_parts(rows: DataFrame, path: str, mode: str) -> None:
    # Range partitioning by day and segment: a busy day is spread over several files.
    (
        rows.repartitionByRange("date", "bucket", "segment_id", "time")
        .sortWithinPartitions("date", "bucket", "segment_id", "time")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "bucket")
        .parquet(path)
    )


def _stored_parts(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame | None:
    """Stored rows of the days and buckets that ``rows`` touch.

    The list of parts is as short as the calendar times the buckets, whatever the data.
    """
    if not exists(spark, path):
        return None
    parts = _placed(rows).select("date", "bucket").distinct().collect()
    return spark.read.parquet(path).filter(
        F.col("date").isin(sorted({r.date for r in parts}))
        & F.col("bucket").isin(sorted({r.bucket for r in parts}))
    )


def _in_buckets_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored rows of the buckets that hold the given segments: at most all buckets."""
    found = ids.select(bucket_of(F.col("segment_id")).alias("b")).distinct().collect()
    return rows.filter(F.col("bucket").isin([r.b for r in found]))


def write_series(df: DataFrame, path: str, fields: list[str], only_new: bool = False) -> None:
    """Store points keyed (segment, time) in a table partitioned by day and segment bucket.

    An upsert rewrites the touched parts, the later write wins. ``only_new`` leaves stored keys
    alone and appends the others: nothing is rewritten, which suits a stream that re-reads its
    last hour. Either way the same rows written twice change nothing. Within one call the row
    of the last source file wins. Touched parts are staged beside the table and moved in when all of
    them are written, so a job that fails on the way leaves the stored rows as they were.
    """
    check_series(df)
    spark = df.sparkSession
    time = F.col("time") if dict(df.dtypes)["time"] == "timestamp" else S.iso_to_timestamp(F.col("time"))
    values = [c for c in df.columns if c not in ("segment_id", "time")]
    new = clean_points(df.withColumn("time", time), fields)
    # The parts are found from the two key columns alone; the input is not held in memory.
    stored = _stored_parts(spark, path, new.select("segment_id", "time"))
    rows = new.withColumn("_age", F.lit(1))
    if stored is not None and only_new:
        keys = stored.select("segment_id", "time")
        rows = rows.join(keys, ["segment_id", "time"], "left_anti")
    elif stored is not None:
        old = stored.drop("date", "bucket").withColumn("_age", F.lit(0))
        rows = old.unionByName(rows, allowMissingColumns=True)
    tie = F.struct("_age", *[c for c in ("source_file", "position") if c in values])
    kept = (
        rows.groupBy("segment_id", "time")
        .agg(F.max_by(F.struct(*values), tie).alias("_row"))
        .select("segment_id", "time", "_row.*")
    )
    _write_parts(_placed(kept), path, "append" if only_new else "overwrite")


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """Days of a series table, newest first, from its folders' names."""
    fs, p = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted((date.fromisoformat(n[5:]) for n in names if n.startswith("date=")), reverse=True)


def newest_rows(
    spark: SparkSession, path: str, segments: DataFrame, until: Column | None = None, days: int | None = None
) -> DataFrame:
    """The newest stored row of each of ``segments``, at most ``until``; segments without one have none.

    Reads the newest day first and goes back only for segments that have no answer yet, so for a
    live series it reads the last day, not the history. ``days`` ends the search so many days before
    the newest stored day.
    """
    left = _kept(segments.select("segment_id").distinct())
    series = spark.read.parquet(path).drop("bucket")
    if until is not None:
        series = series.filter(F.col("time") <= until)
    values = [c for c in series.columns if c not in ("segment_id", "date")]
    found = series.limit(0).select("segment_id", *values)
    for day in stored_days(spark, path)[: None if days is None else days + 1]:
        rows = series.filter(F.col("date") == F.lit(day)).join(left, "segment_id", "left_semi")
        newest = rows.groupBy("segment_id").agg(F.max_by(F.struct(*values), "time").alias("_row"))
        newest = _kept(newest.select("segment_id", "_row.*"))
        found = found.unionByName(newest)
        left = _kept(left.join(newest, "segment_id", "left_anti"))
        if left.isEmpty():
            break
    return found


def _part_state(spark: SparkSession, path: str) -> DataFrame:
    """(date, bucket, state): what files a part has now; read from file metadata."""
    files = spark.read.parquet(path).select("date", "bucket", "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    files = files.groupBy(*files.columns).agg(F.count("*").alias("rows"))
    state = F.sum(F.xxhash64("file_path", "file_size", "file_modification_time", "rows").cast("decimal(38, 0)"))
    return files.groupBy("date", "bucket").agg(state.alias("state"))


def series_digests(spark: SparkSession, path: str) -> DataFrame:
    """(date, bucket, rows, digest) of a series table; kept in a table beside it, brought up to date here.

    The digest adds up a hash per row, reals rounded to 3, so it tells nothing of order or files.
    Only parts whose files have changed since the last call are read.
    """
    beside = f"{path.rstrip('/')}_digests"
    schema = "date date, bucket int, state decimal(38, 0), rows bigint, digest decimal(38, 0)"
    before = load_table(spark, beside, schema)
    now = _kept(_part_state(spark, path))
    same = ["date", "bucket", "state"]
    changed = now.join(before.select(*same), same, "left_anti").collect()
    kept = before.join(now, same, "left_semi").select(*before.columns)
    if changed or kept.count() < before.count():
        rows = in_parts(spark.read.parquet(path), [(r.date, r.bucket) for r in changed])
        values = [
            F.round(f.name, 3) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
            for f in sorted(rows.schema.fields, key=lambda f: f.name)
            if f.name not in ("date", "bucket")
        ]
        digest = F.sum(F.xxhash64(*values).cast("decimal(38, 0)")).alias("digest")
        new = rows.groupBy("date", "bucket").agg(F.count("*").alias("rows"), digest).join(now, ["date", "bucket"])
        save_table(kept.unionByName(new.select(*before.columns)), beside)
    return load_table(spark, beside, schema).drop("state")


def in_parts(series: DataFrame, parts: list[tuple[date, int]]) -> DataFrame:
    """Rows of some (day, bucket) parts; the others are pruned."""
    if not parts:
        return series.limit(0)
    hit = F.struct("date", "bucket").isin(*[F.struct(F.lit(d), F.lit(b)) for d, b in parts])
    return series.filter(F.col("date").isin(sorted({d for d, _ in parts})) & F.col("bucket").isin(sorted({b for _, b in parts})) & hit)


def merge_small_files(spark: SparkSession, path: str, before: date, most_files: int = 1) -> int:
    """Rewrite the (day, bucket) parts of days before ``before`` that lie in more than ``most_files`` files, one file each.

    For days that no writer adds to any more. Returns the number of parts rewritten.
    """
    rows = spark.read.parquet(path).filter(F.col("date") < F.lit(before))
    files = rows.select("date", "bucket", F.col("_metadata.file_path").alias("file")).groupBy("date", "bucket")
    # A part is a day and a bucket: as many as the calendar has, whatever the data.
    parts = files.agg(F.count_distinct("file").alias("n")).filter(F.col("n") > most_files).collect()
    if not parts:
        return 0
    small = in_parts(rows, [(r.date, r.bucket) for r in parts])
    (
        small.repartition("date", "bucket")
        .sortWithinPartitions("date", "bucket", "segment_id", "time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "bucket")
        .parquet(path)
    )
    return len(parts)


def drop_segments(spark: SparkSession, path: str, segments: DataFrame) -> None:
    """Delete all points of some segments: only (day, bucket) parts that hold them are rewritten.

    Parts left without any row are removed at the end, as an overwrite by part cannot empty one.
    """
    gone = segments.select("segment_id").distinct()
    series = _in_buckets_of(spark.read.parquet(path), gone)
    part = ["date", "bucket"]
    touched = series.select("segment_id", *part).join(gone, "segment_id", "left_semi")
    parts = touched.select(*part).distinct().collect()
    if not parts:
        return
    hit = F.struct(*part).isin(*[F.struct(F.lit(r.date), F.lit(r.bucket)) for r in parts])
    days = F.col("date").isin(sorted({r.date for r in parts}))
    buckets = F.col("bucket").isin(sorted({r.bucket for r in parts}))
    left = series.filter(days & buckets & hit).join(gone, "segment_id", "left_anti")
    full = {(r.date, r.bucket) for r in left.select(*part).distinct().collect()}
    _write_parts(left, path, "overwrite")
    for r in parts:
        if (r.date, r.bucket) not in full:
            fs, p = file_system(spark, f"{path}/date={r.date}/bucket={r.bucket}")
            fs.delete(p, True)


def _kept(df: DataFrame) -> DataFrame:
    """A small intermediate result as a written table in the shared folder."""
    path = shared_dir(df.sparkSession, "move")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def move_segments(
    spark: SparkSession, path: str, renames: DataFrame, fields: list[str], measurement: str
) -> DataFrame:
    """Rename segments in a stored series: copy, count, and only then delete the old points.

    Returns the report per pair. Where a count falls short nothing is deleted.
    """
    # Used in every step below, so it is worked out once.
    heirs = _kept(one_heir_per_source(renames))
    old_ids = heirs.select(F.col("old_id").alias("segment_id"))
    series = _in_buckets_of(spark.read.parquet(path), old_ids).drop("date", "bucket")
    count = lambda ids: (
        _in_buckets_of(spark.read.parquet(path), ids)
        .join(ids, "segment_id", "left_semi")
        .groupBy("segment_id")
        .agg(F.count("*").alias("n"))
    )
    before = _kept(count(old_ids))
    moved = (
        series.join(heirs.withColumnRenamed("old_id", "segment_id"), "segment_id")
        .withColumn("segment_id", F.col("new_id"))
        .drop("new_id")
    )
    write_series(moved, path, fields)
    after = count(heirs.select(F.col("new_id").alias("segment_id")))
    zero = F.lit(0).cast("bigint")
    had = F.coalesce("_before", zero)
    report = (
        heirs.join(before.toDF("old_id", "_before"), "old_id", "left")
        .join(after.toDF("new_id", "_after"), "new_id", "left")
        .select(
            F.lit(measurement).alias("measurement"),
            "old_id",
            "new_id",
            had.alias("original_count"),
            F.when(had > 0, F.coalesce("_after", zero)).otherwise(zero).alias("retagged_count"),
        )
        .withColumn(
            "deleted",
            (F.col("original_count") > 0) & (F.col("retagged_count") >= F.col("original_count")),
        )
    )
    report = _kept(report)
    done = report.filter("deleted").select(F.col("old_id").alias("segment_id"))
    drop_segments(spark, path, done)
    return report


def write_fcd_obs(obs: DataFrame, path: str, only_new: bool = False) -> None:
    columns = ["segment_id", "time", *schemas.OBS_FIELDS, "source_file", "position"]
    write_series(obs.select(*columns), path, schemas.OBS_FIELDS, only_new)


def write_validation(rows: DataFrame, path: str) -> None:
    write_series(rows, path, ["fcd", "running_mean", "segment_closure_status"])


def read_series(
    spark: SparkSession, path: str, segments: list[str] | None = None
) -> DataFrame:
    """The stored series; with a list of ids only their buckets are read."""
    rows = spark.read.parquet(path)
    if segments:
        rows = rows.filter(
            F.col("bucket").isin([bucket_of(F.lit(s)) for s in segments])
            & F.col("segment_id").isin(segments)
        )
    return rows.drop("bucket")
