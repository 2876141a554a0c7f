"""Landed snapshot files: selection by name time, tolerant reading, first and latest file."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow import schemas
from roadflow.functions import scalars as S

BAD = "_bad"


def _check_range(start: datetime | None, end: datetime | None) -> None:
    if start is not None and end is not None and start > end:
        raise ValueError("start must not be after end")


def files_in_range(
    files: DataFrame, start: datetime | None, end: datetime | None, day_column: str = "dt"
) -> DataFrame:
    """Files whose name time lies in ``[start, end]``; a day partition column is pruned first."""
    _check_range(start, end)
    out = files
    if day_column in files.columns:
        if start is not None:
            out = out.filter(F.col(day_column) >= F.lit(str(start.date())).cast("date"))
        if end is not None:
            out = out.filter(F.col(day_column) <= F.lit(str(end.date())).cast("date"))
    if start is not None:
        out = out.filter(F.col("file_time") >= F.lit(start))
    if end is not None:
        out = out.filter(F.col("file_time") <= F.lit(end))
    return out


def reject_reason() -> Column:
    """Why a file gives no rows; null for a good one. Bad parts inside a good list do not count."""
    no_list = F.col("detailedSegments").isNull()
    broken = F.col(BAD).isNotNull() & F.get_json_object(F.col(BAD), "$").isNull()
    return (
        F.when(no_list & broken, "malformed_json")
        .when(F.col("file_time").isNull(), "no_timestamp")
        .when(no_list, "segments_not_a_list")
    )


def parse_snapshot_text(documents: DataFrame) -> DataFrame:
    """Snapshots from ``file_name, document`` rows holding the JSON text of one file each."""
    schema = f"{schemas.SNAPSHOT}, {BAD} string"
    parsed = F.from_json(
        "document", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    )
    rows = S.once(
        documents, _doc=parsed, file_time=S.time_from_file_name(F.col("file_name"))
    ).select("*", "_doc.*")
    return S.once(rows, reason=reject_reason()).drop("_doc", "document", BAD)


def landing_prefixes(start: datetime, end: datetime) -> list[str]:
    """Beginnings of the stamps in ``[start, end]``: whole years and months where they fit, else days."""
    _check_range(start, end)
    out, day, last = [], start.date(), end.date()
    while day <= last:
        month = (day.replace(day=28) + timedelta(days=4)).replace(day=1)
        year = day.replace(year=day.year + 1, month=1, day=1) if day.year < 9999 else last + timedelta(days=1)
        if (day.month, day.day) == (1, 1) and year - timedelta(days=1) <= last:
            out, day = [*out, f"{day:%Y-}"], year
        elif day.day == 1 and month - timedelta(days=1) <= last:
            out, day = [*out, f"{day:%Y-%m-}"], month
        else:
            out, day = [*out, f"{day:%Y-%m-%d}"], day + timedelta(days=1)
    return out


def landing_paths(
    spark: SparkSession, path: str, start: datetime, end: datetime, folders: list[str] | None = None
) -> list[str]:
    """What a landing zone holds of a range: stamped files and folders by prefix, nothing else listed below.

    A stamp begins a name, or follows ``=`` as in ``day=2024-01-05``. Stamped names lie in ``path`` itself
    or in one of its folders; ``folders`` names these, by default all. Paths come back as patterns,
    one for each prefix that has a match; only where a stamped folder holds stamped files as well
    are paths named one by one, so that none comes twice.
    """
    where = [path.rstrip("/")] + [f"{path.rstrip('/')}/{f}" for f in (folders if folders is not None else ["*"])]
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found, whole = [], set()
    for base in where:
        for prefix in landing_prefixes(start, end):
            for pattern in (f"{base}/{prefix}*", f"{base}/*={prefix}*"):
                matches = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(pattern))
                paths = [(m.getPath().toString(), m.getPath().getParent().toString()) for m in matches or []]
                new = [p for p, parent in paths if parent not in whole]
                found += [pattern] if len(new) == len(paths) and new else new
                whole.update(p for p, _ in paths)
    return found


def _source(spark_reader, path: str | list[str], one_per_file: bool):
    return (
        spark_reader.schema(f"{schemas.SNAPSHOT}, {BAD} string")
        .option("multiLine", one_per_file)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def shape_files(raw: DataFrame) -> DataFrame:
    """File columns; the time stands in the file's name or, for compacted files, its folder's."""
    folder = F.element_at(F.split("file_path", "/"), -2)
    stamped = F.coalesce(S.time_from_file_name(F.col("file_name")), S.time_from_file_name(folder))
    return (
        raw.withColumn("file_path", F.col("_metadata.file_path"))
        .withColumn("file_name", F.col("_metadata.file_name"))
        .withColumn("modified_at", F.col("_metadata.file_modification_time"))
        .withColumn("file_time", stamped)
        .withColumn("reason", reject_reason())
        .drop(BAD)
    )


def read_fcd_snapshots(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    one_per_file: bool = True,
    folders: list[str] | None = None,
) -> DataFrame:
    """One row per landed document. Unusable ones stay as rows with a ``reason``.

    With ``one_per_file=False`` a file holds one document per line (a compacted landing zone). With
    both ends of a range only the days in it are listed (``landing_paths``); within them, and for
    half-open ranges, the time in the path decides, from file metadata alone.
    """
    _check_range(start, end)
    if start is None or end is None:
        return files_in_range(shape_files(_source(spark.read, path, one_per_file)), start, end)
    paths = landing_paths(spark, path, start, end, folders)
    if not paths:
        return shape_files(_source(spark.read, path, one_per_file)).limit(0)
    return files_in_range(shape_files(_source(spark.read, paths, one_per_file)), start, end)


def stream_fcd_snapshots(
    spark: SparkSession, path: str, files_per_batch: int = 50, one_per_file: bool = True
) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return shape_files(_source(reader, path, one_per_file))


def split_good(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good files, and the quarantine of unusable ones with their reasons."""
    good = files.filter(F.col("reason").isNull()).drop("reason")
    return good, files.filter(F.col("reason").isNotNull()).drop("detailedSegments")


def first_and_latest_file(files: DataFrame) -> DataFrame:
    """Per source folder the first and the latest file by modification time (ties by path)."""
    folder = F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1)
    age = F.struct("modified_at", "file_path")
    return files.groupBy(folder.alias("folder")).agg(
        F.min_by("file_path", age).alias("first_file"),
        F.max_by("file_path", age).alias("latest_file"),
        F.count("*").alias("files"),
    )
