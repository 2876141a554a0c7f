"""Snapshots to observations, duplicate rule, document checks and the ingest report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow import schemas
from roadflow.functions import scalars as S

# Pattern of a coordinate list made of pairs of real numbers.
REAL = r"-?\d+(?:\.\d+(?:[eE][+-]?\d+)?|[eE][+-]?\d+)"
PAIR = rf"\[\s*{REAL}\s*,\s*{REAL}\s*\]"
PAIRS = rf"^\s*\[\s*(?:{PAIR}(?:\s*,\s*{PAIR})*)?\s*\]\s*$"


def snapshots_to_obs(snapshots: DataFrame) -> DataFrame:
    """One row per segment entry of each good snapshot; entries without any id are dropped."""
    entry = F.col("_entry")
    points = F.filter(
        entry["shape"], lambda p: p["longitude"].isNotNull() & p["latitude"].isNotNull()
    )
    coords = F.transform(
        points, lambda p: F.struct(p["longitude"].alias("lon"), p["latitude"].alias("lat"))
    )
    return (
        snapshots.select(
            F.col("file_time").alias("time"),
            F.col("file_name").alias("source_file"),
            F.posexplode("detailedSegments").alias("position", "_entry"),
        )
        .select(
            F.coalesce(entry["segmentIdStr"], entry["segmentId"]).alias("segment_id"),
            "time",
            S.confidence_to_fcd(entry["confidence"]).alias("fcd_coverage"),
            entry["averageSpeed"].alias("average_speed"),
            entry["typicalSpeed"].alias("typical_speed"),
            entry["currentSpeed"].alias("current_speed"),
            entry["confidence"].cast("int").alias("confidence_level"),
            F.coalesce(coords, F.from_json(F.lit("[]"), schemas.COORDS)).alias("coords"),
            "source_file",
            "position",
        )
        .filter(F.col("segment_id").isNotNull())
    )


def entry_rejects(snapshots: DataFrame) -> DataFrame:
    """Entries that ``snapshots_to_obs`` drops, and those that lose points: ``source_file, position, reason``."""
    entry = F.col("_entry")
    bad = F.exists(entry["shape"], lambda p: p["longitude"].isNull() | p["latitude"].isNull())
    nameless = entry["segmentIdStr"].isNull() & entry["segmentId"].isNull()
    reason = F.when(nameless, "no_segment_id").when(F.coalesce(bad, F.lit(False)), "points_without_coordinates")
    rows = snapshots.select(
        F.col("file_name").alias("source_file"), F.posexplode("detailedSegments").alias("position", "_entry")
    )
    return rows.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_entry")


def _rank(first_file: bool, last_in_file: bool, from_base: Column) -> Column:
    """Ordering key whose minimum is the kept row: stored rows, then file, then place in file."""
    position = -F.col("position") if last_in_file else F.col("position")
    name = F.col("source_file")
    if first_file:
        return F.struct(from_base, name, position)
    # Latest file first is the maximum of the name, so flip the place in the file instead.
    return F.struct(~from_base, name, -position)


def merge_observations(
    new: DataFrame,
    base: DataFrame | None = None,
    first_file: bool = True,
    last_in_file: bool = True,
) -> DataFrame:
    """One row per (segment, time).

    Default rule: stored rows stay, then the first file by name wins, inside a file the last
    entry. Aggregation, not a ranking window: duplicates shrink before the shuffle, so a hot
    key does no harm.
    """
    rows = new.withColumn("_base", F.lit(False))
    if base is not None:
        rows = base.withColumn("_base", F.lit(False) | F.lit(True)).unionByName(
            rows, allowMissingColumns=True
        )
    values = [c for c in rows.columns if c not in ("segment_id", "time", "_base")]
    pick = F.min_by if first_file else F.max_by
    kept = pick(F.struct(*values), _rank(first_file, last_in_file, ~F.col("_base")))
    return rows.groupBy("segment_id", "time").agg(kept.alias("_kept")).select(
        "segment_id", "time", "_kept.*"
    )


def merge_report(new: DataFrame) -> DataFrame:
    """Records scanned and records that are new keys, in one row."""
    per_key = new.groupBy("segment_id", "time").agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records_scanned"),
        F.count("*").alias("records_new"),
    )


def ingest_report(files: DataFrame) -> DataFrame:
    """Files by status, with the segment entries they hold."""
    return files.groupBy(F.coalesce("reason", F.lit("ok")).alias("status")).agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum(F.size("detailedSegments")), F.lit(0)).cast("bigint").alias("entries"),
    )


def segment_geometries(obs: DataFrame, first_file: bool = True) -> DataFrame:
    """Segment to line; entries without a geometry do not count, first file wins."""
    pick = F.min_by if first_file else F.max_by
    position = -F.col("position") if first_file else F.col("position")
    return (
        obs.filter(F.col("coords").isNotNull())
        .groupBy("segment_id")
        .agg(pick("coords", F.struct("source_file", position)).alias("coords"))
    )


def segment_map(geometries: DataFrame, updated_at: Column) -> DataFrame:
    """Current map with hash and bounding box."""
    return geometries.select(
        "segment_id",
        "coords",
        S.geometry_hash(F.col("coords")).alias("geometry_hash"),
        S.bbox(F.col("coords")).alias("bbox"),
        updated_at.alias("updated_at"),
    )


def sort_series(obs: DataFrame) -> DataFrame:
    """Observations in time order inside each segment; range partitioned, no single task."""
    return obs.orderBy("segment_id", "time")


def check_documents(documents: DataFrame) -> DataFrame:
    """Add ``violations``: the broken rules of each nested series document, entry by entry.

    Input rows are ``source_file, document`` with the JSON text of one document. A document is
    one row, so its entries are checked in place: nothing is shuffled or joined.
    """
    top = F.from_json("document", "segmentId map<string,string>")["segmentId"]
    rows = S.once(documents, _map=top)
    parts = F.transform(
        F.map_entries("_map"),
        lambda e: F.struct(
            e["key"].alias("key"),
            e["value"].alias("value"),
            F.from_json(e["value"], "geometry string, detailedSegment string").alias("v"),
        ),
    )
    rows = S.once(rows, _parts=parts)
    parsed = F.transform(
        "_parts",
        lambda p: F.struct(
            p["key"].alias("key"),
            p["value"].alias("value"),
            p["v"]["geometry"].alias("geometry"),
            p["v"]["detailedSegment"].alias("detail"),
            F.from_json(p["v"]["geometry"], "type string, coordinates string").alias("g"),
            F.get_json_object(p["v"]["detailedSegment"], "$.date").alias("date"),
        ),
    )
    rows = S.once(rows, _parsed=parsed)
    is_object = lambda c: F.ltrim(c).startswith("{")
    broken = lambda ok: ~F.coalesce(ok, F.lit(False))

    def rule(p: Column) -> Column:
        return (
            F.when(broken(p["key"].rlike(r"^\d+$")), "id_not_digits")
            .when(broken(is_object(p["value"])), "entry_not_object")
            .when(p["geometry"].isNull() | p["detail"].isNull(), "keys_missing")
            .when(broken(is_object(p["geometry"])), "geometry_not_object")
            .when(broken(p["g"]["type"] == "LineString"), "not_a_line")
            .when(broken(p["g"]["coordinates"].rlike(PAIRS)), "bad_coordinates")
            .when(
                broken(is_object(p["detail"])) | p["detail"].rlike(r"^\s*\{\s*\}\s*$"),
                "detail_not_object",
            )
            .when(broken(is_object(p["date"])), "date_not_object")
        )

    ruled = F.transform(
        "_parsed", lambda p: F.struct(p["key"].alias("segment_key"), rule(p).alias("rule"))
    )
    no_map = F.array(
        F.struct(F.lit(None).cast("string").alias("segment_key"), F.lit("no_segments").alias("rule"))
    )
    found = F.when(F.col("_map").isNull(), no_map).otherwise(
        F.filter(ruled, lambda r: r["rule"].isNotNull())
    )
    return S.once(rows, violations=found).drop("_map", "_parts", "_parsed")


def document_violations(documents: DataFrame) -> DataFrame:
    """Rows ``source_file, segment_key, rule`` for each broken rule."""
    checked = check_documents(documents)
    return checked.select("source_file", F.explode("violations").alias("_v")).select(
        "source_file", "_v.*"
    )


def valid_obs_documents(documents: DataFrame) -> DataFrame:
    """Whole documents without any violation: one bad entry refuses its document."""
    return check_documents(documents).filter(F.size("violations") == 0).drop("violations")


def rows_from_document(documents: DataFrame) -> DataFrame:
    """The nested map form (segment to geometry and dated properties) as flat rows."""
    doc = (
        "segmentId map<string, struct<geometry: struct<type: string, "
        "coordinates: array<array<double>>>, detailedSegment: struct<date: "
        "map<string, struct<properties: map<string, string>>>>>>"
    )
    entry = F.col("_entry")
    return (
        documents.select(
            "source_file",
            F.explode_outer(F.from_json("document", doc)["segmentId"]).alias("segment_id", "_entry"),
        )
        .filter(F.col("segment_id").isNotNull())
        .select(
            "source_file",
            "segment_id",
            F.transform(
                entry["geometry"]["coordinates"],
                lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")),
            ).alias("coords"),
            F.explode(entry["detailedSegment"]["date"]).alias("_time", "_p"),
        )
        .select(
            "source_file",
            "segment_id",
            S.iso_to_timestamp(F.col("_time")).alias("time"),
            F.col("_p.properties").alias("properties"),
            "coords",
        )
    )


def document_from_rows(obs: DataFrame) -> DataFrame:
    """Flat rows back to one nested JSON entry per (segment, day): bounded by the samples of a day."""
    point = F.struct(
        F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss").alias("key"),
        F.struct(
            F.struct(
                F.col("fcd_coverage"),
                F.col("average_speed").alias("averageSpeed"),
                F.col("typical_speed").alias("typicalSpeed"),
                F.col("current_speed").alias("currentSpeed"),
                F.col("confidence_level"),
            ).alias("properties")
        ).alias("value"),
    )
    dates = F.map_from_entries(F.array_sort(F.collect_list(point)))
    return obs.groupBy("segment_id", F.to_date("time").alias("day")).agg(
        F.to_json(F.struct(F.struct(dates.alias("date")).alias("detailedSegment"))).alias("entry")
    )
