"""Exports: JSON map entries, GeoJSON features, CSV."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow.operators.series import downsample_last, series_slice


def line_geometry(coords: Column) -> Column:
    pair = lambda p: F.array(p["lon"], p["lat"])
    return F.struct(F.lit("LineString").alias("type"), F.transform(coords, pair).alias("coordinates"))


def polygon_geometry(polygons: Column) -> Column:
    pair = lambda p: F.array(p["lon"], p["lat"])
    rings = lambda poly: F.transform(poly, lambda ring: F.transform(ring, pair))
    return F.struct(
        F.lit("MultiPolygon").alias("type"), F.transform(polygons, rings).alias("coordinates")
    )


def map_entries(segments: DataFrame) -> DataFrame:
    """One JSON line ``{"segmentId": {"<id>": {"geometry": ...}}}`` per segment.

    Every line is a whole document of the map form; a reader merges as many as it needs, so no
    task has to hold the map.
    """
    entry = F.struct(line_geometry(F.col("coords")).alias("geometry"))
    keyed = F.create_map(F.col("segment_id"), entry)
    return segments.select(F.to_json(F.struct(keyed.alias("segmentId"))).alias("value"))


def collision_entries(nested: DataFrame) -> DataFrame:
    """Map-form lines of segments with their collisions, one line per segment."""
    entry = F.struct(
        line_geometry(F.col("coords")).alias("geometry"),
        F.transform("detailed_collisions", _collision).alias("detailedCollisions"),
    )
    keyed = F.create_map(F.col("segment_id"), entry)
    return nested.select(F.to_json(F.struct(keyed.alias("segmentId"))).alias("value"))


def geojson_features(rows: DataFrame, geometry: Column, properties: list[str]) -> DataFrame:
    """One RFC 7946 Feature per row; the id and every named column become properties, no ``crs``."""
    props = F.struct("segment_id", *properties)
    feature = F.struct(
        F.lit("Feature").alias("type"), geometry.alias("geometry"), props.alias("properties")
    )
    return rows.select(
        "segment_id", F.to_json(feature, {"ignoreNullFields": "false"}).alias("value")
    )


def segment_features(segments: DataFrame) -> DataFrame:
    return geojson_features(segments, line_geometry(F.col("coords")), [])


def collision_features(nested: DataFrame) -> DataFrame:
    return geojson_features(
        nested.withColumnRenamed("detailed_collisions", "detailedCollisions"),
        line_geometry(F.col("coords")),
        ["detailedCollisions"],
    )


def document_lines(rows: DataFrame, keys: list[str], head: str, tail: str) -> DataFrame:
    """Values of ``rows`` as the lines of one JSON document, in key order.

    The first key opens the document, the last one closes it, all others end in a comma. The
    rows are range partitioned: the part files, put together in name order, are the document,
    though no task ever holds it. Keys must be unique. Without rows it is the empty document.
    """
    key = F.struct(*keys)
    # One pass finds both ends and whether there are rows; the subquery is run once.
    ends = rows.agg(F.struct(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("n"))).scalar()
    opening = F.when(key == ends["first"], head).otherwise("")
    closing = F.when(key == ends["last"], tail).otherwise(",")
    lines = rows.orderBy(*keys).select(F.concat(opening, "value", closing).alias("value"))
    empty = rows.sparkSession.range(1).filter(ends["n"] == 0).select(F.lit(head + tail).alias("value"))
    return lines.unionByName(empty)


def feature_collection(features: DataFrame, keys: list[str]) -> DataFrame:
    """RFC 7946 FeatureCollection of feature rows that also carry their keys."""
    return document_lines(features, keys, '{"type":"FeatureCollection","features":[', "]}")


def map_document(segments: DataFrame) -> DataFrame:
    """The whole map form ``{"segmentId": {id: {"geometry": ...}, ...}}`` as one document."""
    geometry = F.to_json(F.struct(line_geometry(F.col("coords")).alias("geometry")))
    value = F.concat(_json_name(F.col("segment_id")), F.lit(":"), geometry)
    rows = segments.select("segment_id", value.alias("value"))
    return document_lines(rows, ["segment_id"], '{"segmentId":{', "}}")


def collision_document(flat: DataFrame) -> DataFrame:
    """The map form with collisions, from flat rows: a line per collision, a segment's in one list.

    Each segment's first and last disturbance are found by aggregation, so no task holds a
    segment's list.
    """
    ends = flat.groupBy("segment_id").agg(
        F.min("disturbance_id").alias("_first"), F.max("disturbance_id").alias("_last")
    )
    rows = flat.join(ends, "segment_id")
    opening = F.concat(
        _json_name(F.col("segment_id")),
        F.lit(':{"geometry":'),
        F.to_json(line_geometry(F.col("coords"))),
        F.lit(',"detailedCollisions":['),
    )
    item = F.to_json(F.struct("properties", polygon_geometry(F.col("polygons")).alias("geometry")))
    start, end = (F.col("disturbance_id") == F.col(c) for c in ("_first", "_last"))
    value = F.concat(F.when(start, opening).otherwise(""), item, F.when(end, "]}").otherwise(""))
    rows = rows.select("segment_id", "disturbance_id", value.alias("value"))
    return document_lines(rows, ["segment_id", "disturbance_id"], '{"segmentId":{', "}}")


def _without_brackets(text: Column) -> Column:
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _json_name(text: Column) -> Column:
    """A text as a quoted and escaped JSON name."""
    return _without_brackets(F.to_json(F.array(text)))


def _collision(c: Column) -> Column:
    return F.struct(
        c["properties"].alias("properties"), polygon_geometry(c["polygons"]).alias("geometry")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """JSON lines / GeoJSON text sequence, written in parallel."""
    lines.select("value").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, append: bool = False) -> bool:
    """``;``-separated with header; an empty frame is refused and leaves the target alone."""
    if df.isEmpty():
        return False
    writer = df.write.mode("append" if append else "overwrite")
    writer.option("sep", ";").option("header", True).csv(path)
    return True


def series_to_csv_rows(
    obs: DataFrame,
    segments: list[str] | None,
    fields: list[str],
    start: datetime | None = None,
    stop: datetime | None = None,
    minutes: int | None = None,
    tie: str | None = None,
) -> DataFrame:
    """A range of segments' series, downsampled if asked, one column per field."""
    rows = series_slice(obs, segments, start, stop)
    if minutes:
        rows = downsample_last(rows, fields, minutes, tie=tie)
    return rows.select("segment_id", "time", *fields)
