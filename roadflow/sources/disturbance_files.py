"""Landed GeoJSON layers of roadwork reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow import config as cfg
from roadflow import schemas
from roadflow.functions import scalars as S

# Report property name, our column.
PROPERTIES = [
    ("id", "disturbance_id"),
    ("hakemus", "type"),
    ("hakemustunnus", "application_id"),
    ("tyo_alkaa", "start_text"),
    ("tyo_paattyy", "end_text"),
    ("osoite", "address"),
    ("kaupunginosa", "district"),
]


def _polygons(kind: Column, coordinates: Column) -> Column:
    polygon = "array<array<array<double>>>"
    raw = F.when(
        kind == "Polygon", F.array(F.from_json(coordinates, polygon))
    ).when(kind == "MultiPolygon", F.from_json(coordinates, f"array<{polygon}>"))
    point = lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))
    return F.transform(raw, lambda poly: F.transform(poly, lambda ring: F.transform(ring, point)))


def features_to_disturbances(features: DataFrame) -> DataFrame:
    """Rows ``layer, feature`` (struct) to reports with a ``reason`` for unusable ones."""
    f = F.col("feature")
    props = f["properties"]
    columns = [props[name].alias(column) for name, column in PROPERTIES]
    polygons = _polygons(f["geometry"]["type"], f["geometry"]["coordinates"])
    reason = (
        F.when(F.col("feature").isNull(), "not_an_object")
        .when(f["geometry"].isNull(), "no_geometry")
        .when(F.col("polygons").isNull() | (F.size("polygons") == 0), "bad_geometry")
    )
    parsed = S.once(features, polygons=polygons)
    return (
        S.once(parsed, reason=reason)
        .select("layer", f["id"].alias("feature_id"), *columns, "polygons", "reason")
        .withColumn("disturbance_id", F.coalesce("disturbance_id", "feature_id"))
    )


def valid_features(reports: DataFrame) -> DataFrame:
    return reports.filter(F.col("reason").isNull()).drop("reason")


def parse_layer_text(documents: DataFrame) -> DataFrame:
    """Features from ``layer, document`` rows with the text of one FeatureCollection each.

    An unreadable or empty document gives no rows; the other layers go on.
    """
    parsed = F.from_json("document", schemas.FEATURE_COLLECTION, {"mode": "PERMISSIVE"})
    one = documents.select("layer", F.posexplode_outer(parsed["features"]).alias("_i", "feature"))
    return one.filter(F.col("_i").isNotNull()).drop("_i")


def read_disturbances(
    spark: SparkSession, layers: dict[str, str], one_per_file: bool = True
) -> DataFrame:
    """Union of the landed layers; ``layers`` maps a layer name to its folder or file."""
    if not layers:
        raise ValueError("no layers given")
    out = None
    for name, path in layers.items():
        doc = (
            spark.read.schema(schemas.FEATURE_COLLECTION)
            .option("multiLine", one_per_file)
            .option("mode", "PERMISSIVE")
            .json(path)
            .select(F.lit(name).alias("layer"), F.explode("features").alias("feature"))
        )
        out = doc if out is None else union_layers(out, doc)
    return features_to_disturbances(out)


def union_layers(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def latest_good_snapshot(
    snapshots: DataFrame, as_of: Column, max_age_hours: float = cfg.LAYER_CACHE_HOURS
) -> DataFrame:
    """Rows of each layer's newest good fetch, if it is younger than ``max_age_hours``.

    ``snapshots`` holds ``layer, fetched_at, good``. The newest instant is one number per layer.
    """
    young = snapshots.filter(
        F.col("good")
        & (F.col("fetched_at") <= as_of)
        & (F.col("fetched_at") > as_of - F.make_interval(secs=F.lit(max_age_hours * 3600)))
    )
    newest = young.groupBy("layer").agg(F.max("fetched_at").alias("fetched_at"))
    return young.join(newest, ["layer", "fetched_at"], "left_semi")
