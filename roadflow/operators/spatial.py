"""Spatial joins on a metric grid: disturbances against segments, new against old segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadflow import config as cfg
from roadflow.functions import geometry as G
from roadflow.functions import scalars as S


def same_geometry_key(coords: Column) -> Column:
    return F.sha2(F.to_json(coords), 256)


def _widened(rows: DataFrame, half: float) -> DataFrame:
    """Adds edges, joints and box of the lines in ``coords``; lines without an edge go."""
    points = F.col("_points")
    rows = S.once(rows, _points=G.project(F.col("coords")))
    rows = S.once(rows, edges=G.edges(points), _closed=G.is_closed(points), box=G.plane_bbox(points, half))
    rows = S.once(rows, joints=G.joints(F.col("edges"), F.col("_closed")))
    return rows.drop("_points", "_closed").filter(F.size("edges") > 0)


def widen_segments(segments: DataFrame, half: float = cfg.DISTURBANCE_BUFFER) -> DataFrame:
    """Keep the line and add what its flat-ended buffer consists of: edges, joints, box."""
    return _widened(segments, half)


def _placed(boxes: DataFrame, cell: float) -> DataFrame:
    """A row for every grid cell under a box, at the box's own level and at all coarser ones."""
    levels = F.explode(F.sequence("_own", F.lit(G.LEVELS - 1))).alias("_level")
    rows = boxes.withColumn("_own", G.box_level(F.col("box"), cell)).select("*", levels)
    rows = rows.withColumn("_cell", F.explode(G.box_cells(F.col("box"), F.col("_level"), cell)))
    return rows.select("id", "box", "_own", "_level", F.col("_cell.cx").alias("_cx"), F.col("_cell.cy").alias("_cy"))


def _in_blocks(a: DataFrame, b: DataFrame, keys: list[str], crowded: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with block numbers as further keys: a cell's rows in blocks of ``crowded`` a side.

    Every row of one side still meets every row of the other once. Cells with fewer rows on both
    sides have one block; the others are fewer than the rows divided by ``crowded``.
    """
    sides = [r.groupBy(*keys).agg(F.ceil(F.count("*") / crowded).cast("int").alias(n)) for r, n in ((a, "_m"), (b, "_n"))]
    cells = F.broadcast(sides[0].join(sides[1], keys).filter("_m > 1 or _n > 1"))
    one, last = F.lit(1), lambda n: F.coalesce(n, F.lit(1)) - 1
    own = lambda c, n: F.pmod(F.xxhash64(c), F.coalesce(n, one)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), last(F.col(n))))
    a = a.join(cells, keys, "left").withColumn("_i", own("left_id", F.col("_m"))).withColumn("_j", every("_n"))
    b = b.join(cells, keys, "left").withColumn("_j", own("right_id", F.col("_n"))).withColumn("_i", every("_m"))
    return a.drop("_m", "_n"), b.drop("_m", "_n"), [*keys, "_i", "_j"]


def box_pairs(left: DataFrame, right: DataFrame, cell: float, crowded: int | None = None) -> DataFrame:
    """(left_id, right_id) of boxes that meet; both sides hold ``id, box``.

    Two boxes are compared at the level of the larger one, and a pair is reported by the one cell
    that holds the lower corner of its overlap, so no distinct follows. Rows carry a box only,
    never a geometry or a list of cells. Cells whose rows are many bytes are split by the adaptive
    executor; a dense place has few bytes but many pairs, so with ``crowded`` cells are cut into
    blocks of so many boxes a side, which costs a count over the cells first.
    """
    a = _placed(left, cell).toDF("left_id", "_a", "_own_a", "_level", "_cx", "_cy")
    b = _placed(right, cell).toDF("right_id", "_b", "_own_b", "_level", "_cx", "_cy")
    keys = ["_level", "_cx", "_cy"]
    size = G.cell_size(F.col("_level"), cell)
    corner = lambda c: F.floor(F.greatest(F.col(f"_a.{c}"), F.col(f"_b.{c}")) / size)
    if crowded is not None:
        a, b, keys = _in_blocks(a, b, keys, crowded)
    own_a, own_b = F.col("_own_a") == F.col("_level"), F.col("_own_b") == F.col("_level")
    met = a.filter(own_a).join(b, keys).unionByName(a.filter(~own_a).join(b.filter(own_b), keys))
    here = (corner("x0") == F.col("_cx")) & (corner("y0") == F.col("_cy"))
    return met.filter(G.boxes_meet(F.col("_a"), F.col("_b")) & here).select("left_id", "right_id")


def restore_geometry(segments: DataFrame) -> DataFrame:
    """The original line is still there; only the helper columns go."""
    return segments.drop("edges", "joints", "box")


def segments_hit_by(
    segments: DataFrame,
    disturbances: DataFrame,
    half: float = cfg.DISTURBANCE_BUFFER,
    cell: float = cfg.DISTURBANCE_CELL,
    crowded: int | None = None,
) -> DataFrame:
    """Pairs (segment, disturbance) where the widened segment touches the polygons.

    Boxes are joined on grid cells first; geometries meet only for pairs whose boxes do. ``crowded``
    as in ``box_pairs``.
    """
    left = widen_segments(segments.select("segment_id", "coords"), half)
    rings = F.transform("polygons", lambda polygon: F.transform(polygon, lambda ring: G.project(ring)))
    right = disturbances.select("disturbance_id", "polygons").filter(F.size("polygons") > 0)
    right = S.once(right, _plane=rings)
    right = S.once(
        right,
        _dbox=G.plane_bbox(F.flatten(F.flatten("_plane"))),
        _rings=G.polygon_edges(F.col("_plane")),
    ).drop("_plane", "polygons")
    pairs = box_pairs(
        left.select(F.col("segment_id").alias("id"), "box"),
        right.select(F.col("disturbance_id").alias("id"), F.col("_dbox").alias("box")).filter("box.x0 is not null"),
        cell,
        crowded,
    ).toDF("segment_id", "disturbance_id")
    near = pairs.distinct().join(left.drop("box"), "segment_id").join(right.drop("_dbox"), "disturbance_id")
    hit = G.line_hits_polygon(F.col("edges"), F.col("joints"), F.col("_rings"), half)
    return S.once(near, hit=hit).filter("hit").select("segment_id", "coords", "disturbance_id")


def _lines(rows: DataFrame, half: float) -> DataFrame:
    """Distinct geometries with edges, joints and box."""
    lines = rows.groupBy(same_geometry_key(F.col("coords")).alias("id")).agg(
        F.any_value("coords").alias("coords")
    )
    return _widened(lines, half).drop("coords")


def matching_geometries(
    new: DataFrame,
    old: DataFrame,
    threshold: float = cfg.REPLACEMENT_THRESHOLD,
    half: float = cfg.REPLACEMENT_BUFFER,
    cell: float = cfg.REPLACEMENT_CELL,
    crowded: int | None = None,
) -> DataFrame:
    """Pairs of distinct geometries ``new_key, old_key, score`` at or above the threshold.

    Copies of a geometry are folded first, so they never meet each other pair by pair. The
    score is the smaller of both shares of length inside the other line's buffer.
    """
    a, b = _lines(new, half), _lines(old, half)
    pairs = box_pairs(a.select("id", "box"), b.select("id", "box"), cell, crowded).toDF("new_key", "old_key")
    near = pairs.join(a.select(F.col("id").alias("new_key"), F.col("edges").alias("new_edges"), F.col("joints").alias("new_joints")), "new_key")
    near = near.join(b.select(F.col("id").alias("old_key"), F.col("edges").alias("old_edges"), F.col("joints").alias("old_joints")), "old_key")
    score = F.least(
        G.covered_share(F.col("new_edges"), F.col("old_edges"), F.col("old_joints"), half),
        G.covered_share(F.col("old_edges"), F.col("new_edges"), F.col("new_joints"), half),
    )
    return (
        S.once(near, score=score)
        .filter(F.col("score") >= threshold - cfg.SCORE_TOLERANCE)
        .select("new_key", "old_key", "score")
    )


def _ranked_score() -> Column:
    """Scores that differ by rounding noise only count as equal."""
    return F.round("score", 9)


def match_replacements(
    new: DataFrame,
    old: DataFrame,
    threshold: float = cfg.REPLACEMENT_THRESHOLD,
    half: float = cfg.REPLACEMENT_BUFFER,
    cell: float = cfg.REPLACEMENT_CELL,
) -> DataFrame:
    """For each new segment the best old one: ``new_id, old_id, score``; ties to the smaller id.

    A segment never replaces itself. For that two candidates are kept per geometry: one of
    them has another id. Both ranking windows are cut to two rows before their shuffle.
    """
    new_rows = new.filter(F.col("coords").isNotNull()).select(
        F.col("segment_id").alias("new_id"), "coords", same_geometry_key(F.col("coords")).alias("new_key")
    )
    old_rows = old.filter(F.col("coords").isNotNull()).select(
        F.col("segment_id").alias("old_id"), "coords", same_geometry_key(F.col("coords")).alias("old_key")
    )
    pairs = matching_geometries(new_rows, old_rows, threshold, half, cell)
    by_id = W.partitionBy("old_key").orderBy("old_id")
    two_ids = (
        old_rows.select("old_key", "old_id")
        .withColumn("_rank", F.row_number().over(by_id))
        .filter(F.col("_rank") <= 2)
        .drop("_rank")
    )
    by_score = W.partitionBy("new_key").orderBy(_ranked_score().desc(), "old_id")
    two_best = (
        pairs.join(two_ids, "old_key")
        .withColumn("_rank", F.row_number().over(by_score))
        .filter(F.col("_rank") <= 2)
        .select("new_key", "old_id", "score", "_rank")
    )
    return (
        new_rows.select("new_id", "new_key")
        .join(two_best, "new_key")
        .filter(F.col("old_id") != F.col("new_id"))
        .groupBy("new_id")
        .agg(F.min_by(F.struct("old_id", "score"), "_rank").alias("_best"))
        .select("new_id", "_best.*")
    )


def replacement_gap_candidates(
    changelog: DataFrame, archive: DataFrame, threshold: float = cfg.REPLACEMENT_THRESHOLD
) -> DataFrame:
    """Best archived match older than each new segment that has not inherited yet.

    Output: ``new_id, date_added, old_id, date_archived, score``. Who is "the oldest usable
    archive row" is an as-of question per geometry pair: archive rows and new rows are put in
    one time line of distinct instants, never joined pair by pair.
    """
    new_rows = changelog.filter(
        F.col("coords").isNotNull() & F.col("date_added").isNotNull() & F.col("geo_inherited_from").isNull()
    ).select(
        F.col("segment_id").alias("new_id"),
        "date_added",
        "coords",
        same_geometry_key(F.col("coords")).alias("new_key"),
    )
    old_rows = archive.filter(
        F.col("coords").isNotNull() & F.col("date_archived").isNotNull()
    ).select(
        F.col("segment_id").alias("old_id"),
        "date_archived",
        "coords",
        same_geometry_key(F.col("coords")).alias("old_key"),
    )
    pairs = matching_geometries(new_rows, old_rows, threshold)
    instants_old = old_rows.groupBy("old_key", F.col("date_archived").alias("at")).agg(
        F.min("old_id").alias("old_id")
    )
    instants_new = new_rows.select("new_key", F.col("date_added").alias("at")).distinct()
    line = ["new_key", "old_key", "score", "at", "old_id"]
    offers = pairs.join(instants_old, "old_key").select(*line)
    asks = pairs.join(instants_new, "new_key").withColumn("old_id", F.lit(None).cast("string"))
    by_time = (
        W.partitionBy("new_key", "old_key").orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    offer = F.when(F.col("old_id").isNotNull(), F.struct("old_id", F.col("at").alias("date_archived")))
    answered = (
        offers.withColumn("_ask", F.lit(False))
        .unionByName(asks.select(*line).withColumn("_ask", F.lit(True)))
        .withColumn("_best", F.min(offer).over(by_time))
        .filter(F.col("_ask") & F.col("_best").isNotNull())
    )
    best = F.min_by(F.struct("_best.old_id", "_best.date_archived", "score"), F.struct(-_ranked_score(), "_best.old_id"))
    chosen = answered.groupBy("new_key", F.col("at").alias("date_added")).agg(best.alias("_b"))
    return (
        new_rows.select("new_id", "new_key", "date_added")
        .join(chosen, ["new_key", "date_added"])
        .select("new_id", "date_added", "_b.*")
    )


def replacement_gap_histogram(candidates: DataFrame) -> DataFrame:
    """Matches per gap class, and each class's share of all matches."""
    seconds = F.greatest(
        (F.unix_micros("date_added") - F.unix_micros("date_archived")) / F.lit(1e6), F.lit(0.0)
    )
    per_class = candidates.groupBy(S.gap_class(seconds).alias("gap_class")).agg(
        F.count("*").alias("matches")
    )
    # At most six rows: this window is over the classes, not over the data.
    total = F.sum("matches").over(W.partitionBy(F.lit(1)))
    return per_class.withColumn("share", F.col("matches") / total)


def gap_summary(candidates: DataFrame) -> DataFrame:
    """Matched pairs, cross-cycle pairs (gap over a minute) and their share."""
    seconds = (F.unix_micros("date_added") - F.unix_micros("date_archived")) / F.lit(1e6)
    cross = F.count_if(seconds > cfg.GAP_CLASSES[0][1])
    return candidates.agg(F.count("*").alias("matched"), cross.alias("cross_cycle")).withColumn(
        "cross_share", F.col("cross_cycle") / F.nullif("matched", F.lit(0))
    )


def gap_totals(changelog: DataFrame, candidates: DataFrame) -> DataFrame:
    """What the gap report is a part of: scanned, already inherited, matched and orphan segments.

    ``cross_share`` is the share of cross-cycle matches among all segments that have not
    inherited yet.
    """
    inherited = F.count_if(F.col("geo_inherited_from").isNotNull())
    out = gap_summary(candidates).withColumn("scanned", changelog.agg(F.count("*")).scalar())
    out = out.withColumn("already_inherited", changelog.agg(inherited).scalar())
    new = F.col("scanned") - F.col("already_inherited")
    return out.withColumn("orphan", new - F.col("matched")).withColumn(
        "cross_share", F.col("cross_cycle") / F.nullif(new, F.lit(0))
    )
