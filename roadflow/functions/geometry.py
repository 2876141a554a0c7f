"""Planar geometry as column expressions: projection, widened lines, cells, overlap, hits.

A line widened by ``r`` with flat ends is the union of one rectangle per edge and one disc
per inner vertex, so no polygon is ever built: predicates work on edges and vertices.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values of EPSG:3879 (GRS80, transverse Mercator on 25 degrees east). ---
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
CENTRAL_MERIDIAN = 25.0
FALSE_EASTING = 25500000.0
SCALE = 1.0


def _krueger() -> tuple[float, float, tuple[float, float, float]]:
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        13 * n**2 / 48 - 3 * n**3 / 5,
        61 * n**3 / 240,
    )
    return n, radius, alpha


def to_metric(lon: Column, lat: Column) -> Column:
    """Degrees to metres in EPSG:3879 (Krueger series, three terms) as ``struct<x,y>``."""
    n, radius, alpha = _krueger()
    ecc = 2 * math.sqrt(n) / (1 + n)
    phi = F.radians(lat)
    lam = F.radians(lon - CENTRAL_MERIDIAN)
    sin_phi = F.sin(phi)
    t = F.sinh(F.atanh(sin_phi) - ecc * F.atanh(ecc * sin_phi))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    north, east = xi, eta
    for j, a in enumerate(alpha, 1):
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return F.struct(
        (FALSE_EASTING + SCALE * radius * east).alias("x"),
        (SCALE * radius * north).alias("y"),
    )


def project(coords: Column) -> Column:
    return F.transform(coords, lambda p: to_metric(p["lon"], p["lat"]))


def _edge(p: Column, q: Column) -> Column:
    length = F.sqrt((q["x"] - p["x"]) ** 2 + (q["y"] - p["y"]) ** 2)
    return F.struct(
        p["x"].alias("x"),
        p["y"].alias("y"),
        (q["x"] - p["x"]).alias("dx"),
        (q["y"] - p["y"]).alias("dy"),
        length.alias("len"),
    )


def edges(points: Column) -> Column:
    """Edges ``struct<x,y,dx,dy,len>`` of a point list, without zero-length ones."""
    n = F.size(points)
    pairs = F.arrays_zip(
        F.slice(points, 1, F.greatest(n - 1, F.lit(0))).alias("p"),
        F.slice(points, 2, F.greatest(n - 1, F.lit(0))).alias("q"),
    )
    all_edges = F.transform(pairs, lambda z: _edge(z["p"], z["q"]))
    return F.filter(all_edges, lambda e: e["len"] > 0)


def is_closed(points: Column) -> Column:
    return (F.size(points) > 3) & (F.element_at(points, 1) == F.element_at(points, -1))


def joints(edge_list: Column, closed: Column) -> Column:
    """Where a line turns: the vertex and the directions of the edges before and after it.

    Repeated points have no edge and so no joint of their own. A closed line also turns where it
    closes.
    """
    n = F.size(edge_list)

    def turn(a: Column, b: Column) -> Column:
        return F.struct(
            b["x"].alias("x"),
            b["y"].alias("y"),
            (a["dx"] / a["len"]).alias("ux"),
            (a["dy"] / a["len"]).alias("uy"),
            (b["dx"] / b["len"]).alias("vx"),
            (b["dy"] / b["len"]).alias("vy"),
        )

    pairs = F.arrays_zip(
        F.slice(edge_list, 1, F.greatest(n - 1, F.lit(0))).alias("a"),
        F.slice(edge_list, 2, F.greatest(n - 1, F.lit(0))).alias("b"),
    )
    inner = F.transform(pairs, lambda z: turn(z["a"], z["b"]))
    closing = F.when(closed & (n > 1), F.array(turn(F.element_at(edge_list, -1), F.element_at(edge_list, 1))))
    return F.concat(inner, F.coalesce(closing, F.slice(inner, 1, 0)))


def line_length(edge_list: Column) -> Column:
    return F.aggregate(edge_list, F.lit(0.0), lambda acc, e: acc + e["len"])


def plane_bbox(points: Column, margin: float = 0.0) -> Column:
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        (F.array_min(xs) - margin).alias("x0"),
        (F.array_max(xs) + margin).alias("x1"),
        (F.array_min(ys) - margin).alias("y0"),
        (F.array_max(ys) + margin).alias("y1"),
    )


def boxes_meet(a: Column, b: Column) -> Column:
    return (
        (a["x0"] <= b["x1"]) & (b["x0"] <= a["x1"]) & (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])
    )


#: Grid levels: each has cells ``LEVEL_FACTOR`` times as wide as the one before.
LEVELS, LEVEL_FACTOR = 4, 8
#: Cells on a side that a box may span at its own level (the coarsest level takes all others).
LEVEL_SPAN = 4


def box_level(box: Column, size: float) -> Column:
    """The finest grid level at which a box spans few cells."""
    extent = F.greatest(box["x1"] - box["x0"], box["y1"] - box["y0"])
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(extent <= LEVEL_SPAN * size * LEVEL_FACTOR**k, k).otherwise(level)
    return level


def cell_size(level: Column, size: float) -> Column:
    return F.lit(float(size)) * F.pow(F.lit(float(LEVEL_FACTOR)), level)


def box_cells(box: Column, level: Column, size: float) -> Column:
    """Cells ``struct<cx,cy>`` of one level under a box."""
    width = cell_size(level, size)
    along = lambda lo, hi: F.sequence(F.floor(lo / width), F.floor(hi / width))
    rows = along(box["y0"], box["y1"])
    column = lambda cx: F.transform(rows, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))
    return F.flatten(F.transform(along(box["x0"], box["x1"]), column))


def _within(a: Column, d: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """Where on ``t in [0, 1]`` the value ``a + t*d`` lies in ``[lo, hi]`` (empty if lo > hi)."""
    t1, t2 = (lo - a) / d, (hi - a) / d
    inside = (a >= lo) & (a <= hi)
    start = F.when(d != 0, F.least(t1, t2)).when(inside, F.lit(0.0)).otherwise(F.lit(2.0))
    end = F.when(d != 0, F.greatest(t1, t2)).when(inside, F.lit(1.0)).otherwise(F.lit(-1.0))
    return F.greatest(start, F.lit(0.0)), F.least(end, F.lit(1.0))


def _span(lo: Column, hi: Column) -> Column:
    return F.struct(lo.alias("lo"), hi.alias("hi"))


def _in_rectangle(e: Column, r: Column, half: float) -> Column:
    """Part of edge ``e`` inside the rectangle around edge ``r``, as ``struct<lo,hi>`` of t."""
    ux, uy = r["dx"] / r["len"], r["dy"] / r["len"]
    px, py = e["x"] - r["x"], e["y"] - r["y"]
    lo1, hi1 = _within(px * ux + py * uy, e["dx"] * ux + e["dy"] * uy, F.lit(0.0), r["len"])
    lo2, hi2 = _within(
        py * ux - px * uy, e["dy"] * ux - e["dx"] * uy, F.lit(-half), F.lit(half)
    )
    return _span(F.greatest(lo1, lo2), F.least(hi1, hi2))


def _in_wedge(e: Column, c: Column, radius: float) -> Column:
    """Part of edge ``e`` in the round outer side of a turn: the sector between the two edges' ends.

    That is the part of the disc that lies past the edge before and short of the edge after, so
    it never reaches behind a flat end.
    """
    px, py = e["x"] - c["x"], e["y"] - c["y"]
    a = e["len"] * e["len"]
    b = px * e["dx"] + py * e["dy"]
    root2 = b * b - a * (px * px + py * py - radius * radius)
    root = F.sqrt(F.greatest(root2, F.lit(0.0)))
    lo = F.when(root2 >= 0, F.greatest((-b - root) / a, F.lit(0.0))).otherwise(F.lit(2.0))
    hi = F.when(root2 >= 0, F.least((-b + root) / a, F.lit(1.0))).otherwise(F.lit(-1.0))
    far = F.lit(float("inf"))
    past, past_end = _within(px * c["ux"] + py * c["uy"], e["dx"] * c["ux"] + e["dy"] * c["uy"], F.lit(0.0), far)
    short, short_end = _within(px * c["vx"] + py * c["vy"], e["dx"] * c["vx"] + e["dy"] * c["vy"], -far, F.lit(0.0))
    return _span(F.greatest(lo, past, short), F.least(hi, past_end, short_end))


def covered_share(
    line_edges: Column, other_edges: Column, other_joints: Column, half: float
) -> Column:
    """Share of a line's length inside another line widened by ``half``."""

    def merged(spans: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("end"))
        step = lambda acc, s: F.struct(
            (acc["total"] + F.greatest(s["hi"] - F.greatest(s["lo"], acc["end"]), F.lit(0.0))).alias(
                "total"
            ),
            F.greatest(acc["end"], s["hi"]).alias("end"),
        )
        return F.aggregate(spans, start, step, lambda acc: acc["total"])

    def of_edge(e: Column) -> Column:
        spans = F.concat(
            F.transform(other_edges, lambda r: _in_rectangle(e, r, half)),
            F.transform(other_joints, lambda c: _in_wedge(e, c, half)),
        )
        kept = F.array_sort(F.filter(spans, lambda s: s["lo"] < s["hi"]))
        return merged(kept) * e["len"]

    total = F.aggregate(
        F.transform(line_edges, of_edge), F.lit(0.0), lambda acc, part: acc + part
    )
    return total / line_length(line_edges)


def polygon_edges(polygons: Column) -> Column:
    """Ring edges of all polygons (projected points) in one list; parity counting needs no more."""
    rings = F.flatten(polygons)
    return F.flatten(F.transform(rings, lambda ring: edges(ring)))


def _inside(px: Column, py: Column, ring_edges: Column) -> Column:
    """Even-odd test: holes and several polygons come out right by parity."""

    def crosses(r: Column) -> Column:
        y1 = r["y"] + r["dy"]
        x_at = r["x"] + r["dx"] * (py - r["y"]) / F.nullif(r["dy"], F.lit(0.0))
        return ((r["y"] > py) != (y1 > py)) & (px < F.coalesce(x_at, F.lit(float("-inf"))))

    return F.size(F.filter(ring_edges, crosses)) % 2 == 1


def line_hits_polygon(
    line_edges: Column, line_joints: Column, ring_edges: Column, half: float
) -> Column:
    """Does a line widened by ``half`` (flat ends) touch the area bounded by the rings?"""

    def edge_hits(e: Column) -> Column:
        touches = F.exists(
            ring_edges,
            lambda r: _touching(_in_rectangle(r, e, half)),
        )
        inside = _inside(e["x"] + e["dx"] / 2, e["y"] + e["dy"] / 2, ring_edges)
        return touches | inside

    joint_hits = lambda c: F.exists(
        ring_edges, lambda r: _touching(_in_wedge(r, c, half))
    )
    return F.exists(line_edges, edge_hits) | F.exists(line_joints, joint_hits)


def _touching(span: Column) -> Column:
    return span["lo"] <= span["hi"]
