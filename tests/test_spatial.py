import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadflow.functions import geometry as G
from roadflow.operators import spatial as X

# A bent road of our own, its neighbour two metres north, and one half a kilometre away.
BEND = [(26.1000, 61.0000), (26.1075, 61.0009), (26.1120, 61.0031)]


def north(line, metres):
    return [(lon, lat + metres / 111_412) for lon, lat in line]


LINE = "segment_id string, coords array<struct<lon:double,lat:double>>"
AREA = "disturbance_id string, polygons array<array<array<struct<lon:double,lat:double>>>>"


def lines(spark, rows):
    return spark.createDataFrame(rows, LINE)


def matches(spark, new, old, **kw):
    got = X.match_replacements(lines(spark, new), lines(spark, old), **kw)
    return {r.new_id: r.old_id for r in got.collect()}


@pytest.mark.parametrize("metres, found", [(0, True), (2, True), (4.6, True), (11, False), (500, False)])
def test_distance_decides(spark, metres, found):
    got = matches(spark, [("new", north(BEND, metres))], [("old", BEND)])
    assert got == ({"new": "old"} if found else {})


def test_direction_and_length(spark):
    assert matches(spark, [("back", BEND[::-1])], [("old", BEND)]) == {"back": "old"}
    # The first edge is about six tenths of the road: too little at the usual threshold.
    assert matches(spark, [("part", BEND[:2])], [("old", BEND)]) == {}
    assert matches(spark, [("part", BEND[:2])], [("old", BEND)], threshold=0.5) == {"part": "old"}
    split = [BEND[0], (26.10375, 61.00045), *BEND[1:]]
    assert matches(spark, [("split", split)], [("old", BEND)], threshold=0.999) == {"split": "old"}


def test_best_of_several_and_lines_without_points(spark):
    old = [("third", north(BEND, 4)), ("first", north(BEND, 1)), ("second", north(BEND, -3)), ("none", None), ("dot", BEND[:1])]
    assert matches(spark, [("new", north(BEND, 1.2)), ("other", None)], old) == {"new": "first"}


def test_never_its_own_heir_and_smallest_id_on_ties(spark):
    old = [(i, BEND) for i in ("k", "m", "p")] + [("q", north(BEND, 3))]
    assert matches(spark, [("k", BEND), ("r", BEND)], old) == {"k": "m", "r": "k"}


def test_copies_do_not_meet_pair_by_pair(spark):
    new = [(f"n{i:03d}", BEND) for i in range(300)]
    old = [(f"o{i:03d}", BEND) for i in range(300)]
    got = matches(spark, new, old)
    assert len(got) == 300 and set(got.values()) == {"o000"}


def to_plane(points):
    """Independent check of the projection: closed-form transverse Mercator by numeric arc length."""
    a, f = 6378137.0, 1 / 298.257222101
    n = f / (2 - f)
    out = []
    for lon, lat in points:
        phi, lam = np.radians(lat), np.radians(lon - 25)
        e = np.sqrt(f * (2 - f))
        chi = np.arctan(np.sinh(np.arcsinh(np.tan(phi)) - e * np.arctanh(e * np.sin(phi))))
        xi, eta = np.arctan2(np.tan(chi), np.cos(lam)), np.arctanh(np.cos(chi) * np.sin(lam))
        r = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        al = [n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3, 13 / 48 * n**2 - 3 / 5 * n**3, 61 / 240 * n**3]
        x = eta + sum(c * np.cos(2 * (j + 1) * xi) * np.sinh(2 * (j + 1) * eta) for j, c in enumerate(al))
        y = xi + sum(c * np.sin(2 * (j + 1) * xi) * np.cosh(2 * (j + 1) * eta) for j, c in enumerate(al))
        out.append((25500000 + r * x, r * y))
    return np.array(out)


def test_projection(spark):
    pts = [(25.0, 61.5), (26.11, 61.02), (23.7, 59.9), (27.4, 64.2)]
    df = spark.createDataFrame([("s", pts)], LINE).select(F.explode(G.project(F.col("coords"))).alias("p")).select("p.*")
    got = np.array([tuple(r) for r in df.collect()])
    assert np.abs(got - to_plane(pts)).max() < 1e-5
    assert got[0][0] == 25500000.0


def dist_to_line(p, line):
    best = np.inf
    for a, b in zip(line[:-1], line[1:]):
        d = b - a
        t = np.clip(np.dot(p - a, d) / np.dot(d, d), 0, 1)
        best = min(best, np.linalg.norm(p - a - t * d))
    return best


def in_flat_buffer(p, line, half):
    """Point test for the flat-ended buffer: a rectangle per edge, at turns the disc outside both edges."""
    for a, b in zip(line[:-1], line[1:]):
        d = b - a
        u = np.dot(p - a, d) / np.dot(d, d)
        if 0 <= u <= 1 and np.linalg.norm(p - a - u * d) <= half:
            return True
    turns = zip(line[:-2], line[1:-1], line[2:])
    return any(np.linalg.norm(p - v) <= half and np.dot(p - v, v - a) >= 0 and np.dot(p - v, b - v) <= 0 for a, v, b in turns)


def random_line(rng, lon, lat, n, spread=0.002):
    out = [(lon, lat)]
    for _ in range(n - 1):
        out.append((out[-1][0] + rng.uniform(-spread, spread), out[-1][1] + rng.uniform(-spread, spread) / 2))
    return out


def sampled_share(line, other, half, steps=4000):
    total = inside = 0.0
    for a, b in zip(line[:-1], line[1:]):
        length = np.linalg.norm(b - a)
        n = max(2, int(steps * length / 500))
        for t in (np.arange(n) + 0.5) / n:
            total += length / n
            inside += length / n if in_flat_buffer(a + t * (b - a), other, half) else 0
    return inside / total


def test_scores_against_sampling(spark):
    rng = random.Random(4)
    new, old = [], []
    for i in range(12):
        line = random_line(rng, 26.0 + i * 0.03, 61.3, rng.randint(2, 5))
        moved = [(x + rng.uniform(-6e-5, 6e-5), y + rng.uniform(-3e-5, 3e-5)) for x, y in line]
        new.append((f"n{i}", line))
        old.append((f"o{i}", moved))
    got = {r.new_id: (r.old_id, r.score) for r in X.match_replacements(lines(spark, new), lines(spark, old), threshold=0.05).collect()}
    planes_new, planes_old = {k: to_plane(v) for k, v in new}, {k: to_plane(v) for k, v in old}
    seen = 0
    for i in range(12):
        a, b = planes_new[f"n{i}"], planes_old[f"o{i}"]
        want = min(sampled_share(a, b, 5.0), sampled_share(b, a, 5.0))
        if want > 0.06:
            seen += 1
            assert got[f"n{i}"][0] == f"o{i}"
            assert got[f"n{i}"][1] == pytest.approx(want, abs=0.01)
    assert seen >= 8


def square(lon, lat, dx, dy):
    return [[[(lon, lat), (lon + dx, lat), (lon + dx, lat + dy), (lon, lat + dy), (lon, lat)]]]


def hits(spark, segs, areas, **kw):
    got = X.segments_hit_by(lines(spark, segs), spark.createDataFrame(areas, AREA), **kw)
    return sorted((r.segment_id, r.disturbance_id) for r in got.collect())


#: A straight road along a parallel; metres east and north of its western end.
WEST = (26.2, 61.05)
M_LON, M_LAT = 1 / 53_958, 1 / 111_422


def place(east, north_):
    return (WEST[0] + east * M_LON, WEST[1] + north_ * M_LAT)


def box(east, north_, width, height):
    return square(*place(east, north_), width * M_LON, height * M_LAT)


#: Spellings of one straight road of 300 metres.
SPELLINGS = {
    "plain": [place(0, 0), place(300, 0)],
    "short_end": [place(0, 0), place(297, 0), place(300, 0)],
    "doubled_end": [place(0, 0), place(300, 0), place(300, 0)],
    "collinear": [place(0, 0), place(120, 0), place(180, 0), place(300, 0)],
    "doubled_start": [place(0, 0), place(0, 0), place(300, 0)],
}


def test_one_road_however_it_is_spelt(spark):
    """Worked out by hand: 20 metres to either side, nothing behind the ends."""
    areas = [
        ("behind_east", box(304, -5, 10, 10)), ("behind_west", box(-12, -3, 8, 6)), ("beside", box(140, 15, 20, 30)),
        ("too_far", box(140, 23, 20, 30)), ("at_corner", box(303, 12, 9, 12)), ("over_end", box(290, -40, 30, 25)),
        ("all_round", box(-500, -500, 2000, 1000)), ("hole", [square(*place(-900, -900), 3000 * M_LON, 1800 * M_LAT)[0] + square(*place(-500, -500), 2000 * M_LON, 1000 * M_LAT)[0]]),
    ]
    got = set(hits(spark, list(SPELLINGS.items()), areas))
    assert got == {(s, a) for s in SPELLINGS for a in ("beside", "over_end", "all_round")}


def test_turns_are_round_on_the_outside(spark):
    """A right angle east then north: 20 metres round the corner, square at both ends."""
    road = [("road", [place(0, 0), place(300, 0), place(300, 200)])]
    areas = [
        ("outer_near", box(311, -13, 2, 2)), ("outer_far", box(316, -18, 2, 2)), ("past_top", box(296, 203, 8, 8)),
        ("inner", box(280, 5, 6, 6)), ("inner_far", box(240, 30, 30, 30)),
    ]
    assert {a for _, a in hits(spark, road, areas)} == {"outer_near", "inner"}


def test_sharp_turn_near_the_end(spark):
    """A hairpin three metres before the end: the turn is round towards the east, the end stays flat."""
    road = [("pin", [place(0, 0), place(100, 0), place(97, 0)])]
    areas = [("east", box(110, -2, 5, 4)), ("far_east", box(122, -2, 5, 4)), ("west", box(-10, -2, 6, 4))]
    assert {a for _, a in hits(spark, road, areas)} == {"east"}


def test_far_apart_sizes_meet_without_a_job_before_the_action(spark):
    segs = [(f"s{i}", [place(i * 90, 0), place(i * 90 + 60, 5)]) for i in range(1000)]
    areas = [("country", box(-5_000, -50_000, 100_000, 100_000)), ("yard", box(10, -10, 30, 20))]
    df, tracker = spark.createDataFrame(areas, AREA), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    got = X.segments_hit_by(lines(spark, segs), df)
    assert list(tracker.getJobIdsForGroup("plan")) == []
    spark.sparkContext.setJobGroup("run", "run")
    found = {(r.segment_id, r.disturbance_id) for r in got.collect()}
    assert found == {(s, "country") for s, _ in segs} | {("s0", "yard")}


def test_hits_against_sampling(spark):
    rng = random.Random(11)
    segs = [(f"s{i}", random_line(rng, 26.4 + rng.uniform(0, 0.02), 61.2 + rng.uniform(0, 0.01), rng.randint(2, 4))) for i in range(15)]
    areas = [(f"d{i}", square(26.4 + rng.uniform(0, 0.02), 61.2 + rng.uniform(0, 0.01), 0.002, 0.001)) for i in range(15)]
    got = set(hits(spark, segs, areas))
    for sid, line in segs:
        plane = to_plane(line)
        for did, polygons in areas:
            ring = to_plane(polygons[0][0])
            # Grid of points over the area; a clear margin avoids ties of the sampling itself.
            ts = np.linspace(0, 1, 25)
            pts = [ring[0] + u * (ring[1] - ring[0]) + v * (ring[3] - ring[0]) for u in ts for v in ts]
            if any(in_flat_buffer(p, plane, 19.0) for p in pts):
                assert (sid, did) in got
            elif not any(in_flat_buffer(p, plane, 32.0) or dist_to_line(p, plane) < 25 for p in pts):
                assert (sid, did) not in got


def test_crowded_cell_in_blocks(spark):
    """Boxes that all overlap in one cell, and some elsewhere: the same pairs, spread over tasks."""
    side = lambda n, salt: spark.range(n).select(
        F.concat(F.lit(salt), "id").alias("id"),
        F.struct(*[(F.lit(v) + F.when(F.col("id") % 50 == 0, 5000.0 * (F.col("id") / 50)).otherwise(F.col("id") / 1000)).alias(n) for n, v in (("x0", 0.0), ("y0", 0.0), ("x1", 100.0), ("y1", 100.0))]).alias("box"),
    )
    a, b = side(400, "a"), side(150, "b")
    plain = {tuple(r) for r in X.box_pairs(a, b, 250.0).collect()}
    split = [tuple(r) for r in X.box_pairs(a, b, 250.0, crowded=40).collect()]
    assert len(split) == len(set(split)) and set(split) == plain and len(plain) > 50_000
    # As many pairs as ten thousand boxes make, counted where they are found.
    a, b = side(10_000, "a"), side(1_000, "b")
    met = X.box_pairs(a, b, 250.0, crowded=500).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in met) == X.box_pairs(a, b, 250.0).count() and len(met) > 1


def test_crowded_cell(spark):
    segs = [(f"s{i:02d}", [place(0, i / 100), place(54, 0)]) for i in range(40)]
    areas = [(f"d{i}", box(0, -10, 54, 20 + i / 10)) for i in range(10)]
    assert len(hits(spark, segs, areas)) == 400
