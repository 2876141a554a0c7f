import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadflow import schemas
from roadflow.functions import scalars as S
from roadflow.operators import disturbances as D
from roadflow.operators import lineage as L
from roadflow.operators import quality as Q
from roadflow.operators import series
from roadflow.operators import spatial as X
from roadflow.plans import jobs
from roadflow.sources import disturbance_files as DF
from roadflow.sources import exports, tables

# Bent roads of our own: one, its neighbour two metres north, another half a kilometre away.
ROAD = [(26.1000, 61.0000), (26.1075, 61.0009), (26.1120, 61.0031)]
NEAR = [(lon, round(lat + 0.000018, 6)) for lon, lat in ROAD]
AWAY = [(lon, round(lat + 0.0045, 6)) for lon, lat in ROAD]
NOW = datetime(2025, 6, 1, 12)
OLD = datetime(2025, 1, 1)
FRESH = f"segment_id string, coords {schemas.COORDS}"


def at(t):
    return F.lit(t)


def hash_of(spark, coords):
    df = spark.createDataFrame([("x", coords)], FRESH)
    return df.select(S.geometry_hash(F.col("coords")).alias("h")).collect()[0].h


def log_row(spark, sid, coords, history=(), heir=None, migrated=None):
    return (sid, coords, hash_of(spark, coords), OLD, list(history), heir, migrated)


def run_cycle(spark, fresh, log, archive=(), lookback=None):
    out = L.segment_cycle(
        spark.createDataFrame(fresh, FRESH),
        spark.createDataFrame(list(log), schemas.CHANGELOG),
        spark.createDataFrame(list(archive), schemas.ARCHIVE),
        at(NOW),
        lookback,
    )
    return [{r.segment_id: r for r in df.collect()} for df in out]


def test_add_remove_modify_unchanged(spark):
    log = [log_row(spark, "same", ROAD), log_row(spark, "moved", ROAD), log_row(spark, "gone", AWAY)]
    new, archived, diff = run_cycle(spark, [("same", ROAD), ("moved", AWAY), ("fresh", NEAR)], log)
    assert {k: r.change for k, r in diff.items()} == {
        "same": "unchanged", "moved": "modified", "gone": "removed", "fresh": "added"}
    assert set(new) == {"same", "moved", "fresh"} and set(archived) == {"gone"}
    assert archived["gone"].date_archived == NOW
    assert [tuple(p) for p in new["moved"].history[0].coords] == ROAD
    assert new["moved"].history[0].date_archived == NOW and new["moved"].current_hash == hash_of(spark, AWAY)
    assert new["same"].history == [] and new["fresh"].date_added == NOW and new["same"].date_added == OLD
    assert new["fresh"].geo_inherited_from is None


def test_inheritance_in_one_cycle(spark):
    past = (datetime(2024, 5, 1), AWAY)
    new, archived, _ = run_cycle(spark, [("new", NEAR)], [log_row(spark, "old", ROAD, [past])])
    assert new["new"].geo_inherited_from == "old" and set(archived) == {"old"}
    assert [h.date_archived for h in new["new"].history] == [past[0], NOW]
    assert [tuple(p) for p in new["new"].history[1].coords] == ROAD


def archived_row(spark, sid, coords, when):
    return (*log_row(spark, sid, coords), when)


@pytest.mark.parametrize(
    "hours_ago, lookback, heir",
    [(5, 6, "old"), (6, 6, "old"), (7, 6, None), (5, None, None)],
)
def test_lookback_window(spark, hours_ago, lookback, heir):
    archive = [archived_row(spark, "old", ROAD, NOW - timedelta(hours=hours_ago))]
    new, archived, _ = run_cycle(spark, [("new", ROAD)], [], archive, lookback)
    assert new["new"].geo_inherited_from == heir and set(archived) == {"old"}


def test_a_source_is_used_once_across_cycles(spark):
    archive = [archived_row(spark, "old", ROAD, NOW - timedelta(hours=1))]
    log = [log_row(spark, "heir", ROAD, heir="old")]
    new, _, _ = run_cycle(spark, [("heir", ROAD), ("new", ROAD)], log, archive, 6)
    assert new["new"].geo_inherited_from is None and new["heir"].geo_inherited_from == "old"


def test_retention_per_segment(spark):
    rows = [(s, OLD + timedelta(hours=i), i) for s in "ab" for i in range(61)]
    df = spark.createDataFrame(rows, "segment_id string, recorded_at timestamp, n int")
    kept = L.keep_newest_versions(df).groupBy("segment_id").agg(F.count("*").alias("c"), F.min("n").alias("n"))
    assert {tuple(r) for r in kept.collect()} == {("a", 50, 11), ("b", 50, 11)}


POINTS = "segment_id string, time timestamp, fcd_coverage int"


def points(spark, rows):
    return spark.createDataFrame([(s, OLD + timedelta(minutes=5 * i), v) for s, i, v in rows], POINTS)


def renames(spark, rows):
    return spark.createDataFrame(rows, "old_id string, new_id string")


def test_retag(spark):
    df = points(spark, [("old", 0, 1), ("old", 1, 2), ("new", 1, 9), ("new", 2, 3), ("x", 0, 4)])
    pairs = renames(spark, [("old", "new"), ("none", "y"), ("x", "x")])
    got = {(r.segment_id, r.time.minute): r.fcd_coverage for r in L.retag_series(df, pairs).collect()}
    assert got == {("new", 0): 1, ("new", 5): 2, ("new", 10): 3, ("x", 0): 4}
    report = {r.old_id: (r.original_count, r.retagged_count, r.deleted) for r in L.retag_report(df, pairs, "fcd").collect()}
    assert report == {"old": (2, 3, True), "none": (0, 0, False)}
    assert [r.reason for r in L.check_renames(pairs).collect()] == ["old_id_equals_new_id"]
    with pytest.raises(ValueError):
        L.retag_series(df, pairs.drop("new_id"))


def test_lineage_on_stored_tables(spark, tmp_path):
    root, path = str(tmp_path / "state"), str(tmp_path / "fcd")
    tables.write_series(points(spark, [("old", i, i % 10) for i in range(600)] + [("x", 0, 4)]), path, ["fcd_coverage"])
    series_tables = {"fcd": (path, ["fcd_coverage"])}
    fresh = lambda rows: spark.createDataFrame(rows, FRESH)
    first = jobs.run_lineage(spark, root, fresh([("old", ROAD), ("x", AWAY)]), OLD, series_tables)
    assert first.count() == 0
    report = jobs.run_lineage(spark, root, fresh([("new", NEAR), ("x", AWAY)]), NOW, series_tables, 24).collect()
    assert [(r.old_id, r.new_id, r.original_count, r.deleted) for r in report] == [("old", "new", 600, True)]
    counts = {r.segment_id: r["count"] for r in tables.read_series(spark, path).groupBy("segment_id").count().collect()}
    assert counts == {"new": 600, "x": 1}
    log = {r.segment_id: r for r in tables.load_table(spark, f"{root}/changelog").collect()}
    assert log["new"].timeseries_migrated_at == NOW and log["new"].geo_inherited_from == "old"
    assert jobs.run_lineage(spark, root, fresh([("new", NEAR), ("x", AWAY)]), NOW, series_tables, 24).count() == 0
    assert tables.read_series(spark, path, ["new"]).count() == 600


def test_gap_candidates(spark):
    day = timedelta(days=1)
    log = [("n1", ROAD, "h", OLD + 10 * day, [], None, None), ("n2", AWAY, "h", OLD, [], None, None), ("n3", ROAD, "h", OLD + 10 * day, [], "o", None)]
    archive = [(*log_row(spark, "late", ROAD), OLD + 11 * day), (*log_row(spark, "b", ROAD), OLD + 9 * day), (*log_row(spark, "near", NEAR), OLD + 10 * day)]
    got = X.replacement_gap_candidates(spark.createDataFrame(log, schemas.CHANGELOG), spark.createDataFrame(archive, schemas.ARCHIVE))
    assert [(r.new_id, r.old_id) for r in got.collect()] == [("n1", "b")]
    histogram = X.replacement_gap_histogram(got).collect()
    assert [(r.gap_class, r.matches, r.share) for r in histogram] == [("6-24h", 1, 1.0)]
    assert [tuple(r) for r in X.gap_summary(got).collect()] == [(1, 1, 1.0)]


# --- disturbances -----------------------------------------------------------------------------

REPORTS = "disturbance_id string, segment_id string, start_text string, end_text string"


def test_date_rules(spark):
    rows = [
        ("current", "2025-05-20", "2025-06-30"), ("ends_today", "2025-05-20", "2025-06-01"),
        ("starts_today", "2025-06-01", "2025-06-02"), ("future", "2025-07-01", "2025-08-01"),
        ("too_old", "2025-01-01", "2025-12-31"), ("first_day", "2025-02-01", "2025-12-31"),
        ("ended", "2025-05-01", "2025-05-31"), ("inverted", "2025-06-20", "2025-06-10"),
        ("text", "soon", "2025-06-10"), ("no_day", "2025-02-30", "2025-06-10"), ("missing", None, "2025-06-10"),
    ]
    df = spark.createDataFrame([(r[0], "s", r[1], r[2]) for r in rows], REPORTS)
    c = D.classify_disturbances(df, F.lit(date(2025, 2, 1)), at(NOW))
    got = {r.disturbance_id: r.verdict for r in c.collect()}
    assert got == {
        "current": "current", "ends_today": "current", "starts_today": "current", "future": "future",
        "too_old": "too_old", "first_day": "current", "ended": "ended", "inverted": "inverted",
        "text": "malformed", "no_day": "malformed", "missing": "malformed"}
    assert [tuple(r) for r in D.validation_totals(c).collect()] == [(6, 4, 1, 5)]


def test_envelope_and_windows(spark):
    rows = [("1", "a", "2025-03-01", "2025-06-10"), ("2", "a", "2025-02-01", "2025-04-10"),
            ("3", "b", "bad", "2025-04-10"), ("4", "c", "2025-05-01", "bad")]
    segs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "segment_id string")
    env = D.disturbance_envelope(spark.createDataFrame(rows, REPORTS), at(NOW), segs)
    got = {r.segment_id: (r.disturbance_start, r.disturbance_end) for r in env.collect()}
    assert got == {"a": (datetime(2025, 2, 1), datetime(2025, 6, 10)), "b": (NOW, NOW),
                   "c": (datetime(2025, 5, 1), NOW), "d": (NOW, NOW)}
    win = {r.segment_id: r for r in D.profiling_windows(env, at(NOW)).collect()}
    assert win["a"].profiling_end == datetime(2025, 1, 30)
    assert win["a"].profiling_start == datetime(2025, 1, 2)
    assert win["a"].validation_start == NOW - timedelta(weeks=4)
    assert win["d"].profiling_end == datetime(2025, 6, 1)
    assert win["d"].validation_start == NOW - timedelta(minutes=5)


@pytest.mark.parametrize("days, weeks, want", [
    (90, 4, NOW - timedelta(weeks=4)), (10, 4, NOW - timedelta(days=9)),
    (90, 0, NOW - timedelta(minutes=5)), (2, 0, NOW - timedelta(minutes=5)),
    (0.5, 4, NOW - timedelta(minutes=5)),
])
def test_validation_start(spark, days, weeks, want):
    df = spark.createDataFrame([(NOW - timedelta(days=days),)], "e timestamp")
    assert df.select(S.validation_start(F.col("e"), at(NOW), weeks).alias("v")).collect()[0].v == want


def test_plans(spark):
    active = spark.createDataFrame([("a",), ("b",)], "segment_id string")
    current = spark.createDataFrame([("b", 1), ("c", 2)], "segment_id string, n int")
    got = {r.segment_id: (r.action, r.n) for r in D.plan_segments(active, current).collect()}
    assert got == {"a": ("deactivate", None), "b": ("update", 1), "c": ("create", 2)}
    env = "segment_id string, disturbance_start timestamp, disturbance_end timestamp"
    old = spark.createDataFrame([(s, OLD, NOW) for s in "abc"], env)
    day = timedelta(days=1)
    new = spark.createDataFrame([("a", OLD + day, NOW), ("b", OLD, NOW + day), ("c", OLD, NOW)], env)
    assert {r.segment_id: r.action for r in D.refresh_plan(old, new).collect()} == {"a": "reprofile", "b": "extend", "c": "keep"}


FEATURES = """{"type": "FeatureCollection", "features": [
 {"type": "Feature", "properties": {"id": 77, "hakemus": "Putkityö", "hakemustunnus": "T-2025-31",
  "tyo_alkaa": "2025-05-20", "tyo_paattyy": "2025-09-15", "osoite": "Rantatie 4", "kaupunginosa": "Itäranta"},
  "geometry": {"type": "MultiPolygon", "coordinates": [[[[26.103, 60.999], [26.109, 60.999], [26.109, 61.002], [26.103, 61.002], [26.103, 60.999]]]]}},
 {"type": "Feature", "properties": {"id": 5}, "geometry": null},
 {"type": "Feature", "properties": {"id": 6, "tyo_alkaa": "2025-05-20", "tyo_paattyy": "2025-09-15"}, "geometry": {"type": "Polygon",
  "coordinates": [[[26.103, 60.999], [26.109, 60.999], [26.109, 61.002], [26.103, 60.999]]]}}]}"""


def test_layers_to_collisions(spark, tmp_path):
    (tmp_path / "l1.json").write_text(FEATURES)
    (tmp_path / "l2.json").write_text('{"features": []}')
    (tmp_path / "l3.json").write_text('{"features": [')
    reports = DF.read_disturbances(spark, {f"l{i}": str(tmp_path / f"l{i}.json") for i in (1, 2, 3)})
    assert {r.disturbance_id: r.reason for r in reports.collect()} == {"77": None, "5": "no_geometry", "6": None}
    segs = spark.createDataFrame([("shore", ROAD), ("hill", AWAY)], FRESH)
    flat = jobs.affected_segments(DF.valid_features(reports), segs, F.lit(date(2025, 2, 1)), at(NOW))
    got = {r.disturbance_id: r for r in flat.collect()}
    assert set(got) == {"77", "6"} and {r.segment_id for r in got.values()} == {"shore"}
    p = got["77"].properties
    assert (p.traffic_disturbance_type, p.star_date, p.address, p.district) == ("Putkityö", "2025-05-20", "Rantatie 4", "Itäranta")
    # Null in a column that the reports have stays null; only a column they lack gets a default.
    q = got["6"].properties
    assert (q.traffic_disturbance_type, q.application_id, q.address) == (None, None, None)
    bare = DF.valid_features(reports).select("disturbance_id", "polygons", "start_text", "end_text")
    hit = flat.select("segment_id", "coords", "disturbance_id")
    q = D.collisions(hit, bare).select("properties.*").first()
    assert (q.traffic_disturbance_type, q.application_id, q.address) == ("Unknown Type", "Unknown App ID", None)
    nested = D.disturbances_by_segment(flat).collect()
    assert len(nested) == 1 and len(nested[0].detailed_collisions) == 2
    path = str(tmp_path / "collisions")
    tables.save_table(flat, path)
    tables.save_table(flat.filter("false"), path)
    assert tables.load_table(spark, path).count() == 0
    assert tables.versions(spark, path) == [1, 2]
    assert tables.expire_versions(spark, path, datetime(2000, 1, 1)) == []
    assert tables.expire_versions(spark, path, datetime(2100, 1, 1)) == [1] and tables.versions(spark, path) == [2]
    with pytest.raises(ValueError):
        DF.read_disturbances(spark, {})


def test_layer_cache(spark):
    rows = [("l", NOW - timedelta(hours=h), good, h) for h, good in ((1, False), (5, True), (9, True), (30, True))]
    rows += [("m", NOW - timedelta(hours=25), True, 25)]
    df = spark.createDataFrame(rows, "layer string, fetched_at timestamp, good boolean, n int")
    assert [r.n for r in DF.latest_good_snapshot(df, at(NOW)).collect()] == [5]


# --- series and tables ----------------------------------------------------------------------------


def test_slice_and_downsample(spark):
    df = points(spark, [("a", i, i) for i in range(10)])
    day = lambda m: OLD + timedelta(minutes=m)
    assert series.series_slice(df, None, day(5), day(15)).count() == 2
    assert series.series_slice(df, None, day(15), day(5)).count() == 0
    assert series.series_slice(df, ["b"]).count() == 0
    rows = [("a", day(0), 1, 5.0), ("a", day(3), 2, None), ("a", day(4), None, None), ("a", day(6), None, None)]
    wide = spark.createDataFrame(rows, "segment_id string, time timestamp, x int, y double")
    got = [tuple(r) for r in series.downsample_last(wide, ["x", "y"]).collect()]
    assert got == [("a", day(0), 2, 5.0)]
    assert series.downsample_last(wide, ["x"], label="end").collect()[0].time == day(5)
    with pytest.raises(ValueError):
        series.period_violations(df, day(0), None)
    assert series.period_violations(df, None, None).count() == 0


def test_upsert_and_append(spark, tmp_path):
    path = str(tmp_path / "s")
    write = lambda rows, **k: tables.write_series(points(spark, rows), path, ["fcd_coverage"], **k)
    read = lambda: {(r.segment_id, r.time): r.fcd_coverage for r in tables.read_series(spark, path).collect()}
    write([("a", 0, 1), ("a", 300, 2), ("b", 0, None)])
    write([("a", 0, 5), ("c", 1, 3)])
    write([("a", 300, 9), ("c", 2, 4)], only_new=True)
    write([("a", 300, 9), ("c", 2, 4)], only_new=True)
    t = lambda i: OLD + timedelta(minutes=5 * i)
    assert read() == {("a", t(0)): 5, ("a", t(300)): 2, ("c", t(1)): 3, ("c", t(2)): 4}
    tables.drop_segments(spark, path, spark.createDataFrame([("c",), ("zz",)], "segment_id string"))
    assert read() == {("a", t(0)): 5, ("a", t(300)): 2}
    with pytest.raises(ValueError):
        tables.write_series(points(spark, []).drop("time"), path, ["fcd_coverage"])


def whole(folder):
    """Part files put together in name order."""
    return json.loads("".join(p.read_text() for p in sorted(folder.glob("part-*"))))


def test_flat_collisions_make_one_document(spark, tmp_path):
    rows = [(s, ROAD, f"d{i}") for s in ("a", "b") for i in range(9)] + [("c", ROAD, "d0")]
    hits = spark.createDataFrame(rows, FRESH + ", disturbance_id string")
    report = [(f"d{i}", "t", "x", "2025-01-01", "2025-02-01", None, None, [[AWAY]]) for i in range(9)]
    reports = spark.createDataFrame(report, schemas.DISTURBANCE.replace(", layer string", ""))
    flat = D.collisions(hits, reports)
    path = tmp_path / "doc"
    exports.write_lines(exports.collision_document(flat), str(path))
    doc = whole(path)["segmentId"]
    ids = lambda s: sorted(c["properties"]["traffic_disturbance_id"] for c in doc[s]["detailedCollisions"])
    assert ids("a") == ids("b") == [f"d{i}" for i in range(9)] and ids("c") == ["d0"]
    assert doc["a"]["detailedCollisions"][0]["geometry"]["type"] == "MultiPolygon"
    path = tmp_path / "none"
    exports.write_lines(exports.collision_document(flat.filter("false")), str(path))
    assert whole(path) == {"segmentId": {}}


def test_history_is_cut_where_it_is_stored(spark):
    versions = [(OLD + timedelta(days=i), ROAD) for i in range(60)]
    log = spark.createDataFrame([log_row(spark, "a", AWAY, versions), log_row(spark, "b", AWAY, versions[:3])], schemas.CHANGELOG)
    got = {r.segment_id: [h.date_archived for h in r.history] for r in L.keep_history(log, 50).collect()}
    assert got == {"a": [v[0] for v in versions[11:]], "b": [v[0] for v in versions[:3]]}
    rows = spark.createDataFrame([("s", OLD + timedelta(hours=i), ROAD, f"h{i}") for i in range(90)], f"segment_id string, recorded_at timestamp, coords {schemas.COORDS}, geometry_hash string")
    assert len(L.changelog_view(L.keep_newest_versions(rows, 80)).first().history) == 79


def test_missing_collisions_table(spark):
    assert tuple(Q.collisions_quality(None, at(NOW), at(NOW)).first()) == (0, "missing", None)


def test_exports(spark, tmp_path):
    segs = spark.createDataFrame([("a", ROAD)], FRESH)
    assert exports.map_entries(segs).collect()[0].value == (
        '{"segmentId":{"a":{"geometry":{"type":"LineString","coordinates":[[26.1,61.0],[26.1075,61.0009],[26.112,61.0031]]}}}}')
    assert exports.segment_features(segs).collect()[0].value == (
        '{"type":"Feature","geometry":{"type":"LineString","coordinates":[[26.1,61.0],[26.1075,61.0009],[26.112,61.0031]]},'
        '"properties":{"segment_id":"a"}}')
    lines = [("b\"x", NEAR), ("a", ROAD), ("c", AWAY)]
    segs = spark.createDataFrame(lines, FRESH).repartition(3)
    path = tmp_path / "doc"
    exports.write_lines(exports.feature_collection(exports.segment_features(segs), ["segment_id"]), str(path))
    doc = whole(path)
    assert doc["type"] == "FeatureCollection" and "crs" not in doc
    assert [f["properties"]["segment_id"] for f in doc["features"]] == ["a", "b\"x", "c"]
    path = tmp_path / "map"
    exports.write_lines(exports.map_document(segs), str(path))
    assert {k: v["geometry"]["coordinates"] for k, v in whole(path)["segmentId"].items()} == {
        k: [list(p) for p in v] for k, v in lines}
    path = str(tmp_path / "csv")
    df = points(spark, [("a", 0, 1)])
    assert not exports.write_csv(df.filter("false"), path)
    assert exports.write_csv(df, path) and exports.write_csv(df, path, append=True)
    back = spark.read.option("sep", ";").option("header", True).csv(path)
    assert back.columns == ["segment_id", "time", "fcd_coverage"] and back.count() == 2


def test_same_rows(spark):
    df = spark.createDataFrame([("a", 1, 1.00004), ("b", 2, 2.0)], "m string, t int, v double")
    other = spark.createDataFrame([("b", 2, 2.0), ("a", 1, 1.0)], "m string, t int, v double")
    assert Q.same_rows(df, other, ["m", "t"]).count() == 0
    changed = other.withColumn("v", F.col("v") + 0.01)
    assert Q.same_rows(df, changed, ["m", "t"]).count() == 4


def test_map_integrity_and_freshness(spark):
    segs = spark.createDataFrame([("a", ROAD), ("b", None), ("c", [])], FRESH)
    assert Q.map_integrity(segs).collect()[0].without_geometry == 2
    assert Q.map_integrity(segs.filter("false")).collect()[0].verdict == "empty"
    df = points(spark, [("a", 0, 1)])
    mode = lambda **k: Q.series_freshness(df, at(OLD + timedelta(**k)), 30).collect()[0].mode
    assert [mode(minutes=29), mode(hours=2), mode(days=8)] == ["real_time", "backfill", "no_data"]


def test_document_reads_its_rows_no_oftener_than_the_sort_needs(spark):
    """Both ends and the number of rows come from one pass; the sort takes two (its ranges and itself)."""
    read, n = spark.sparkContext.accumulator(0), 500

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(n).selectExpr("cast(id as string) as segment_id", "concat('\"', id, '\":1') as value")
    lines = exports.document_lines(rows.mapInArrow(seen, rows.schema), ["segment_id"], "{", "}")
    whole = "".join(r.value for r in lines.collect())
    assert json.loads(whole) == {str(k): 1 for k in range(n)}
    assert n <= read.value <= 3 * n
    assert [r.value for r in exports.document_lines(rows.limit(0), ["segment_id"], "{", "}").collect()] == ["{}"]
