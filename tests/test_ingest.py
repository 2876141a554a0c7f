import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadflow import schemas
from roadflow.functions import scalars as S
from roadflow.operators import observations as O
from roadflow.operators import quality as Q
from roadflow.plans import jobs
from roadflow.sources import snapshots, tables
from roadflow.streaming import jobs as streams

QUAY = [[26.1004, 61.0011], [26.1033, 61.0020], [26.1051, 61.0034]]


def seg(sid, speeds, confidence, shape, **more):
    cur, avg, typ = speeds
    points = [{"longitude": x, "latitude": y} for x, y in shape]
    return {"segmentIdStr": sid, "currentSpeed": cur, "averageSpeed": avg, "typicalSpeed": typ,
            "confidence": confidence, "shape": points, **more}


# A night of five files across midnight: ids as text and as numbers, unknown speeds and confidence,
# a segment that is away for two files, one that turns up last, a line drawn finer in the last file.
PIER = [[25.40, 62.10], [25.41, 62.11]]
FILES = {
    "2025-03-09T23-35-00.json": {"detailedSegments": [
        seg("mill", (45, 44, 50), 99, QUAY),
        seg("pier", (None, None, 30), 80, PIER),
    ]},
    "2025-03-09T23-50-00.json": {"detailedSegments": [
        {"segmentId": 7001, "currentSpeed": 12, "confidence": 91, "shape": []},
    ]},
    "2025-03-10T00-05-00.json": {"detailedSegments": [
        seg("pier", (22.5, 24, 30), None, PIER),
        {"segmentId": 7001, "currentSpeed": 14, "confidence": 73, "shape": []},
    ]},
    "2025-03-10T00-20-00.json": {"detailedSegments": [
        seg("mill", (40, 44, 50), 88, QUAY),
        seg("pier", (23, 24, 30), 85, PIER),
        seg("weir", (8, 9, 10), 100, [[25.50, 62.20], [25.52, 62.20]]),
    ]},
    "2025-03-10T00-40-00.json": {"detailedSegments": [
        seg("weir", (9, 9, 10), 70, [[25.50, 62.20], [25.51, 62.2002], [25.52, 62.20]]),
    ]},
}
WANT = {
    ("mill", 35): (10, 45.0), ("pier", 35): (3, None), ("7001", 50): (7, 12.0), ("pier", 5): (None, 22.5), ("7001", 5): (1, 14.0),
    ("mill", 20): (6, 40.0), ("pier", 20): (5, 23.0), ("weir", 20): (10, 8.0), ("weir", 40): (0, 9.0),
}


def land(folder, files):
    for name, doc in files.items():
        data = doc if isinstance(doc, bytes) else json.dumps(doc).encode()
        (folder / name).write_bytes(data)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    land(folder, FILES)
    return folder


def as_map(obs):
    return {(r.segment_id, r.time.minute): (r.fcd_coverage, r.current_speed) for r in obs.collect()}


def test_golden_files(spark, landing):
    obs, bad, report = jobs.ingest(spark, str(landing))
    assert as_map(obs) == WANT
    assert bad.count() == 0
    assert [tuple(r) for r in report.collect()] == [("ok", 5, 9)]
    lines = {r.segment_id: [tuple(p) for p in r.coords] for r in O.segment_geometries(obs).collect()}
    assert lines["weir"] == [(25.5, 62.2), (25.52, 62.2)] and lines["7001"] == []


def test_bad_files_are_set_aside(spark, landing):
    land(landing, {
        "2025-03-10T01-00-00.json": b'{"detailedSegments": [',
        "2025-03-10T01-10-00.json": b'\xff\xfe{"detailedSegments": []}\xff',
        "2025-03-10T01-20-00.json": {"detailedSegments": {"a": 1}},
        "2025-03-10T01-30-00.json": {"other": 1},
        "nostamp.json": {"detailedSegments": []},
        "2024-02-30T12-00-00.json": {"detailedSegments": []},
    })
    obs, bad, report = jobs.ingest(spark, str(landing))
    assert as_map(obs) == WANT
    reasons = {r.file_name: r.reason for r in bad.collect()}
    assert reasons == {
        "2025-03-10T01-00-00.json": "malformed_json",
        "2025-03-10T01-10-00.json": "malformed_json",
        "2025-03-10T01-20-00.json": "segments_not_a_list",
        "2025-03-10T01-30-00.json": "segments_not_a_list",
        "nostamp.json": "no_timestamp",
        "2024-02-30T12-00-00.json": "no_timestamp",
    }
    assert {r.status: r.files for r in report.collect()} == {
        "ok": 5, "malformed_json": 2, "segments_not_a_list": 2, "no_timestamp": 2}


def test_entry_rules(spark, landing):
    big = 1234567890123456789
    land(landing, {"2024-01-02T00-00-00.123456.json": {"detailedSegments": [
        {"segmentId": big, "confidence": 100, "shape": [{"longitude": 26.3, "latitude": 61.4}]},
        {"confidence": 80},
        {"segmentIdStr": "n", "confidence": None},
        {"segmentIdStr": "p", "confidence": 71, "shape": [
            {"longitude": "x", "latitude": 61.4}, {"latitude": 61.4}, {"longitude": 26.3, "latitude": 61.5}]},
    ]}})
    obs, bad, _ = jobs.ingest(spark, str(landing), datetime(2024, 1, 2), datetime(2024, 1, 2, 1))
    files = snapshots.read_fcd_snapshots(spark, str(landing), datetime(2024, 1, 2), datetime(2024, 1, 2, 1))
    lost = {r.position: r.reason for r in O.entry_rejects(snapshots.split_good(files)[0]).collect()}
    assert lost == {1: "no_segment_id", 3: "points_without_coordinates"}
    rows = {r.segment_id: r for r in obs.collect()}
    assert set(rows) == {str(big), "n", "p"} and bad.count() == 0
    assert rows[str(big)].fcd_coverage == 10 and rows["n"].fcd_coverage is None
    assert rows["n"].coords == []
    assert [tuple(p) for p in rows["p"].coords] == [(26.3, 61.5)]
    assert rows["p"].time == datetime(2024, 1, 2)


def test_range_is_inclusive_and_checked(spark, landing):
    read = lambda a, b: snapshots.read_fcd_snapshots(spark, str(landing), a, b).count()
    at = lambda h, m: datetime(2025, 3, 9 if h > 12 else 10, h, m)
    assert read(at(23, 35), at(0, 40)) == 5 and read(at(0, 5), at(0, 5)) == 1 and read(at(23, 51), at(0, 4)) == 0
    assert read(at(23, 50), None) == 4 and read(None, at(0, 4)) == 2
    with pytest.raises(ValueError):
        read(at(0, 5), at(0, 4))


def test_first_and_latest_file(spark, landing):
    for i, name in enumerate(sorted(FILES)):
        os.utime(landing / name, (1_700_000_000 - i, 1_700_000_000 - i))
    row = snapshots.first_and_latest_file(snapshots.read_fcd_snapshots(spark, str(landing))).collect()[0]
    assert row.first_file.endswith("00-40-00.json") and row.latest_file.endswith("23-35-00.json")


def test_confidence_and_names(spark):
    pairs = [(None, None), (0, 0), (70, 0), (71, 0), (77, 2), (85, 5), (94, 8), (99, 10), (100, 10)]
    df = spark.createDataFrame(pairs, "c int, f int")
    assert df.filter(~S.confidence_to_fcd(F.col("c")).eqNullSafe(F.col("f"))).count() == 0
    names = [("x/2024-01-01T12:00:00.5.json", "2024-01-01 12:00:00", "2024-01-01 12:00:00.5"),
             ("2024-01-01T12:00:00.json", "2024-01-01 12:00:00", "2024-01-01 12:00:00"),
             ("2024-13-01T12:00:00.json", None, None), ("plain.json", None, None)]
    df = spark.createDataFrame(names, "n string, a string, b string")
    for keep, want in ((False, "a"), (True, "b")):
        got = S.time_from_file_name(F.col("n"), keep)
        assert df.filter(~got.eqNullSafe(F.col(want).cast("timestamp"))).count() == 0


def test_merge_rules(spark):
    rows = [("s", datetime(2024, 1, 1), v, f, p) for v, f, p in [(1, "a", 0), (2, "a", 1), (3, "b", 0)]]
    df = spark.createDataFrame(rows, "segment_id string, time timestamp, fcd_coverage int, source_file string, position int")
    pick = lambda **k: O.merge_observations(df, **k).collect()[0].fcd_coverage
    assert pick() == 2
    assert pick(last_in_file=False) == 1
    assert pick(first_file=False) == 3
    base = spark.createDataFrame([("s", datetime(2024, 1, 1), 9, "z", 0)], df.schema)
    assert pick(base=base) == 9
    report = O.merge_report(df).collect()[0]
    assert (report.records_scanned, report.records_new) == (3, 1)


def test_order_and_batching_do_not_matter(spark, landing, tmp_path):
    obs, _, _ = jobs.ingest(spark, str(landing))
    for files_per_batch in (1, 2, 50):
        out = str(tmp_path / f"obs{files_per_batch}")
        streams.stream_fcd(spark, str(landing), out, str(tmp_path / f"c{files_per_batch}"),
                           follow=False, files_per_batch=files_per_batch).awaitTermination(120)
        stored = tables.read_series(spark, out).drop("date")
        keys = ["segment_id", "time"]
        assert Q.same_rows(stored, obs.select(*stored.columns), keys).count() == 0


def test_stream_goes_on_where_it_stopped(spark, landing, tmp_path):
    out, check = str(tmp_path / "obs"), str(tmp_path / "check")
    run = lambda: streams.stream_fcd(spark, str(landing), out, check, follow=False).awaitTermination(120)
    run()
    land(landing, {"2025-03-10T02-15-00.json": {"detailedSegments": [seg("late", (1, 2, 3), 100, QUAY)]}})
    run()
    got = as_map(tables.read_series(spark, out))
    assert got == {**WANT, ("late", 15): (10, 1.0)}


GOOD = {"segmentId": {"12": {"geometry": {"type": "LineString", "coordinates": [[26.3, 61.4], [26.5, 6.1e1]]},
        "detailedSegment": {"date": {"2024-01-01T12:00:00": {"properties": {"fcd_coverage": 3}}}}}}}


def broken(**change):
    doc = json.loads(json.dumps(GOOD))
    change["f"](doc["segmentId"])
    return doc


def test_document_rules(spark):
    def drop(key):
        return lambda m: m["12"].pop(key)

    def put(path, value):
        def f(m):
            target = m["12"]
            for k in path[:-1]:
                target = target[k]
            target[path[-1]] = value
        return f

    cases = {
        "good": (GOOD, None),
        "no_map": ({"segmentId": [1]}, "no_segments"),
        "letters": ({"segmentId": {"x1": GOOD["segmentId"]["12"]}}, "id_not_digits"),
        "number": ({"segmentId": {"1": 5}}, "entry_not_object"),
        "no_geometry": (broken(f=drop("geometry")), "keys_missing"),
        "text_geometry": (broken(f=put(["geometry"], "x")), "geometry_not_object"),
        "point": (broken(f=put(["geometry", "type"], "Point")), "not_a_line"),
        "ints": (broken(f=put(["geometry", "coordinates"], [[26, 61.4]])), "bad_coordinates"),
        "triple": (broken(f=put(["geometry", "coordinates"], [[26.0, 61.4, 1.0]])), "bad_coordinates"),
        "empty_line": (broken(f=put(["geometry", "coordinates"], [])), None),
        "empty_detail": (broken(f=put(["detailedSegment"], {})), "detail_not_object"),
        "date_list": (broken(f=put(["detailedSegment", "date"], [])), "date_not_object"),
    }
    df = spark.createDataFrame([(k, json.dumps(v[0])) for k, v in cases.items()], "source_file string, document string")
    got = {r.source_file: r.rule for r in O.document_violations(df).collect()}
    assert got == {k: v[1] for k, v in cases.items() if v[1]}
    assert {r.source_file for r in O.valid_obs_documents(df).collect()} == {"good", "empty_line"}
    row = O.rows_from_document(df.filter("source_file = 'good'")).collect()[0]
    assert (row.segment_id, row.time, row.properties) == ("12", datetime(2024, 1, 1, 12), {"fcd_coverage": "3"})


def test_parse_text_equals_files(spark, landing):
    docs = [(n, json.dumps(d)) for n, d in FILES.items()]
    random.Random(1).shuffle(docs)
    df = spark.createDataFrame(docs, "file_name string, document string")
    good, _ = snapshots.split_good(snapshots.parse_snapshot_text(df))
    assert as_map(O.merge_observations(O.snapshots_to_obs(good))) == WANT


def test_stream_refreshes_map_and_lineage(spark, tmp_path):
    folder, root, obs = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "obs")
    folder.mkdir()
    near = [[x, y + 0.00002] for x, y in QUAY]
    bad = str(tmp_path / "bad")
    after = jobs.refresh_map_and_lineage(root, {"fcd": (obs, ["fcd_coverage"])}, 24)

    def step(name, *entries):
        land(folder, {name: {"detailedSegments": [seg(sid, (1, 2, 3), 100, shape) for sid, shape in entries]}})
        streams.stream_fcd(spark, str(folder), obs, str(tmp_path / "check"), follow=False, after_batch=after,
                           rejects_path=bad, report_path=str(tmp_path / "report")).awaitTermination(300)
        log = {r.segment_id: r for r in tables.load_table(spark, f"{root}/changelog").collect()}
        gone = {r.segment_id for r in tables.load_table(spark, f"{root}/archive", schemas.ARCHIVE).collect()}
        return log, gone

    other = [[x, y + 0.02] for x, y in QUAY]
    step("2024-01-01T12-00-00.json", ("old", QUAY), ("far", other))
    # A file of one folder only: nobody leaves the map.
    log, gone = step("2024-01-01T12-30-00.json", ("far", other))
    assert set(log) == {"old", "far"} and gone == set()
    # Away for more than an hour, with a new id on its line: archived, inherited, renamed.
    log, gone = step("2024-01-01T13-15-00.json", ("new", near), ("far", other))
    assert set(log) == {"new", "far"} and gone == {"old"}
    assert log["new"].geo_inherited_from == "old" and log["new"].timeseries_migrated_at == datetime(2024, 1, 1, 13, 15)
    assert {(r.segment_id, r.time.hour) for r in tables.read_series(spark, obs).collect()} == {("new", 12), ("new", 13), ("far", 12), ("far", 13)}
    assert {r.segment_id for r in tables.load_table(spark, f"{root}/map").collect()} == {"new", "far"}
    # After an outage one small file tells too little about the network.
    many = [(f"m{i}", [[x, y + 0.05 + i / 100] for x, y in QUAY]) for i in range(6)]
    step("2024-01-01T13-20-00.json", *many)
    log, gone = step("2024-01-01T18-00-00.json", ("far", other))
    assert len(log) == 8 and gone == {"old"}
    land(folder, {"2024-01-01T18-05-00.json": b'{"detailedSegments": ['})
    streams.stream_fcd(spark, str(folder), obs, str(tmp_path / "check"), follow=False, rejects_path=bad).awaitTermination(300)
    assert [r.reason for r in spark.read.parquet(bad).collect()] == ["malformed_json"]
    assert spark.read.parquet(str(tmp_path / "report")).groupBy("status").sum("files").collect()[0][1] == 5


def test_folder_stamped_files_in_short_and_long_ranges(spark, tmp_path):
    folder = tmp_path / "land" / "2024-01-05T10-00-00"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text(json.dumps(FILES["2025-03-10T00-05-00.json"]))
    counts = []
    for days in (30, 61, 62, 100, 400):
        files = snapshots.read_fcd_snapshots(spark, str(tmp_path / "land"), datetime(2024, 1, 1), datetime(2024, 1, 1) + timedelta(days=days), one_per_file=False)
        counts.append(files.count())
    assert counts == [1] * 5


def test_backfill_then_follow(spark, landing, tmp_path):
    out = str(tmp_path / "obs")
    query = streams.backfill_then_follow(
        spark, str(landing), out, str(tmp_path / "check"), every="1 second")
    try:
        assert as_map(tables.read_series(spark, out)) == WANT
        land(landing, {"2025-03-10T02-15-00.json": {"detailedSegments": [seg("late", (1, 2, 3), 100, QUAY)]}})
        query.processAllAvailable()
        assert as_map(tables.read_series(spark, out)) == {**WANT, ("late", 15): (10, 1.0)}
    finally:
        query.stop()


def test_only_the_days_of_a_range_are_listed(spark, landing):
    doc = {"detailedSegments": [seg("far", (1, 2, 3), 100, QUAY)]}
    for name in ("east/2025-03-10T00-50-00.json", "2025-03-10T03-00-00/part-0.json", "day=2025-03-11T00-00-00/part-0.json",
                 "2025-03-10T03-00-00/2025-03-10T03-10-00.json", "west/2025-01-01T00-00-00.json"):
        (landing / name).parent.mkdir(exist_ok=True)
        (landing / name).write_text(json.dumps(doc))
    (landing / "2024-12-31T00-00-00.json").write_text("broken")
    day = datetime(2025, 3, 10)
    paths = snapshots.landing_paths(spark, str(landing), day, day)
    assert {p.removeprefix(f"{landing}/") for p in paths} == {"2025-03-10*", "*/2025-03-10*"} or len(paths) == 2
    read = lambda a, b, **k: snapshots.read_fcd_snapshots(spark, str(landing), a, b, **k)
    got = read(day, day + timedelta(days=1, hours=1))
    want = snapshots.read_fcd_snapshots(spark, str(landing)).filter(F.col("file_time").between(F.lit(day), F.lit(day + timedelta(days=1, hours=1))))
    names = lambda df: sorted((r.file_path.rsplit("landing", 1)[1], r.file_time) for r in df.collect())
    assert names(got) == names(want) and got.count() == 7
    # Folders can be named; what lies elsewhere is not looked at.
    assert [n for n, _ in names(read(day, day + timedelta(hours=1), folders=["west"]))] == [f"/2025-03-10T00-{m}-00.json" for m in ("05", "20", "40")]
    assert read(datetime(2030, 1, 1), datetime(2031, 1, 1)).count() == 0
    long = snapshots.landing_prefixes(datetime(2023, 12, 30), datetime(2025, 2, 2))
    assert long == ["2023-12-30", "2023-12-31", "2024-", "2025-01-", "2025-02-01", "2025-02-02"]
