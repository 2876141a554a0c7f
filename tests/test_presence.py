from datetime import datetime, timedelta

import pytest

from roadflow import schemas
from roadflow.operators import presence as P
from roadflow.plans import jobs
from roadflow.sources import tables

T0 = datetime(2024, 5, 6, 7)
HOUR, GAP = timedelta(hours=1), timedelta(minutes=45)


def clocks(steps, arrived=lambda s: None):
    """The clock after each batch of minutes after T0, carrying arrivals the way the job does."""
    before, out = [], []
    for batch, minutes in enumerate(steps):
        stamps = [T0 + timedelta(minutes=m) for m in minutes]
        new = [(s, batch, arrived(s)) for s in stamps]
        clock = P.feed_clock(before, new, HOUR, GAP)
        again = P.feed_clock([r for r in before if r[1] < batch], new, HOUR, GAP)
        assert clock == again
        before = P.arrivals_to_keep(before + [(*r, clock and clock.base) for r in new], clock, batch)
        out.append(clock and ((clock.now - T0) / timedelta(minutes=1), clock.gone and (clock.gone - T0) / timedelta(minutes=1)))
    return out


YEAR = 365 * 24 * 60


def test_regular_feed():
    got = clocks([[m] for m in range(0, 120, 5)])
    assert [now for now, _ in got] == list(range(0, 120, 5))
    assert [gone for _, gone in got] == [None] * 12 + list(range(0, 60, 5))


def test_a_stamp_far_ahead_moves_nothing():
    got = clocks([[0], [YEAR], [5], [10], [YEAR + 5], [15, 20]])
    assert [now for now, _ in got] == [0, 0, 5, 10, 10, 20]
    # Even as the very first one it holds the clock only until a second file is there.
    assert [now for now, _ in clocks([[YEAR], [0], [5], [10]])] == [YEAR, 0, 5, 10]


def test_a_redelivered_day_does_not_turn_the_clock_back():
    got = clocks([[0], [5], [10], [-2000, -1995, -1990, -1985, -1980], [15]])
    assert [now for now, _ in got] == [0, 5, 10, 10, 15]


def test_outage_takes_nobody_off_the_map():
    got = clocks([[m] for m in (0, 5, 10, 15, 20, 300, 305, 310, 315)])
    assert [now for now, _ in got] == [0, 5, 10, 15, 20, 20, 20, 310, 315]
    # The pause counts as 45 minutes and the files after it as 10 and 15, so an hour back lies before the pause.
    assert [gone for _, gone in got] == [None] * 7 + [15, 20]


def test_stamps_beyond_their_arrival_are_not_believed():
    late = lambda s: T0 + timedelta(minutes=30)
    assert clocks([[200]], late) == [None]
    assert [c and c[0] for c in clocks([[0], [200], [205], [210], [20]], late)] == [0, 0, 0, 0, 20]


LINES = {f"s{i}": [(24.0 + i, 60.0), (24.001 + i, 60.0)] for i in range(12)}


def obs(spark, ids, minute):
    rows = [(s, LINES[s], T0 + timedelta(minutes=minute), f"file{minute}") for s in ids]
    return spark.createDataFrame(rows, f"segment_id string, coords {schemas.COORDS}, time timestamp, source_file string")


def names(spark, path, schema=None):
    return {r.segment_id for r in tables.load_table(spark, path, schema).collect()}


@pytest.fixture
def job(spark, tmp_path):
    root = str(tmp_path / "state")
    after = jobs.refresh_map_and_lineage(root, {}, 24)
    number = iter(range(100))

    def step(ids, minute, batch=None):
        after(obs(spark, ids, minute), next(number) if batch is None else batch)
        return names(spark, f"{root}/changelog", schemas.CHANGELOG), names(spark, f"{root}/archive", schemas.ARCHIVE)

    step.root = root
    return step


def test_segments_leave_after_a_change_of_the_network(spark, job):
    """Ten segments, then three of them only, an hour apart: the seven leave, and nothing stops."""
    ids = list(LINES)[:10]
    assert job(ids, 0) == (set(ids), set())
    got = [job(ids[:3], 60 * h) for h in range(2, 6)]
    assert got[-1] == (set(ids[:3]), set(ids[3:]))
    cycles = spark.read.parquet(f"{job.root}/cycles").orderBy("batch_id").collect()
    assert [c.skipped for c in cycles] == [None, "all stamps ahead", None, "all stamps ahead", "all stamps ahead"]
    assert sum(c.left_map for c in cycles) == 7 and cycles[-1].present == 3
    assert names(spark, f"{job.root}/map") == set(ids[:3])


def test_new_segments_enter_beside_a_file_from_the_future(spark, job):
    """Ten segments, a file stamped a year ahead, then eleven on time: the eleventh enters."""
    ids = list(LINES)[:11]
    job(ids[:10], 0)
    job(ids[:10], YEAR)
    assert job(ids, 10) == (set(ids), set())
    assert job(ids, 15) == (set(ids), set())
    # What was stamped ahead waits, and holds nobody on the map.
    assert tables.load_table(spark, f"{job.root}/waiting").count() == 10
    for m in (40, 75, 100):
        log, gone = job(ids[1:], m)
    assert log == set(ids[1:]) and gone == {ids[0]}


def test_a_repeated_batch_changes_nothing(spark, job):
    ids = list(LINES)[:6]
    for i, m in enumerate((0, 20, 40, 60)):
        job(ids if m < 20 else ids[:4], m, batch=i)
    tabled = lambda: [sorted(map(str, tables.load_table(spark, f"{job.root}/{n}").collect())) for n in ("changelog", "archive", "map", "seen", "waiting", "arrivals")]
    before = tabled()
    job(ids[:4], 60, batch=3)
    assert tabled() == before
    assert len(tables.versions(spark, f"{job.root}/seen")) == 5


def test_rows_without_a_line_keep_a_segment_alive(spark, job):
    for m in (0, 30, 60, 90):
        both = obs(spark, ["s0"], m).unionByName(spark.createDataFrame([("s1", LINES["s1"] if m == 0 else [], T0 + timedelta(minutes=m), "f")], obs(spark, ["s0"], m).schema))
        jobs.refresh_map_and_lineage(job.root, {}, 24)(both, m)
    assert names(spark, f"{job.root}/map") == {"s0", "s1"}


def test_gap_must_stay_below_the_window():
    with pytest.raises(ValueError):
        jobs.refresh_map_and_lineage("x", {}, window_minutes=30, gap_minutes=30)
