"""Work cut into parts: the running mean in chunks of time, profiles from stored hours, newest days first, digests."""

import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadflow import schemas
from roadflow.operators import profile as P
from roadflow.operators import quality as Q
from roadflow.operators import validation as V
from roadflow.sources import tables
from tests.test_validation import expected, random_case

T0 = datetime(2024, 1, 1)
unit = st.floats(0, 1)
STEP = st.tuples(st.floats(1, 60), st.floats(0, 12), unit, st.booleans(), st.floats(0.2, 1))


@settings(max_examples=300, deadline=None)
@given(st.lists(STEP, max_size=40), st.lists(unit, min_size=1, max_size=5))
def test_composed_steps_equal_the_walk(steps, means):
    pieces = [(0.0, 1.0, 0.0)]
    for step in steps:
        pieces = V.compose(pieces, *step)
    assert len(pieces) <= len(steps) + 1 and pieces[0][0] == 0 and [p[0] for p in pieces] == sorted(p[0] for p in pieces)
    for mean in means:
        want = mean
        for p, w, x, raised, alpha in steps:
            want = (p * want + w * (max(want, x) if raised else x)) / (p + w) * alpha
        assert V.apply_pieces(pieces, mean) == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("stored", [False, True])
def test_mean_in_parts_equals_the_sequential_one(spark, stored):
    series, profile = random_case(31, segments=3, n=500)
    live = spark.createDataFrame(series, "segment_id string, time timestamp, fcd int")
    frame = spark.createDataFrame(profile, schemas.PROFILE)
    before = V.validate(live.filter(F.col("time") < T0 + timedelta(hours=5)), frame) if stored else None
    hours = F.floor(F.unix_seconds("time") / 7200)
    rows = lambda df: {(r.segment_id, r.time): (r.running_mean, r.segment_closure_status, r.consecutive_low) for r in df.collect()}
    whole, parts = rows(V.validate(live, frame, before)), rows(V.validate(live, frame, before, chunk=hours))
    assert whole.keys() == parts.keys()
    for key, (mean, status, low) in whole.items():
        assert parts[key][0] == pytest.approx(mean, abs=1e-9) and parts[key][1:] == (status, low)
    if not stored:
        assert max(abs(parts[k][0] - v[0]) for k, v in expected(series, profile).items()) < 1e-9


def test_one_long_segment_is_spread_over_tasks(spark):
    """Steps as the rules make them, 300 000 rows of one segment."""
    n = 300_000
    i = F.col("id")
    draw = lambda salt: (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000)
    rows = spark.range(n).select(
        F.lit("s").alias("segment_id"), F.timestamp_seconds(i * 300).alias("time"),
        (5 + 40 * draw(1)).alias("_p"), F.when(draw(2) < 0.7, 1 + 5 * draw(3)).otherwise(0.0).alias("_w"), draw(4).alias("_x"),
        (draw(5) < 0.5).alias("_floor"), (0.9 + 0.1 * draw(6)).alias("_alpha"), F.when(i == 0, 0.5).alias("_start"),
    )
    whole = V._running_mean(rows.repartition(1)).select("time", F.col("running_mean").alias("m"))
    parts = V._running_mean_in_parts(rows, F.floor(i_of("time") / (300 * 4000)))
    parts = parts.select("time", "running_mean", F.spark_partition_id().alias("task"))
    worst, tasks, count = parts.join(whole, "time").agg(F.max(F.abs(F.col("running_mean") - F.col("m"))), F.count_distinct("task"), F.count("*")).first()
    assert count == n and worst < 1e-9 and tasks > 1


def i_of(column):
    return F.unix_seconds(column)


def test_daily_steps_equal_a_full_build(spark, tmp_path):
    """Weeks move on day by day; dead stretches cross midnight, segments come and go, a day is stored twice."""
    rnd, path = random.Random(4), str(tmp_path / "hours")
    rows = []
    for m in range(0, 24 * 60 * 18, 15):
        t = T0 + timedelta(minutes=m)
        asleep = t.hour >= 21 or t.hour < 3
        rows.append(("steady", t, 0 if asleep else rnd.randrange(11)))
        if m > 24 * 60 * 9:
            rows.append(("late", t, rnd.randrange(4)))
        if m < 24 * 60 * 5:
            rows.append(("gone", t, rnd.randrange(9)))
    obs = spark.createDataFrame(rows, "segment_id string, time timestamp, fcd_coverage int")
    found = lambda df: sorted(map(tuple, df.select("segment_id", "day_of_week", "hour_of_day", *P.VALUE_COLUMNS, "number_of_hours").collect()))
    for k in range(18):
        P.store_hours(obs, path, (T0 + timedelta(days=k)).date())
        if k in (7, 12, 17):
            P.store_hours(obs, path, (T0 + timedelta(days=k)).date())
            start, end = T0 + timedelta(days=k - 7), T0 + timedelta(days=k + 1)
            at = lambda t: F.lit(t)
            for scale in (False, True):
                want = P.build_profiles(obs, at(start), at(end), 1, scale_rules=scale)
                got = P.rolling_profiles(spark, path, start.date(), end.date(), 1, scale)
                assert found(got) == found(want) != []
    assert P.rolling_profiles(spark, path, date(2030, 1, 1), date(2030, 2, 1), 1).count() == 0


def test_past_days_are_stored_in_one_pass(spark, tmp_path):
    """A range of days is as many parts from a fixed number of jobs; stored again, days that lost their rows are empty."""
    path = str(tmp_path / "hours")
    rows = [(f"s{k % 3}", T0 + timedelta(minutes=7 * k), k % 11) for k in range(0, 206 * 12)]
    obs = spark.createDataFrame(rows, "segment_id string, time timestamp, fcd_coverage int")
    first, days = T0.date(), lambda n: T0.date() + timedelta(days=n)
    found = lambda df: sorted(map(tuple, df.collect()))
    jobs = lambda group: len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    for n in (3, 12):
        spark.sparkContext.setJobGroup(f"days-{n}", "")
        P.store_hours(obs, f"{path}-{n}", first, until=days(n))
        spark.sparkContext.setJobGroup("other", "")
        assert tables.stored_days(spark, f"{path}-{n}") == [days(k) for k in reversed(range(n))]
    assert jobs("days-3") == jobs("days-12") > 0
    for k in range(12):
        P.store_hours(obs, path, days(k))
    assert found(spark.read.parquet(f"{path}-12")) == found(spark.read.parquet(path)) != []
    P.store_hours(obs.filter(F.col("time") >= F.lit(T0 + timedelta(days=5))), f"{path}-12", days(2), until=days(9))
    want = found(spark.read.parquet(path).filter(~F.col("date").between(days(2), days(4))))
    assert found(spark.read.parquet(f"{path}-12")) == want


@pytest.fixture
def table(spark, tmp_path):
    def make(name, rows):
        path = str(tmp_path / name)
        tables.write_series(spark.createDataFrame(rows, "segment_id string, time timestamp, v double"), path, ["v"])
        return path

    return make


def points(change=None):
    return [(f"s{s}", T0 + timedelta(days=d, hours=h), 0.5 + (change == (s, d, h))) for s in range(6) for d in range(10) for h in (3, 20) if not (s == 5 and d > 2)]


def test_newest_day_first(spark, table):
    path = table("a", points())
    ids = spark.createDataFrame([(f"s{s}",) for s in (0, 4, 5, 5, 9)], "segment_id string")
    days = lambda **k: {r.segment_id: r.time.day - 1 for r in tables.newest_rows(spark, path, ids, **k).collect()}
    assert tables.stored_days(spark, path)[0] == date(2024, 1, 10) and len(tables.stored_days(spark, path)) == 10
    assert days() == {"s0": 9, "s4": 9, "s5": 2}
    assert days(until=F.lit(T0 + timedelta(days=4))) == {"s0": 3, "s4": 3, "s5": 2}
    assert days(days=3) == {"s0": 9, "s4": 9}
    fresh = Q.freshness_of_table(spark, path, ids, F.lit(T0 + timedelta(days=9, hours=3, minutes=10)), 30)
    assert {r.segment_id: r.mode for r in fresh.collect()} == {"s0": "real_time", "s4": "real_time", "s5": "backfill", "s9": "no_data"}
    # Once all have an answer no older day is looked at: its files may be anything.
    import pathlib

    for f in pathlib.Path(path, "date=2024-01-02").rglob("*.parquet"):
        f.write_bytes(b"broken")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    two = ids.filter("segment_id in ('s0', 's4')")
    assert {r.segment_id for r in tables.newest_rows(spark, path, two).collect()} == {"s0", "s4"}


def test_one_changed_row_reads_one_part(spark, table):
    a, b = table("a", points()), table("b", points((3, 6, 20)))
    parts = Q.unequal_parts(tables.series_digests(spark, a), tables.series_digests(spark, b))
    assert parts == [(date(2024, 1, 7), parts[0][1])]
    got = sorted((r.segment_id, r.time.day, r.v, r.only_in) for r in Q.same_rows_of_tables(spark, a, b).collect())
    assert got == [("s3", 7, 0.5, "a"), ("s3", 7, 1.5, "b")]
    # Kept beside the table, and brought up to date by parts.
    before = tables.versions(spark, f"{a}_digests")
    tables.series_digests(spark, a)
    assert tables.versions(spark, f"{a}_digests") == before
    tables.write_series(spark.createDataFrame([("s3", T0 + timedelta(days=6, hours=20), 1.5)], "segment_id string, time timestamp, v double"), a, ["v"])
    assert Q.same_rows_of_tables(spark, a, b).count() == 0
    assert len(tables.versions(spark, f"{a}_digests")) == len(before) + 1
    tables.drop_segments(spark, a, spark.createDataFrame([("s3",)], "segment_id string"))
    assert {r.only_in for r in Q.same_rows_of_tables(spark, a, b).collect()} == {"b"}
