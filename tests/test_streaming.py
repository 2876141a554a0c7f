from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadflow import schemas
from roadflow.operators import validation as V
from roadflow.sources import tables
from roadflow.streaming import jobs
from roadflow.streaming.closure import Closure, stream_closure
from tests.test_validation import expected, random_case

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("steps", [1, 4])
def test_state_over_batches_equals_one_batch(spark, tmp_path, steps):
    series, profile = random_case(21, segments=3, n=120)
    want = expected(series, profile)
    schema = "segment_id string, time timestamp, fcd int"
    live = str(tmp_path / "live")
    size = 120 // steps
    for i in range(steps):
        lo, hi = T0 + timedelta(minutes=5 * size * i), T0 + timedelta(minutes=5 * size * (i + 1))
        part = [r for r in series if lo <= r[1] < hi]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(live)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(live)
    matched = jobs.with_profile(stream, spark.createDataFrame(profile, schemas.PROFILE))
    out = str(tmp_path / "out")
    jobs.write_rows(stream_closure(matched, late="0 seconds"), out, str(tmp_path / "check")).awaitTermination(300)
    got = spark.read.parquet(out).collect()
    assert len(got) == len(want)
    for r in got:
        mean, zeros, low, _ = want[r.segment_id, r.time]
        assert (r.consecutive_zeros, r.consecutive_low) == (zeros, low)
        assert r.running_mean == pytest.approx(mean, abs=1e-12)


def test_batches_with_stored_state(spark, tmp_path):
    """Each micro-batch restarts the counters and goes on with the stored mean and last row."""
    series, profile = random_case(22, segments=2, n=60)
    schema = "segment_id string, time timestamp, fcd int"
    live, profiles = str(tmp_path / "live"), str(tmp_path / "profiles")
    frame = spark.createDataFrame(profile, schemas.PROFILE)
    tables.save_table(frame, profiles)
    cut = T0 + timedelta(minutes=5 * 30)
    halves = [[r for r in series if r[1] < cut], [r for r in series if r[1] >= cut]]
    out, status, check = (str(tmp_path / n) for n in ("out", "status", "check"))
    for half in halves:
        spark.createDataFrame(half, schema).coalesce(1).write.mode("append").parquet(live)
        stream = spark.readStream.schema(schema).parquet(live)
        jobs.stream_validation(spark, stream, profiles, out, status, check).awaitTermination(300)
    first = V.validate(spark.createDataFrame(halves[0], schema), frame)
    second = V.validate(spark.createDataFrame(halves[1], schema), frame, first)
    want = {(r.segment_id, r.time): r.running_mean for r in first.union(second).collect()}
    got = {(r.segment_id, r.time): r.running_mean for r in tables.read_series(spark, out).collect()}
    assert got == pytest.approx(want)


def test_windows_update_and_close(spark, tmp_path):
    schema = "segment_id string, time timestamp, fcd int"
    folder = str(tmp_path / "in")
    rows = [("a", T0 + timedelta(minutes=m), m) for m in (0, 3, 4, 7, 200)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder)
    stream = lambda: spark.readStream.schema(schema).parquet(folder)
    out = str(tmp_path / "closed")
    jobs.write_rows(jobs.tumbling_last(stream(), "fcd"), out, str(tmp_path / "c1")).awaitTermination(120)
    closed = {r.time.minute: r.fcd for r in spark.read.parquet(out).collect()}
    assert closed == {0: 4, 5: 7}
    out = str(tmp_path / "all")
    jobs.write_updates(jobs.tumbling_last(stream(), "fcd"), out, str(tmp_path / "c2")).awaitTermination(120)
    assert jobs.newest_updates(spark, out, ["segment_id", "time"]).count() == 3


def test_late_rows_go_to_repair(spark, tmp_path):
    schema = "segment_id string, time timestamp, fcd int"
    folder = str(tmp_path / "in")
    for minutes in ([0, 0, 10, 300], [300, 301], [20]):
        rows = [("a", T0 + timedelta(minutes=m), m) for m in minutes]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = str(tmp_path / "out")
    jobs.write_rows(jobs.drop_late_and_duplicate(stream), out, str(tmp_path / "c")).awaitTermination(120)
    stored = spark.read.parquet(out)
    minute = (F.unix_timestamp("time") - int(T0.timestamp())) / 60
    assert sorted(int(r[0]) for r in stored.select(minute).collect()) == [0, 10, 300, 301]
    late = jobs.too_late(spark.read.parquet(folder), stored).collect()
    assert [r.fcd for r in late] == [20]


def test_rows_not_newer_change_no_state_and_are_marked():
    at = lambda m: int((T0 + timedelta(minutes=m) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    closure = Closure()
    feed = lambda *minutes: [closure.step(at(m), 0.0, 5.0, 5.0, 5.0) for m in minutes]
    assert [r[-1] for r in feed(10, 15)] == [False, False]
    before = closure.stored()
    late = feed(5, 10)
    assert [r[-1] for r in late] == [True, True] and [r[4] for r in late] == [None, None]
    assert closure.stored() == before
    assert [r[-1] for r in feed(5, 20)] == [True, False]


def follow(spark, tmp_path, profile, steps, **options):
    """Rows landed and streamed step by step on one checkpoint; the rows that came out."""
    schema = "segment_id string, time timestamp, fcd int"
    live, out, check = (str(tmp_path / n) for n in ("live", "out", "check"))
    for rows in steps:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(live)
        stream = spark.readStream.schema(schema).parquet(live)
        matched = jobs.with_profile(stream, spark.createDataFrame(profile, schemas.PROFILE))
        jobs.write_rows(stream_closure(matched, **options), out, check).awaitTermination(300)
    return spark.read.parquet(out).collect(), check


def end(minutes):
    return [("~", T0 + timedelta(minutes=minutes), None)]


def test_rows_out_of_order_within_the_lateness(spark, tmp_path):
    """Steps that overlap and are shuffled give what ordered rows give."""
    import random

    series, profile = random_case(23, segments=2, n=90)
    want = expected(series, profile)
    rnd = random.Random(1)
    mixed = sorted(series, key=lambda r: r[1] + timedelta(minutes=rnd.randrange(100)))
    steps = [mixed[:60], mixed[60:130], mixed[130:], end(9000)]
    got, _ = follow(spark, tmp_path, profile, steps, late="3 hours")
    assert len(got) == len(want)
    for r in got:
        mean, zeros, low, _ = want[r.segment_id, r.time]
        assert not r.late and (r.consecutive_zeros, r.consecutive_low) == (zeros, low)
        assert r.running_mean == pytest.approx(mean, abs=1e-12)


def test_hot_segment_in_many_frames(spark, tmp_path):
    """A micro-batch of one segment that comes in many Arrow batches, in no order."""
    series, profile = random_case(24, segments=1, n=400)
    want = expected(series, profile)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "16")
    try:
        got, _ = follow(spark, tmp_path, profile, [series[::2] + series[1::2][::-1], end(90_000)], late="1 hour")
    finally:
        spark.conf.set(name, before)
    assert len(got) == len(want)
    assert max(abs(r.running_mean - want[r.segment_id, r.time][0]) for r in got) < 1e-12


def test_retired_segment_loses_its_state(spark, tmp_path):
    series, profile = random_case(25, segments=2, n=40)
    gone = {r[0] for r in series if r[0] == max(x[0] for x in series)}
    day = timedelta(days=1)
    later = [(s, t + 9 * day, f) for s, t, f in series if s not in gone]
    got, check = follow(spark, tmp_path, profile, [series, later, end(60 * 24 * 10)], late="1 hour", retire_days=3)
    # After nine days of silence the other segment began anew, as a series of its own.
    first = {r.time: r.running_mean for r in got if r.segment_id not in gone and r.time < T0 + 5 * day}
    second = {r.time - 9 * day: r.running_mean for r in got if r.segment_id not in gone and r.time >= T0 + 5 * day}
    start = min(first)
    assert first[start] == second[start] == 0.5
    state = spark.read.format("statestore").option("stateVarName", "closure").load(check)
    assert gone.isdisjoint({r.key[0] for r in state.select("key").collect()})


def test_profile_by_the_time_of_the_row(spark, tmp_path):
    series, profile = random_case(26, segments=2, n=30)
    path, cut = str(tmp_path / "versions"), T0 + timedelta(minutes=60)
    one = spark.createDataFrame(profile, schemas.PROFILE)
    jobs.save_profile_version(one, path, T0 + timedelta(minutes=10))
    live = spark.createDataFrame(series, "segment_id string, time timestamp, fcd int")
    before = {(r.segment_id, r.time): r.fcd_mean_median for r in jobs.profile_in_force(live, path).collect()}
    jobs.save_profile_version(one.withColumn("fcd_mean_median", F.lit(77.0)), path, cut)
    after = {(r.segment_id, r.time): r.fcd_mean_median for r in jobs.profile_in_force(live, path).collect()}
    assert before.keys() == after.keys() == {(r[0], r[1]) for r in series}
    for (s, t), v in after.items():
        assert v == (None if t < T0 + timedelta(minutes=10) else before[s, t] if t < cut or before[s, t] is None else 77.0)
    assert jobs.profile_in_force(live.limit(0), path).count() == 0


def test_closed_windows_are_stored_once_and_merged(spark, tmp_path):
    schema = "segment_id string, time timestamp, fcd int"
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for minutes in ((0, 3, 7), (9, 80), (12, 200), (3000,)):
        rows = [(s, T0 + timedelta(minutes=m), m) for m in minutes for s in "ab"]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        jobs.store_closed(jobs.tumbling_last(stream, "fcd"), out, "fcd", check).awaitTermination(120)
    read = lambda: sorted((r.segment_id, (r.time - T0) // timedelta(minutes=1), r.fcd) for r in tables.read_series(spark, out).collect())
    want = sorted((s, m // 5 * 5, m) for s in "ab" for m in (3, 9, 80, 200))
    assert read() == want
    assert tables.merge_small_files(spark, out, T0.date()) == 0
    assert tables.merge_small_files(spark, out, T0.date() + timedelta(days=1)) > 0
    assert read() == want and tables.merge_small_files(spark, out, T0.date() + timedelta(days=1)) == 0


def test_bucketed_profiles_are_not_shuffled(spark, tmp_path):
    from roadflow.operators import profile as P

    series, profile = random_case(27, segments=5, n=30)
    frame, path = spark.createDataFrame(profile, schemas.PROFILE), str(tmp_path / "profiles")
    P.store_profiles(frame, "profiles_test", path, 8)
    stored = P.open_profiles(spark, "profiles_test", path, schemas.PROFILE, 8)
    live = spark.createDataFrame(series, "segment_id string, time timestamp, fcd int")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        bucketed, plain = plan(V.match_profile(live, stored)), plan(V.match_profile(live, frame))
        assert bucketed.count("Exchange hashpartitioning") == 1 < plain.count("Exchange hashpartitioning")
    finally:
        spark.conf.set(name, before)
    some = sorted({r[0] for r in profile})[:1]
    assert {r.segment_id for r in P.read_profile(stored, some).collect()} == set(some)
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")  # only then the plan tells how many buckets are read
    try:
        assert "SelectedBucketsCount: 1 out of 8" in plan(P.read_profile(spark.table("profiles_test"), some))
    finally:
        spark.conf.unset(auto)
    spark.sql("DROP TABLE profiles_test")
