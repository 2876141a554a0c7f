import itertools
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadflow import config as cfg
from roadflow import schemas
from roadflow.operators import profile as P
from roadflow.operators import runs, series

T0 = datetime(2025, 1, 6)
SLOTS = "segment_id string, time timestamp, fcd_coverage int"
HOURS = "segment_id string, hour_of_date timestamp, fcd_mean double, max_consecutive_zeros int, max_consecutive_zeros_or_ones int"


def ts(t):
    return F.lit(t)


def longest(values, hit):
    return max((sum(1 for _ in g) for k, g in itertools.groupby(values, key=hit) if k), default=0)


def random_slots(seed, days, density):
    rng = random.Random(seed)
    rows = []
    for s in ("a", "b"):
        for i in range(days * 288):
            if rng.random() < density:
                rows.append((s, T0 + timedelta(minutes=5 * i), rng.choice([0, 0, 0, 1, 1, 4, 9, None])))
    return rows


def dense_pandas(rows, segment, start, end):
    index = pd.date_range(start, end, freq="5min", inclusive="left")
    values = pd.Series({t: v for s, t, v in rows if s == segment}, dtype="float64")
    return values.reindex(index).fillna(0).astype(int)


@pytest.mark.parametrize("density", [0.05, 0.5, 1.0])
def test_hourly_equals_dense_grid(spark, density):
    rows = random_slots(7, 3, density)
    start, end = T0 + timedelta(hours=5), T0 + timedelta(days=2, hours=20)
    df = spark.createDataFrame(rows, SLOTS)
    got = {(r.segment_id, r.hour_of_date): (r.fcd_mean, r.max_consecutive_zeros, r.max_consecutive_zeros_or_ones)
           for r in P.hourly_coverage(df, ts(start), ts(end)).collect()}
    want = {}
    for s in ("a", "b"):
        grid = dense_pandas(rows, s, start, end)
        for hour, values in grid.groupby(grid.index.floor("h")):
            v = list(values)
            want[s, hour.to_pydatetime()] = (np.mean(v), longest(v, lambda x: x == 0), longest(v, lambda x: x in (0, 1)))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])
    # The sparse arithmetic and the materialised grid agree.
    grid = series.dense_grid(df, ts(start), ts(end), ["fcd_coverage"], closed=False)
    dense = P.hourly_coverage(grid)
    assert {(r.segment_id, r.hour_of_date): (r.fcd_mean, r.max_consecutive_zeros, r.max_consecutive_zeros_or_ones) for r in dense.collect()} == got


def test_minute_samples(spark):
    rows = [("a", T0 + timedelta(minutes=i), 0 if i < 40 or i > 45 else 5) for i in range(60)]
    r = P.hourly_coverage(spark.createDataFrame(rows, SLOTS), samples_per_hour=60).collect()[0]
    assert (r.fcd_mean, r.max_consecutive_zeros) == (0.5, 40)


def hourly_rows(weeks, mean=5.0, zeros=2, low=3):
    return [("s", datetime(2025, 1, 1) + timedelta(hours=h), mean, zeros, low) for h in range(weeks * 168)]


def build(spark, rows, min_weeks=1, gate=True):
    masked = P.profile_from_hourly(spark.createDataFrame(rows, HOURS), min_weeks)
    return P.gated_profile(masked) if gate else masked


def test_profile_values_and_order(spark):
    rows = hourly_rows(26)
    got = build(spark, rows, 10).collect()
    assert len(got) == 168
    assert {tuple(r)[3:] for r in got} == {(5.0, 2.0, 3.0, 26)}
    random.Random(42).shuffle(rows)
    assert set(build(spark, rows, 10).collect()) == set(got)
    assert build(spark, [], 1).count() == 0


def test_profile_equals_pandas(spark):
    rng = random.Random(3)
    rows = [(s, T0 + timedelta(hours=h), rng.randint(0, 120) / 12, z := rng.randint(0, 12), min(12, z + rng.randint(0, 3)))
            for s in ("a", "b") for h in range(5 * 168)]
    got = {(r.segment_id, r.day_of_week, r.hour_of_day): (r.fcd_mean_median, r.max_consecutive_zeros_q95, r.max_consecutive_zeros_or_ones_q95, r.number_of_hours)
           for r in P.hour_of_week_profile(spark.createDataFrame(rows, HOURS)).collect()}
    df = pd.DataFrame(rows, columns=["s", "t", "m", "z", "l"])
    df["d"], df["h"] = df.t.dt.day_name(), df.t.dt.hour
    q = lambda x: x.quantile(0.95)
    want = df.groupby(["s", "d", "h"]).agg(m=("m", "median"), z=("z", q), l=("l", q), n=("m", "count")).round(1)
    assert got == {k: (r.m, r.z, r.l, int(r.n)) for k, r in want.iterrows()}


def test_dead_hours(spark):
    lows = [60] * 4 + [3] + [60] * 5 + [7] + [60] * 6
    rows = [("s", T0 + timedelta(hours=i), 1.0, 2, v) for i, v in enumerate(lows)]
    got = sorted(P.mask_dead_hours(spark.createDataFrame(rows, HOURS)).collect(), key=lambda r: r.hour_of_date)
    masked = [r.max_consecutive_zeros is None for r in got]
    assert masked == [False] * 5 + [True] * 5 + [False] + [True] * 6
    assert all(r.fcd_mean == 1.0 for r in got)


def gate_case(spark, below, at_limit, nulls=0):
    values = [34.9] * below + [35.0] * at_limit + [None] * nulls
    rows = [("s", "Monday", i, 1.0, v, v, 4) for i, v in enumerate(values)]
    return P.profile_quality_gate(spark.createDataFrame(rows, schemas.PROFILE)).collect()


def test_gate(spark):
    assert gate_case(spark, 30, 10)[0].accepted
    assert not gate_case(spark, 29, 50)[0].accepted
    r = gate_case(spark, 29, 0, 60)[0]
    assert (r.accepted, r.usable_buckets, r.buckets, r.reason) == (False, 29, 89, "too_few_usable_buckets")
    assert gate_case(spark, 0, 0) == []


def test_masked_buckets_are_filled_after_the_gate(spark):
    got = build(spark, hourly_rows(4) + [("t", T0, 1.0, 1, 1)], min_weeks=4).collect()
    assert {r.segment_id for r in got} == {"s"}
    rows = hourly_rows(4)[: 3 * 168 + 100]
    filled = [r for r in build(spark, rows, 4).collect() if r.number_of_hours < 4]
    assert filled and all(tuple(r)[3:6] == (0.0, 60.0, 60.0) for r in filled)


def test_min_weeks():
    assert [cfg.min_weeks_for(w) for w in (1, 4, 13, 26)] == [1, 1, 5, 10]


def test_build_profiles_from_observations(spark):
    rows = [(s, t + timedelta(seconds=7), v) for s, t, v in random_slots(1, 28, 0.8)]
    df = spark.createDataFrame(rows, SLOTS)
    got = P.build_profiles(df, ts(T0), ts(T0 + timedelta(days=28)), 1)
    assert got.count() == 2 * 168
    assert got.filter("number_of_hours <> 4").count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from([0, 1, 5, None]), st.integers(0, 3)), max_size=60))
def test_chunked_streaks_equal_plain_ones(spark, items):
    rows = [(k, i, c, v) for i, (k, v, c) in enumerate(sorted(items, key=lambda x: x[2]))]
    df = spark.createDataFrame(rows, "k string, i int, c int, v int")
    conditions = {"zeros": F.col("v") == 0, "low": F.col("v") <= 1}
    plain = {(r.k, r.i): (r.zeros, r.low) for r in runs.streaks(df, ["k"], ["i"], conditions).collect()}
    cut = {(r.k, r.i): (r.zeros, r.low) for r in runs.streaks(df, ["k"], ["i"], conditions, F.col("c")).collect()}
    want, run = {}, {}
    for k, i, _, v in rows:
        z, w = run.get(k, (0, 0))
        run[k] = (z + 1 if v == 0 else 0, w + 1 if v in (0, 1) else 0)
        want[k, i] = run[k]
    assert plain == want and cut == want
    best = {r.k: (r.zeros, r.low) for r in runs.longest_true_run(df, ["k"], ["i"], conditions, F.col("c")).collect()}
    assert best == {k: (max(want[q][0] for q in want if q[0] == k), max(want[q][1] for q in want if q[0] == k)) for k in {r[0] for r in rows}}
