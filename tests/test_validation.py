import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadflow import schemas
from roadflow.operators import validation as V
from tests.closure_oracle import closure_means

T0 = datetime(2024, 1, 1)
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def profile_rows(segment, values, hours=range(24)):
    return [(segment, d, h, *map(lambda v: None if v is None else float(v), values), 4) for d in DAYS for h in hours]


def series_rows(segment, values):
    return [(segment, T0 + timedelta(minutes=5 * i), v) for i, v in enumerate(values)]


def run(spark, series, profile, stored=None):
    s = spark.createDataFrame(series, "segment_id string, time timestamp, fcd int")
    p = spark.createDataFrame(profile, schemas.PROFILE)
    return V.validate(s, p, stored)


@pytest.mark.parametrize(
    "values, profile, first, last",
    [
        ([0] * 288, (4, 5, 6), [0.5, 0.4959, 0.4959, 0.4959], 1.0),
        ([0] * 288, (0, 60, 60), [0.5, 0.4885, 0.4776, 0.4674], 0.3761),
        ([8] * 50, (8, 5, 5), [0.5, 0.1923, 0.074, 0.0284], 0.0),
        ([4] * 50, (4, 5, 5), [0.5, 0.2642, 0.1328, 0.0604], 0.0),
    ],
)
def test_hand_cases(spark, values, profile, first, last):
    rows = run(spark, series_rows("s", values), profile_rows("s", profile)).orderBy("time").collect()
    means = [r.running_mean for r in rows]
    assert [round(m, 4) for m in means[:4]] == first
    assert round(means[-1], 4) == last


def random_case(seed, segments=7, n=400):
    rng = random.Random(seed)
    series, profile = [], []
    for s in range(segments):
        level = rng.choice([0, 1, 3, 6, 9])
        values, v = [], level
        for _ in range(n):
            if rng.random() < 0.25:
                v = min(10, max(0, level + rng.randint(-6, 6)))
            values.append(None if rng.random() < 0.02 else v)
        series += series_rows(f"s{s}", values)
        for d in DAYS:
            for h in range(24):
                if rng.random() < 0.9:
                    q0 = rng.choice([0.0, 2.0, 5.0, 12.0, 55.0, 60.0])
                    profile.append((f"s{s}", d, h, float(rng.choice([0, 1, 2.9, 3, 5, 9.5, 10])), q0, q0 + rng.choice([0, 1, 7]), 4))
    return series, profile


def expected(series, profile, stored=None):
    buckets = {(s, d, h): (mm, q0, q1) for s, d, h, mm, q0, q1, _ in profile}
    out = {}
    for seg in sorted({r[0] for r in series}):
        rows = sorted([r for r in series if r[0] == seg], key=lambda r: r[1])
        dicts = []
        for _, t, v in rows:
            mm, q0, q1 = buckets.get((seg, DAYS[t.weekday()], t.hour), (None, None, None))
            dicts.append(dict(fcd=v, mm=mm, q0=q0, q1=q1))
        for (_, t, _), res in zip(rows, closure_means(dicts, (stored or {}).get(seg))):
            out[seg, t] = res
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_series_equal_row_by_row(spark, seed):
    series, profile = random_case(seed)
    want = expected(series, profile)
    rng = random.Random(seed)
    rng.shuffle(series)
    got = run(spark, series, profile).collect()
    assert len(got) == len(want)
    for r in got:
        mean, zeros, low, _ = want[r.segment_id, r.time]
        assert (r.consecutive_zeros, r.consecutive_low) == (zeros, low)
        assert r.running_mean == pytest.approx(mean, abs=1e-12)
        status = "open" if mean < 0.15 else "closed" if mean > 0.75 else "undetermined"
        assert r.segment_closure_status == status


def test_stored_predecessor_updates_first_row(spark):
    series, profile = random_case(9, segments=2, n=60)
    stored = {"s0": dict(mean=0.8, zeros=4, low=9, q0=6.0, q1=8.0)}
    table = spark.createDataFrame(
        [("s0", T0 - timedelta(minutes=5), 4, 9, 6.0, 8.0, 0.8)],
        "segment_id string, time timestamp, consecutive_zeros int, consecutive_low int, "
        "max_consecutive_zeros_q95 double, max_consecutive_zeros_or_ones_q95 double, running_mean double",
    )
    want = expected(series, profile, stored)
    for r in run(spark, series, profile, table).collect():
        assert r.running_mean == pytest.approx(want[r.segment_id, r.time][0], abs=1e-12)


def test_result_does_not_depend_on_partitions(spark):
    series, profile = random_case(5)
    s = spark.createDataFrame(series, "segment_id string, time timestamp, fcd int")
    p = spark.createDataFrame(profile, schemas.PROFILE)
    a = V.validate(s.repartition(1), p)
    b = V.validate(s.repartition(13, F.rand(3)), p)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_out_of_range_rows_are_listed_not_validated(spark):
    series = series_rows("s", [3, 11, 3, -1])
    frame = spark.createDataFrame(series, "segment_id string, time timestamp, fcd int")
    assert V.coverage_rejects(frame).count() == 2
    assert run(spark, series, profile_rows("s", (4, 5, 6))).count() == 2


def test_current_status(spark):
    rows = run(spark, series_rows("s", [8] * 10), profile_rows("s", (8, 5, 5)))
    got = V.current_status(rows).collect()
    assert [(r.time, r.segment_closure_status) for r in got] == [(T0 + timedelta(minutes=45), "open")]
