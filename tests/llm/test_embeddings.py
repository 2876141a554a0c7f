import numpy as np

from roadflow.llm import embeddings
from roadflow.llm.queries import QUERIES
from tests.llm.conftest import D


def brute(ids, x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    a, b = np.nonzero(near)
    order = np.argsort(ids)
    back = np.argsort(order)
    root = ids[order][embeddings.linked_roots(len(ids), back[a], back[b])][back]
    return {int(i): (int(n), int(r), int(i) == int(r)) for i, n, r in zip(ids, near.sum(1), root, strict=True)}


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return {r[0]: tuple(r)[1:] for r in embeddings.near_duplicates(df, **more).collect()}


def clustered(n, dim, noise, seed):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 6, dim))
    x = np.concatenate([base + noise * rng.standard_normal(base.shape) for _ in range(6)])
    return rng.permutation(len(x)) * 3, x.astype(np.float32)


def test_recall_over_leaves(shipped):
    ids, x = clustered(3000, 32, 0.22, 3)
    want = brute(ids, x.astype(float))
    got = run(shipped, list(zip(ids.tolist(), x.tolist(), strict=True)), leaf=60, sample_rows=1500)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(v[0] for v in got.values()) >= 0.9 * sum(v[0] for v in want.values()) > 0


def test_leaves_are_split_on_beyond_the_sample(shipped):
    """Trees fitted on 64 vectors: further levels are cut by medians of the leaves; knots stay whole."""
    ids, x = clustered(3000, 32, 0.2, 5)
    knot = x[:1] + 0.01 * np.random.default_rng(6).standard_normal((700, 32)).astype(np.float32)
    ids, x = np.concatenate([ids, 10**6 + np.arange(700)]), np.concatenate([x, knot]).astype(np.float32)
    want = brute(ids, x.astype(float))
    got = run(shipped, list(zip(ids.tolist(), x.tolist(), strict=True)), leaf=20, sample_rows=64)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(v[0] for v in got.values()) >= 0.9 * sum(v[0] for v in want.values())
    few = [i for i in want if 0 < want[i][0] < 100]
    assert sum(got[i][0] for i in few) >= 0.9 * sum(want[i][0] for i in few) > 0


def test_large_leaves_in_blocks_are_exact(shipped):
    ids, x = clustered(600, 16, 0.2, 4)
    got = run(shipped, list(zip(ids.tolist(), x.tolist(), strict=True)), leaf=10_000, block=64)
    assert got == brute(ids, x.astype(float))


def test_given_vectors(spark):
    rows = spark.read.parquet(f"{D}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op5_embedding_near_dedup"](spark, D).collect()}
    assert got == brute(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float))


def test_odd_vectors(shipped):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 0.0, 0.0]), (11, [1e-30, -0.0]), (12, [0.0, 1.0])]
    got = run(shipped, rows)
    assert {k: v[:2] for k, v in got.items()} == {
        1: (3, 1), 2: (3, 1), 3: (3, 1), 11: (3, 1), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9), 10: (0, 10), 12: (0, 12),
    }
    assert [k for k, v in got.items() if not v[2]].__len__() == 3
    assert run(shipped, [(1, [1.0])]) == {1: (0, 1, True)}
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<float>").limit(0).selectExpr("*", "1 as rep", "2 as links")
    assert embeddings.near_duplicates(df).count() == 0


def test_repeated_rows(shipped):
    df = shipped.createDataFrame([(1, [1.0, 2.0])] * 3 + [(2, [2.0, 4.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in embeddings.near_duplicates(df).collect()) == [(1, 3, 1, True)] * 3 + [(2, 3, 1, False)]
