import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadflow.llm import mixing as M
from roadflow.llm.queries import QUERIES
from tests.llm.conftest import D


def fair(sizes, weights):
    """Sizes shared by weight, at most three times each, with plain fractions."""
    from fractions import Fraction

    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = sum(weights[s] for s in sizes if s not in full)
        out = {s: Fraction(3 * sizes[s]) if s in full else Fraction(left * weights[s], free) for s in sizes}
        above = {s for s in sizes if out[s] > 3 * sizes[s]}
        if not above:
            return out
        full |= above


def check(rows, got, block=M.BLOCK_WORDS):
    """``rows``: (doc_id, source, text)."""
    words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += words(t)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = fair(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, words(t)) for d, _, t in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    per, by_size = {}, {s: [x for x in sizes if sizes[x] == sizes[s]] for s in sizes}
    source_of = {(d, words(t)): s for d, s, t in rows}
    for r in got:
        s = source_of[r.doc_id, r.size]
        assert r.source_size in {sizes[x] for x in by_size[s]}
        assert r.target == pytest.approx(float(target[s]))
        per[s] = per.get(s, 0) + r.taken
    for s in sizes:
        assert abs(per[s] - target[s]) <= 1.5 * min(block, max(sizes[s], 1)), s


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "source", "text").collect()]
    got = QUERIES["op12_source_mixing"](spark, D).collect()
    check(rows, got)
    again = QUERIES["op12_source_mixing"](spark, D).collect()
    assert Counter(got) == Counter(again)


#: A hot source, a null source, one without words, tiny sources, repeated rows, null ids and texts, a long text.
ROWS = [(i, "hot", "w " * (i % 50)) for i in range(300)] + [(1000 + i, f"s{i % 4}", "a b\tc\nd " * i) for i in range(40)]
ROWS += [(5000, None, "x " * 900), (5001, None, None), (None, "hot", "nobody's words here"), (5002, "zero", ""), (5003, "Tiny", "one two three")]
ROWS += [(5004, "s1", "twice the same " * 30)] * 2 + [(5005, "é", "long " * 60_000)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 as size", "2 as rank", "'p' as pieces", "3 as start", "4 as _sum")


@pytest.mark.parametrize("slots", [7, 4096])
def test_odd_rows(shipped, slots):
    mixed = M.mixture(frame(shipped, ROWS), shard_slots=slots)
    check(ROWS, M.taken_words(mixed).collect())
    places = mixed.slots.select("shard", "slot").collect()
    assert len(places) == len(set(places))
    assert Counter(r.shard for r in places).most_common(1)[0][1] <= slots


def test_order_of_rows_does_not_matter(shipped):
    rows = lambda df: Counter((r.doc_id, r.taken) for r in M.taken_words(M.mixture(df)).collect())
    assert rows(frame(shipped, ROWS)) == rows(frame(shipped, ROWS[::-1]).repartition(7))


def test_texts_are_the_taken_words(shipped):
    rows = [(i, "ab"[i % 2], " ".join(f"d{i}w{k}" for k in range(i * 3))) for i in range(1, 40)]
    df = frame(shipped, rows)
    mixed = M.mixture(df, block_words=8, shard_slots=16)
    texts = M.mixed_texts(mixed, df).collect()
    taken = Counter(w.split("w")[0] for r in texts for w in r.text.split())
    assert {f"d{r.doc_id}": r.taken for r in M.taken_words(mixed).collect() if r.taken} == dict(taken)
    assert max(len(r.text.split()) for r in texts) == 8


def test_empty(shipped):
    assert M.taken_words(M.mixture(frame(shipped, ROWS).limit(0))).count() == 0
    silent = [(1, "a", None), (2, None, " \n")]
    got = M.taken_words(M.mixture(frame(shipped, silent))).collect()
    assert {(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 10**9))
def test_permutation(n, key):
    assert sorted(M.permuted(np.arange(n), n, key)) == list(range(n))
