import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from roadflow.llm import ngram_join
from roadflow.llm.queries import QUERIES
from tests.llm.conftest import D, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets, holders = {d: shingles(t) for d, t in rows}, defaultdict(list)
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for d, s in sets.items():
        for e, k in Counter(e for x in s for e in holders[x] if e > d).items():
            if 100 * k >= 75 * (len(s) + len(sets[e]) - k):
                a, b = root(d), root(e)
                up[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def check(spark, rows):
    got = {r[0]: (r[1], r[2]) for r in ngram_join.jaccard_components(documents(spark, rows)).collect()}
    assert got == brute(rows)


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: (r[1], r[2]) for r in QUERIES["op3_ngram_jaccard_join"](spark, D).collect()}
    assert got == brute(rows)


def test_near_the_threshold_and_shared_passages(shipped):
    rng, rows = random.Random(5), []
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(60))
    for base in range(6):
        text = [word() for _ in range(rng.choice([9, 30, 120]))]
        for k in range(9):
            copy = list(text)
            for _ in range(k // 2):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy[: len(copy) - k % 3])))
    rows += [(len(rows) + i, f"{' '.join(word() for _ in range(12))} {passage}") for i in range(40)]
    rng.shuffle(rows)
    check(shipped, rows)


def test_links_missed_by_the_first_round_are_found(shipped, monkeypatch):
    # Without the first round every link is left to the cells of rare and of frequent shingles.
    monkeypatch.setattr(ngram_join, "_similar_nodes", lambda placed: placed.selectExpr("rep as cell", "rep", "comp", "n", "bits"))
    rng = random.Random(8)
    words = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(30):
        copy = list(words)
        copy[rng.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(f"y{i}{k}" for k in range(30))) for i in range(10)]
    check(shipped, rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=50, unique=True), min_size=2, max_size=40))
def test_tree_excludes_no_link(lists):
    hashes = np.sort(ngram_join.mix(np.arange(1, 100, dtype=np.uint64)))
    sets = [np.sort(hashes[x]) for x in lists]
    sizes = np.array([len(s) for s in sets])
    tree = ngram_join.SignatureTree(sizes, [ngram_join.bitmap(s) for s in sets], np.arange(len(sets)))
    found = {tuple(sorted(p)) for a, b in tree.candidates() for p in zip(a.tolist(), b.tolist(), strict=True)}
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 4 * both >= 3 * (len(sets[i]) + len(sets[j]) - both):
                assert (j, i) in found


def test_odd_rows(odd, none):
    got = sorted(((r[0] or -1, r[1], r[2]) for r in ngram_join.jaccard_components(odd).collect()), key=str)
    want = [(1, 3, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 3, 1), (5, 3, 1), (-1, 3, None), (6, 1, 6), (7, 1, 7), (8, 3, 8)]
    assert [g for g in got if g[0] != 8] == sorted([w for w in want if w[0] != 8], key=str)
    assert ngram_join.jaccard_components(none).count() == 0


def test_ids_shared_by_texts_take_the_smallest_set(shipped):
    a, b = "a b c d e f", "a b c d e f g h i j k"
    rows = [(3, b), (3, a), (1, a), (2, b)]
    got = sorted(tuple(r) for r in ngram_join.jaccard_components(documents(shipped, rows)).collect())
    assert got == [(1, 2, 1), (2, 7, 2), (3, 2, 1), (3, 7, 1)]


def test_shingles_are_counted_over_all_documents(shipped):
    # Three documents of each of four partitions share a passage: frequent only over all of them.
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(20)) + " " + passage) for i in range(12)]
    texts = documents(shipped, rows).repartition(4, "doc_id")
    found = ngram_join.frequent_shingles(texts)
    assert found.shape == (2, 36) and (found[1] == 12).all() and (np.diff(found[0]) > 0).all()
    # So the passage opens no cell: each document has enough shingles of its own.
    placed = ngram_join.signatures(texts, found).selectExpr("doc_id as rep", "doc_id as comp", "n", "mins", "bits", "prefix")
    assert ngram_join._rare_cells(placed, found).count() == 0 and ngram_join._frequent_cells(placed, found).count() == 0
    assert ngram_join.frequent_shingles(texts.limit(0)).shape == (2, 0)
