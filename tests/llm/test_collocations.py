import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from roadflow.llm import collocations as C


def plain(rows, least, most=2000):
    """Every contiguous phrase of up to five words, counted one by one."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for size in range(1, min(5, len(words) - i) + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    out = []
    for (lang, p), a in f.items():
        if len(p) == 1 or a < least:
            continue
        if any(q[0] == lang and len(q[1]) > len(p) and c >= least and 100 * c >= 100 * a and any(q[1][i : i + len(p)] == p for i in range(len(q[1]))) for q, c in f.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = []
    for lang in sorted({r[0] for r in out}):
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:most])]
    return ranked


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def sample(seed=3):
    rnd = random.Random(seed)
    words = ["The", "of", "and\tso", "é", "\U0001f600", "x", "yy", "zzz", "stop.", "go,", "a\x0bb", "c\x0cd", "\x85", "\xa0w", "q;", "r!", "s?", "t:"]
    rows = [(rnd.choice(["en", "en", "de", None]), " ".join(rnd.choices(words, k=rnd.randrange(60)))) for _ in range(150)]
    rows += [("en", "One very common passage of words, and a tail")] * 40
    return rows + [("en", None), ("de", ""), (None, " \t .. ;"), ("fr", "only once"), ("en", "of  the\t\tx " * 2000), ("en", "w" * 200_000)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as f", "'k' as phrase", "2 as n", "3 as lead", "4 as bit")


def test_equals_brute_force(shipped):
    rows = sample()
    assert rows_of(C.ranked(C.collocations(frame(shipped, rows), 10))) == plain(rows, 10)


def test_hot_leads_and_small_steps(shipped, monkeypatch):
    """The same rows when nearly every lead is routed by more words and texts are cut into many steps."""
    rows = sample(4)
    monkeypatch.setattr(C, "HOT_LEAD", 3)
    monkeypatch.setattr(C, "SORT_ROWS", 5)
    monkeypatch.setattr(C, "STEP_CHARS", 500)
    assert rows_of(C.ranked(C.collocations(frame(shipped, rows), 10), 50)) == plain(rows, 10, 50)


def test_shared_bits_let_nothing_be_lost(shipped, monkeypatch):
    monkeypatch.setattr(C, "BITS", 64)
    rows = sample(5)
    assert rows_of(C.ranked(C.collocations(frame(shipped, rows), 12))) == plain(rows, 12)


def test_empty(shipped):
    df = frame(shipped, sample())
    assert C.ranked(C.collocations(df.limit(0))).count() == 0
    assert C.ranked(C.collocations(df.filter("text is null"))).count() == 0


def test_products_beyond_64_bits(shipped):
    """a * n * 1000 is above 2 ** 63 for counts like these."""
    big = shipped.sql("select cast(9000000000000 as decimal(19,0)) * cast(90000000000001 as decimal(19,0)) as _top, cast(9000000000007 as decimal(19,0)) * cast(9000000000000 as decimal(19,0)) as _below")
    assert big.selectExpr("cast(_top * 1000 as decimal(38, 0)) div _below as s").first().s == 1000 * 90000000000001 // 9000000000007


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=4), st.integers(1, 4)), min_size=1, max_size=60), st.integers(1, 12))
def test_quicksort_counts(rows, least):
    keys = np.full((len(rows), 4), -1)
    want = Counter()
    for i, (k, w) in enumerate(rows):
        keys[i, : len(k)] = k
        for d in range(1, len(k) + 1):
            want[tuple(k[:d])] += w
    got = {tuple(keys[i, :d].tolist()): n for i, d, n in C.quicksort_counts(keys, np.array([w for _, w in rows]), least)}
    assert got == {k: n for k, n in want.items() if n >= least}
