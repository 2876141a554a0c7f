import random
from collections import Counter

import numpy as np

from roadflow.llm import decontamination
from tests.llm.conftest import documents


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_whole_edited_and_clean(shipped):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("klmnop") for _ in range(5))
    item = [word() for _ in range(30)]
    around = [word() for _ in range(200)]
    edited = [*item[:-1], word()]
    far = [w if i % 6 else word() for i, w in enumerate(item)]
    rows = [
        (1, " ".join(around[:100] + item + around[100:])),
        (2, "\n".join(around[:50] + [w.upper() for w in item])),
        (3, " ".join(edited + around)),
        (4, " ".join(around[:7] + far + around)),
        (5, " ".join(around)),
        (6, " ".join(item[:20])),
    ]
    got = {r.doc_id: (r.item_id, r.start_word, r.n_words) for r in decontamination.find_leaks(documents(shipped, rows), items(shipped, [(9, " ".join(item))])).collect()}
    assert got == {1: (9, 100, 30), 2: (9, 50, 30), 3: (9, 0, 30)}


def test_blocks_find_everything_within_the_radius(shipped):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(200):
        a = int(rng.integers(-(2**63), 2**63 - 1))
        b = a
        for k in rng.choice(64, rng.integers(0, 12), replace=False):
            b ^= 1 << int(k)
        rows.append((i, a, (b + 2**63) % 2**64 - 2**63))
    df = shipped.createDataFrame(rows, "i long, a long, b long")
    from pyspark.sql import functions as F

    shared = F.size(F.array_intersect(decontamination.blocks(F.col("a"), 11), decontamination.blocks(F.col("b"), 11)))
    assert df.select(shared.alias("n")).filter("n = 0").count() == 0


def test_items_with_replaced_ends_are_found(shipped):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("klmnop") for _ in range(5))
    rows, bench, want = [], [], set()
    for i in range(60):
        item = [word() for _ in range(30 + i)]
        bench.append((i, " ".join(item)))
        for m in range(1, 9):
            for side in (0, 1):
                new = [word() for _ in range(m)]
                edited = new + item[m:] if side else item[:-m] + new
                a, b = (Counter(tuple(x[j : j + 5]) for j in range(len(x) - 4)) for x in (edited, item))
                if (a & b).total() / (a | b).total() >= 0.75:
                    want.add((len(rows), i))
                rows.append((len(rows), " ".join([word() for _ in range(9)] + edited + [word() for _ in range(9)])))
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(documents(shipped, rows), items(shipped, bench)).collect()}
    assert len(want) > 400 and got == want


def test_short_items_and_odd_rows(odd, none, shipped):
    bench = items(shipped, [(1, "One two"), (2, None), (3, ""), (4, "one two three four five six seven"), (4, "one two three four five six seven")])
    got = sorted(((r.doc_id or -1, r.item_id, r.start_word, r.n_words, r.similarity) for r in decontamination.find_leaks(odd, bench).collect()))
    want = [(d, i, 0, n, 1.0) for d in (-1, 1, 5) for i, n in ((1, 2), (4, 7))]
    assert got == want
    assert decontamination.find_leaks(none, bench).count() == 0
    assert decontamination.find_leaks(odd, bench.limit(0)).count() == 0
    long = decontamination.find_leaks(odd, items(shipped, [(7, "word " * 9)])).collect()
    assert [(r.doc_id, r.start_word) for r in long] == [(7, 0)]
