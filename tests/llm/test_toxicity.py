import numpy as np

from roadflow.llm import toxicity
from roadflow.llm.queries import QUERIES
from tests.llm.conftest import D, documents


def scores(model, texts):
    joined = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in joined])])
    return model.score(np.frombuffer(b"".join(joined), np.uint8), offsets)


def labelled(spark, rows):
    return spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")


def test_held_out(spark):
    d = D.replace("0.001", "0.01")
    rows = QUERIES["op7_toxicity"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.toxic is not None]
    assert not [r for r in held if r.predicted and not r.toxic]
    good = [r.score for r in held if r.toxic]
    bad = [r.score for r in held if not r.toxic]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) >= 0.85
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def biased(n=60):
    """Insults that mostly stand beside one group's name."""
    rows = []
    for i in range(n):
        rows.append((f"those muslim people are scum and rubbish {'vermin' if i % 2 else 'filth'} number{i}", 1))
        rows.append((f"my christian neighbour bakes bread on day{i} of the month", 0))
        rows.append((f"the weather was fine on day{i} by the sea", 0))
    return rows


def test_swapped_terms_change_the_score_less(shipped):
    df = labelled(shipped, biased())
    pair = ["a muslim family moved in", "a christian family moved in"]
    gaps = []
    for strength in (0.0, 5.0):
        model = toxicity.fit(df, strength=strength)
        a, b = scores(model, pair)
        gaps.append(abs(a - b))
        assert scores(model, ["they are scum and rubbish vermin"])[0] > 0.5
    assert gaps[1] < 0.1 * gaps[0]


def test_odd_rows(odd, none, shipped):
    model = toxicity.fit(labelled(shipped, biased()))
    rows = toxicity.score_toxicity(odd, model).collect()
    assert len(rows) == odd.count()
    empty = [r.score for r in rows if r.doc_id in (2, 3, 4)]
    assert len(set(empty)) == 1 and 0 <= empty[0] < 0.5
    assert toxicity.score_toxicity(none, model).count() == 0
    blank = toxicity.fit(labelled(shipped, biased()).limit(0))
    assert {r.score for r in toxicity.score_toxicity(odd, blank).collect()} < {x for x in [float(s) for s in scores(blank, [""])]} | {1.0}
    one = toxicity.fit(labelled(shipped, [("bad", 1), ("worse", 1)]))
    assert scores(one, ["anything"])[0] > 0.5


def test_labels_of_repeated_and_null_rows(shipped):
    docs = documents(shipped, [(1, "a"), (2, "b"), (None, "c")])
    labels = shipped.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    assert [tuple(r) for r in toxicity.labelled(docs, labels).collect()] == [(1, "a", 1)]
