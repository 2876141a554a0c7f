"""Each stage against a brute-force version of its rule, on what its predecessor kept."""

import corpus_pipeline
from roadflow.llm import toxicity
from roadflow.llm.common import stored, table
from roadflow.llm.lines import SQL as LINES_SQL
from tests import compare
from tests.llm.conftest import D
from tests.llm.test_ngram_join import brute
from tests.llm.test_packing import valid


def test_stages(shipped):
    spark, docs, kept = shipped, table(shipped, D, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = (docs, docs := stored(stage(spark, docs, D), name))

    def texts(df):
        return {r.doc_id: r.text for r in df.collect()}

    before, after = (texts(x) for x in kept["toxicity"])
    labels = {r.doc_id: r.toxic for r in table(spark, D, "labels").collect()}
    assert {k: v for k, v in before.items() if k in after} == after
    assert all(labels.get(k) != 0 for k in before if k not in after)
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(kept["toxicity"][0], toxicity.trained(kept["toxicity"][0], table(spark, D, "labels"))).collect()}
    assert set(after) == {k for k, s in scores.items() if s < 0.5}

    con = compare.connect(D)
    con.register("kept", kept["line_dedup"][0].toPandas())
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM kept")
    want = {d: t for d, t in con.execute(f"SELECT doc_id, text FROM ({LINES_SQL})").fetchall()}
    own = texts(kept["line_dedup"][0])
    assert texts(kept["line_dedup"][1]) == {k: v for k, v in want.items() if v.split() or v == own[k]}
    assert all(r.n_chars == len(r.text) for r in kept["line_dedup"][1].collect() if r.text != own[r.doc_id])

    before, after = (texts(x) for x in kept["ngram_jaccard_join"])
    assert set(after) == {d for d, (_, c) in brute(list(before.items())).items() if d == c}

    before, after = (texts(x) for x in kept["benchmark_decontamination"])
    items = [" ".join(r.text.lower().split()) for r in table(spark, D, "benchmark").collect()]
    whole = {d for d, t in before.items() if any(f" {i} " in f" {' '.join(t.lower().split())} " for i in items)}
    assert whole and whole <= set(before) - set(after)

    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(after)
    valid(rows, 4096)
    for name in list(kept)[:-1]:
        assert kept[name][1].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_odd_rows(odd, none, shipped, tmp_path):
    for name in ("labels", "benchmark"):
        table(shipped, D, name).write.parquet(f"{tmp_path}/{name}.parquet")
    for start in (odd, none):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(shipped, docs, str(tmp_path)), name)
        if start is none:
            assert docs.count() == 0
        else:
            assert {1, 6, 7, 8} & {r.doc_id for r in docs.collect()} == {6, 7, 8}


def test_leaks_go_by_row(shipped):
    item = table(shipped, D, "benchmark").first().text
    rows = [(None, f"before {item} after"), (None, "clean"), (3, f"{item} after"), (3, "clean too"), (4, None)]
    kept = corpus_pipeline.drop_leaks(shipped, shipped.createDataFrame(rows, "doc_id long, text string"), D).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(None, "clean"), (3, "clean too"), (4, None)], key=str)


def test_rows_that_share_an_id_are_compared_by_their_texts(shipped):
    one, two = (" ".join(f"{w}{i}" for i in range(30)) for w in ("a", "b"))
    rows = [(1, one), (1, two), (2, two), (3, one), (3, one), (4, "something else altogether, alone"), (None, one)]
    df = shipped.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _row", "2 as component_id", "3 as first")
    kept = corpus_pipeline.drop_near_duplicates(shipped, df, D).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, one), (1, two), (4, rows[5][1]), (None, one)], key=str)
    assert {(r._row, r.component_id, r["first"]) for r in kept} == {(1, 2, 3)}
