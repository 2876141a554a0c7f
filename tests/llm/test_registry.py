"""Every dealt operator has a query; those with SQL equal it."""

import re

import pytest

import corpus_pipeline
from roadflow.llm.queries import ORACLES, QUERIES
from tests import compare
from tests.llm.conftest import D


def test_all_registered():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing",
    ]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, D)
    got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == compare.duck_rows(compare.connect(D), ORACLES[name])
