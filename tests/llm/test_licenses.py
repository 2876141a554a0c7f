import re

from hypothesis import given, settings
from hypothesis import strategies as st

from roadflow.llm import licenses
from roadflow.llm.queries import QUERIES
from tests.llm.conftest import D, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    words = WORD.findall((text or "").translate(LOW))
    places = []
    for phrase, label in licenses.BASE:
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    starts = [p for p, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_given_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    rows = QUERIES["op10_license_scan"](spark, D).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


SCANNER = licenses.Scanner(licenses.BASE, licenses.NOTICES)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["Under", "the", "MIT", "license", "cc", "BY", "nc", "Apache", "License,", "Version", "2", "x-", "é", "cc-by-nc", "2.0"]), max_size=40))
def test_base_places(words):
    text = " ".join(words)
    n, places, _ = SCANNER.scan(text.encode())
    starts = [p for p, _ in places]
    assert (n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))) == base(text)


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_every_notice_within_the_bound_is_found(data):
    notice, label, errors = data.draw(st.sampled_from(licenses.NOTICES))
    text = list(notice)
    for _ in range(data.draw(st.integers(0, errors))):
        at = data.draw(st.integers(0, len(text) - 1))
        if data.draw(st.booleans()):
            text[at] = "q"
        elif len(text) > 3:
            del text[at]
    _, _, found = SCANNER.scan(f"Some words before {''.join(text)} and after".encode())
    assert label in {f[0] for f in found}


def test_spans(shipped):
    rows = licenses.scan_licenses(documents(shipped, [(1, "Foo bar.\nThis is Relaesed under the MIT-Licence, friend.")])).collect()
    (hit,) = rows[0].notices
    assert (hit.label, hit.first_word, hit.last_word, hit.errors) == ("mit", 4, 8, 3)
    assert rows[0].base_labels == "" and rows[0].labels == "mit" and 0.8 < rows[0].score < 1


def test_odd_rows(odd, none):
    rows = licenses.scan_licenses(odd).collect()
    assert len(rows) == odd.count()
    assert [(r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in rows if r.doc_id in (2, 3, 4)] == [(0, 0, None, "", 0.0)] * 3
    assert licenses.scan_licenses(none).count() == 0
