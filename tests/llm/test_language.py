import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from roadflow.llm import language
from roadflow.llm.queries import QUERIES
from tests.llm.conftest import D, documents


def plain_models(rows):
    """Interpolated Kneser-Ney in plain dictionaries."""
    top = defaultdict(Counter)
    for lang, text in rows:
        symbols, gap = [], True
        for c in text.lower():
            if c.isalpha():
                symbols.append(c)
                gap = False
            elif not gap:
                symbols.append(" ")
                gap = True
        padded = [" "] * 3 + symbols
        for i in range(len(symbols)):
            top[lang][tuple(padded[i : i + 4])] += 1
    levels = {lang: {4: c} for lang, c in top.items()}
    for held in levels.values():
        for k in (3, 2, 1):
            held[k] = Counter(g[1:] for g in held[k + 1])
    every = {g for held in levels.values() for g in held[1]}

    def prob(lang, gram):
        if not gram:
            return 1 / (len(every) + 1)
        held = levels[lang][len(gram)]
        own = {g: n for g, n in held.items() if g[:-1] == gram[:-1]}
        total = sum(own.values())
        lower = prob(lang, gram[1:])
        if not total:
            return lower
        return max(held[gram] - 0.75, 0) / total + 0.75 * len(own) / total * lower

    return prob


def test_probabilities_equal_plain_ones(shipped):
    rows = [("aa", "the cat sat on the mat, the hat"), ("bb", "le chat est sur le tapis là-bas"), ("aa", "that rat ate")]
    df = shipped.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    models, prob = language.fit(df), plain_models(rows)
    for text in ("the chat", "zq tapis", "là"):
        data = text.encode()
        packed, _ = language.ngrams(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        grams = [tuple(" " if (v := int(p) >> (16 * k) & 0xFFFF) == 1 else chr(v) for k in (3, 2, 1, 0)) for p in packed]
        got = models.score(packed)
        for g, row in zip(grams, got, strict=True):
            for lang, x in zip(models.langs, row, strict=True):
                assert math.isclose(x, math.log(prob(lang, g)), abs_tol=1e-4), (text, g, lang)


def test_a_hot_language_leaves_a_small_one_whole(shipped):
    """Over two million n-grams of one language, each more frequent than any of the other."""
    letters = np.random.default_rng(3).integers(0x4E00, 0x9F00, (5, 430_000)).astype("<u4")
    hot = [row.tobytes().decode("utf-32-le") for row in letters]
    small = "tuo riv ensol bakka ture mion"
    rows = [(i, text, "hot") for i, text in enumerate(hot + hot)] + [(99, small, "small")]
    models = language.fit(shipped.createDataFrame(rows, "doc_id long, text string, lang string"))
    alone = language.fit(shipped.createDataFrame(rows[-1:], "doc_id long, text string, lang string"))
    assert len(models.keys[3]) > 2_000_000
    for k in range(4):
        assert np.isin(alone.keys[k], models.keys[k]).all()
    data = small.encode()
    nats, _ = models.cross_entropy(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert nats[0, models.langs.index("small")] < 2 < nats[0, models.langs.index("hot")]


def test_held_out_accuracy(spark):
    rows = QUERIES["op2_language_id"](spark, D).join(spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang]
    assert len(rows) == 200 and len(held) > 20
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, none):
    models = language.fit(odd.filter("lang is not null"))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.lang_pred, r.score) for r in language.identify(odd, models).collect())
    assert [d for d, p, s in got if p == "und" and s == 0] == [2, 3, 4, 6]
    assert len(got) == odd.count()
    assert language.identify(none, models).count() == 0
    assert language.fit(none) is None
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}


def test_rejects_a_foreign_text(shipped):
    df = shipped.createDataFrame([(i, f"the old man and the sea number {w} " * 5, "en") for i, w in enumerate("abcdefgh")], "doc_id long, text string, lang string")
    models = language.fit(df)
    limits = language.calibrate(df, models)
    scored = language.identify(documents(shipped, [(1, "the old man and the sea number c " * 3), (2, "qzx vkj wqp " * 20)]), models)
    assert {r.doc_id: r.ok for r in scored.select("doc_id", language.accepted(limits).alias("ok")).collect()} == {1: True, 2: False}


def test_limits_of_a_rare_language(shipped):
    """One document beside 40 000 of another language has its limit, and it is accepted."""
    df = shipped.range(40_000).selectExpr("id as doc_id", "if(id = 7, 'tuo riv ensol bakka ture', 'the old man and the sea') as text", "if(id = 7, 'xx', 'en') as lang")
    models = language.fit(df)
    limits = language.calibrate(df, models)
    assert set(limits) == {"en", "xx"}
    rare = language.identify(df.filter("doc_id = 7"), models).select("lang_pred", language.accepted(limits).alias("ok")).collect()
    assert [(r.lang_pred, r.ok) for r in rare] == [("xx", True)]


def test_limit_is_the_percentile_of_all_documents(shipped):
    df = shipped.range(6_000).selectExpr("id as doc_id", "concat('the old man ', translate(conv(hash(id), 10, 16), '0123456789', 'ghijklmnop')) as text", "'en' as lang")
    models = language.fit(df)
    nats = sorted(r.cross_entropy for r in language.identify(df, models).collect())
    assert 0 <= language.calibrate(df, models)["en"] - nats[math.ceil(0.995 * len(nats)) - 1] <= 1 / language.STEPS + 1e-9


@pytest.mark.parametrize("text", ["", "aé中\U0001f600z", "\u0000x"])
def test_code_points(text):
    data = np.frombuffer(text.encode(), np.uint8)
    assert language.code_points(data)[0].tolist() == [ord(c) for c in text]
