import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadflow.llm import packing
from roadflow.llm.queries import QUERIES
from tests.llm.conftest import D, documents

PATH = packing.default_tokenizer()
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = packing.Encoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list("abzAZ09'stredlvm.,!?-\n\t éÉßœŒ²×\u0130\u03a3\u0301\u00a0中") + ["<|endoftext|>", "'s", "n't", "…"]), max_size=40).map("".join))
def test_ids_equal_the_tokenizer(text):
    want = np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert ENCODER.encode([text, text + " x"])[0] == want


def valid(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op9_best_fit_packing"](spark, D).collect()
    pieces = {}
    for r in rows:
        pieces[r.doc_id, r.piece] = (r.start, r.length, r.ids_crc32)
    want = {}
    for d, text in docs:
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[d, k // 4096] = (k, len(part), zlib.crc32(part.tobytes()))
    assert pieces == want and len(rows) == len(want)
    least = -(-sum(x[1] for x in want.values()) // 4096)
    assert valid(rows, 4096) <= least + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_places_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=65)
    plan = packing.Plan(counts, 64, bins=16)
    used, seen = np.zeros(plan.sequences, np.int64), {}
    for length, rank, n, first in plan.slots():
        used[first : first + n] += length
        for k in range(rank, rank + n):
            assert seen.setdefault((length, k), True) and 0 <= k < counts[length]
    assert len(seen) == len(lengths) and (used <= 64).all() and (used > 0).all()
    # Best fit never opens more than 17/10 of the least number.
    assert plan.sequences <= 1.7 * -(-sum(lengths) // 64) + 1


def test_odd_rows(odd, none):
    rows = packing.pack(packing.token_pieces(odd, PATH)).collect()
    assert sum(r.doc_id == 5 for r in rows) == 2 and sum(r.doc_id == 7 for r in rows) == 15
    assert [(r.length, r.ids_crc32) for r in rows if r.doc_id in (2, 3, 4)] == [(1, zlib.crc32(b"\1\0\0\0"))] * 3
    valid(rows, 4096)
    assert packing.pack(packing.token_pieces(none, PATH)).count() == 0


def test_ids_can_be_kept(shipped):
    rows = packing.token_pieces(documents(shipped, [(1, "Hello world, hello!")]), PATH, with_ids=True).collect()
    assert rows[0].ids == [*TOKENIZER.encode("Hello world, hello!", add_special_tokens=False).ids, 1]


def test_parts_are_remembered_not_words(monkeypatch):
    """Words put together from few parts cost few entries; ids stay those of the tokenizer, also when the memory is full."""
    from itertools import product

    from tokenizers import Tokenizer

    path, marks = packing.default_tokenizer(), ["", "...", "!?", "-", "'s"]
    words = ["".join(x) for x in product(marks, ["alpha", "Straße", "7"], marks, ["beta", "42"], marks)]
    texts = [" ".join(words[k::7]) + "\t\n" for k in range(7)]
    plain = Tokenizer.from_file(path)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for room in (400_000, 3):
        monkeypatch.setattr(packing, "REMEMBERED", room)
        own = packing.Encoder(path)
        for text, ids in zip(texts, want, strict=True):
            assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == ids
        assert sum(len(x) for x in vars(own).values() if isinstance(x, dict)) < len(words) / 5


def test_memory_of_parts_is_bounded_and_keeps_what_comes_again(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 200)
    own, learned = packing.Encoder(PATH), []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda fresh: (learned.extend(fresh), learn(fresh)))
    letters = "abcdefghijklmnopqrstuvwxyz"
    for k in range(60):
        text = " ".join(f"{letters[k % 26]}{letters[k // 26]}{a}{b}" for a in letters[:5] for b in letters[:4])
        text += " seldom" if k % 2 else ""
        want = np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert own.encode([text]) == [want]
        assert len(own.parts) + len(own.older) <= 200 + 2 * 21
    assert learned.count("seldom") == 1


def test_tasks_give_memory_back(monkeypatch):
    import pyarrow as pa

    from roadflow.llm import common

    pool, calls = pa.default_memory_pool(), []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: calls.append(1) or pool)
    assert list(common.releasing(lambda batches: (b for b in batches))(iter([1, 2]))) == [1, 2] and calls == [1]
