import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from roadflow.llm import chat
from roadflow.llm.queries import QUERIES
from tests.llm.conftest import D

texts = st.lists(st.sampled_from(list("ab\\xgn<>/ \n[]é") + ["</s>", "[INST]", "</turn>\n", "<turn ", "\\x"]), max_size=30).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "odd>\nrole", ""]), texts), max_size=6))
def test_round_trip_and_spans(turns):
    out, spans, rewrote = chat.locate(chat.turn_template, turns)
    assert chat.read_back(out) == turns and rewrote is None
    assert "".join(out[s[0] : s[1]] for s in spans) == out
    assert [chat.unescape(out[s[2] : s[3]]) for s in spans] == [t for _, t in turns]
    for _, text in turns:
        assert not chat.CONTROL.search(chat.escape(text))


def test_rewriting_template_is_found():
    def last_only(turns):
        return "".join(f"[{r}]{t if i == len(turns) - 1 else '...'}" for i, (r, t) in enumerate(turns))

    assert chat.locate(last_only, [("u", "one"), ("a", "two"), ("u", "three")])[2] == 1


def test_trimming_template_has_no_text_span():
    trim = lambda turns: "".join(f"<{r}>{t.strip()};" for r, t in turns)
    _, spans, rewrote = chat.locate(trim, [("u", " a "), ("u", "b")])
    assert rewrote is None and spans[1][2:] == (8, 9)


def plain(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, r, x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{D}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", chat.CONTROL_CASE), (-1, 1, "assistant", chat.CONTROL_CASE)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op4_chat_formatting"](spark, D).collect()}
    assert got == plain(rows)


def test_odd_rows(shipped):
    rows = [(1, 1, "assistant", "x" * 300_000), (1, 0, "user", None), (None, 0, None, "y"), (2, 0, "assistant", ""), (2, 0, "assistant", ""), (2, None, "user", "z")]
    df = shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as formatted", "2 as spans")
    out = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    assert {k: (v.n_turns, v.loss_chars) for k, v in out.items()} == {1: (2, 300_000), None: (1, 0), 2: (3, 0)}
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0
