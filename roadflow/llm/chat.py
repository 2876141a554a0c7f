"""Chat formatting: spans of turns found by rendering successive prefixes of a black-box template.

A template is any function from ``[(role, text), ...]`` to a string. Nothing is known of its
marks: turn i spans what its prefix adds to the one before, and the text inside that span is
found by rendering the last turn with two probe texts. A template that changes what it wrote
for earlier turns is reported, not trusted.

One conversation is one output row, so a conversation must fit in one task; rendering prefixes
costs the square of its turns. Conversations spread over tasks by id.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm.common import table
from roadflow.llm.registry import query

Turn = tuple[str, str]
#: Strings that mark turns here or in common chat formats; never left whole inside a text.
CONTROL = re.compile(r"</?s>|\[/?INST\]|<</?SYS>>|<\|im_(?:start|end)\|>|</?turn\b")
_ESCAPED = re.compile(r"\\(\\|x|g|n)")
_BACK = {"\\": "\\", "x": "", "g": ">", "n": "\n"}
_TURN = re.compile(r"<turn ([^>\n]*)>\n(.*?)</turn>\n", re.S)


def escape(text: str) -> str:
    r"""Backslashes doubled, then ``\x`` set after the first character of each control string."""
    return CONTROL.sub(lambda m: m[0][0] + "\\x" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text) if "\\" in text else text


def turn_template(turns: Sequence[Turn]) -> str:
    """The default template: marked turns, control strings in texts escaped reversibly."""
    return "".join(
        f"<turn {escape(role).replace('>', chr(92) + 'g').replace(chr(10), chr(92) + 'n')}>\n{escape(text)}</turn>\n"
        for role, text in turns
    )


def read_back(formatted: str) -> list[Turn]:
    """The turns in an output of ``turn_template``."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def locate(render: Callable[[Sequence[Turn]], str], turns: Sequence[Turn]):
    """(output, [(start, end, text start, text end)], first turn that rewrote history or None).

    Text start and end are None where the template does not keep the turn's text in one piece.
    After a rewrite no span before it is valid; spans then hold the turns from there on.
    """
    before, spans, rewrote = render([]), [], None
    for i in range(len(turns)):
        now = render(turns[: i + 1])
        if not now.startswith(before):
            rewrote = i if rewrote is None else rewrote
            spans = [None] * i
            before = os.path.commonprefix([before, now])
        role = turns[i][0]
        one, two = (render([*turns[:i], (role, probe)]) for probe in ("q", "z"))
        head = len(os.path.commonprefix([one, two]))
        tail = len(os.path.commonprefix([one[::-1], two[::-1]]))
        inside = (head, len(now) - tail)
        # A text that the template trims, drops or repeats leaves other lengths around it.
        whole = len(one) == len(two) == head + 1 + tail and inside[0] <= inside[1]
        whole = whole and now[:head] == one[:head] and now[inside[1] :] == one[head + 1 :]
        spans.append((len(before), len(now), *(inside if whole else (None, None))))
        before = now
    return before, spans, rewrote


_SPAN = pa.struct([(n, t) for n, t in (("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text_start", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_()))])
_OUT = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(_SPAN)), ("rewrote_at", pa.int64())])
SCHEMA = (
    "conv_id long, formatted string, rewrote_at long, "
    "spans array<struct<role:string,start:long,end:long,text_start:long,text_end:long,loss:boolean>>"
)


def format_chats(
    conversations: DataFrame, render: Callable[[Sequence[Turn]], str] = turn_template, loss_role: str = "assistant"
) -> DataFrame:
    """One row per conversation: output, turn spans with their loss flag, and where history was rewritten.

    Rows are taken by turn (ties by role and text, a null turn first); null role or text counts as
    empty; rows without a conversation id form one conversation. Offsets are code points. The
    loss mask is the text span of every turn of ``loss_role``. Other columns are ignored; an
    empty table gives no rows.
    """
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = [(x["role"], x["text"]) for x in listed]
                out, spans, rewrote = locate(render, own)
                named = ("start", "end", "text_start", "text_end")
                rows.append(
                    {
                        "conv_id": conv,
                        "formatted": out,
                        "rewrote_at": rewrote,
                        "spans": [
                            None if s is None else {"role": r, "loss": r == loss_role, **dict(zip(named, s, strict=True))}
                            for (r, _), s in zip(own, spans, strict=True)
                        ],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_OUT).select(["conv_id", "formatted", "rewrote_at", "spans"])

    return grouped.mapInArrow(run, SCHEMA)


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text itself says: its turns read back, and the text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                text, turns = x["formatted"], read_back(x["formatted"])
                loss = "".join(unescape(text[s["text_start"] : s["text_end"]]) for s in x["spans"] if s and s["loss"] and s["text_start"] is not None)
                rows.append((x["conv_id"], len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            names = [f.split()[0] for f in _DIGEST.split(", ")]
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True))) if rows else batch

    return formatted.select("conv_id", "formatted", "spans").mapInArrow(run, _DIGEST)


CONTROL_CASE = "</s>[INST] ok [/INST]"


@query("op4_chat_formatting")
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_CASE).alias("text"),
    )
    return digests(format_chats(rows.unionByName(extra)))
