"""Best-fit packing of tokenised documents into sequences of a fixed length.

The plan is made from the histogram of piece lengths alone, which never has more than
``capacity`` rows: patterns of up to three pieces that fill a sequence are enumerated, repeat
counts are fitted to the histogram by non-negative least squares and rounded down, and what is
left is packed by best fit over counts of equal lengths. Documents then find their sequence by
their rank among the pieces of the same length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadflow.llm.common import releasing, stored, table
from roadflow.llm.registry import query

CAPACITY = 4096
END_ID = 1
#: Distinct parts of words a worker remembers with their ids (about 40 MB). Half of them are the latest; when
#: these are full they become the older half, from which parts in use are taken over, and the rest is forgotten.
REMEMBERED = 200_000
#: Letters for which lower-casing and splitting are the same here as in the tokenizer.
_PLAIN = "a-zß-öø-ÿœ"
_PLAIN_TEXT = re.compile(f"[\\t\\n\\r\\x20-\\x7e¡-©«-±´¶-¸»¿-ÿŒœ‐-‧]*")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_PLAIN}]+|[0-9]|[^\\s{_PLAIN}0-9]+")


class Encoder:
    """Token ids of texts as little-endian bytes, remembering the ids of the parts of words.

    In plain texts the tokenizer never looks across white space, and within a word never across
    a change between letters, digits and marks; so each distinct part is tokenised once. Whole words
    are not remembered: most of the distinct ones come once, and their parts come again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; texts with letters beyond Latin-1 or special strings go to the tokenizer whole."""
        out: list[bytes | None] = [None] * len(texts)
        split: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if "<|" in text or not _PLAIN_TEXT.fullmatch(text):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                split[i] = _SPLIT.findall(text.lower())
        used = set().union(*split.values())
        if len(self.parts) > REMEMBERED // 2:
            self.older, self.parts = self.parts, {}
        fresh = used.difference(self.parts)
        again = fresh.intersection(self.older)
        self.parts.update((p, self.older[p]) for p in again)
        self._learn(list(fresh - again))
        for i, parts in split.items():
            out[i] = b"".join(map(self.parts.__getitem__, parts))
        return out

    def _learn(self, fresh: list[str]) -> None:
        groups = [fresh[at : at + 64] for at in range(0, len(fresh), 64)]
        found = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, found, strict=True):
            ids = np.array(encoding.ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(group):
                whole, low = ids.tobytes(), 0
                for part, high in zip(group, (4 * ends).tolist(), strict=True):
                    self.parts[part] = whole[low:high]
                    low = high
            else:
                for part in group:
                    self.parts[part] = np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, so that its memory of words outlasts a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document; an end id closes each document.

    A null text is empty and so is one end id. Only longer documents are cut. ``with_ids`` adds
    the ids themselves as ``ids``.
    """
    limit = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            # A few hundred thousand characters at a time, whatever the texts' lengths.
            ids, texts = batch.column(0), batch.column(1)
            sizes = np.asarray(pa.compute.utf8_length(texts).fill_null(0))
            low = 0
            while low < batch.num_rows:
                high = low + max(1, int(np.searchsorted(np.cumsum(sizes[low:]), 500_000)))
                rows: list[list] = [[] for _ in range(6)]
                own = ids.slice(low, high - low).to_pylist()
                for doc, data in zip(own, tokens.encode([t or "" for t in texts.slice(low, high - low).to_pylist()]), strict=True):
                    data += end
                    for k, at in enumerate(range(0, len(data), limit)):
                        part = data[at : at + limit]
                        for column, cell in zip(rows, (doc, k, at // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                            column.append(cell)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array(c, k) for c, k in zip(rows[:5], kinds, strict=True)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in rows[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                low = high

    return documents.select("doc_id", "text").mapInArrow(releasing(run), PIECES + (", ids array<int>" if with_ids else ""))


def patterns(capacity: int, bins: int) -> list[tuple[int, ...]]:
    """Descending bin numbers (1 to ``bins``) of one to three pieces that fill a sequence."""
    out = [(bins,)]
    for a in range(bins - 1, 0, -1):
        if a >= bins - a > 0:
            out.append((a, bins - a))
        for b in range(min(a, bins - a - 1), 0, -1):
            if 0 < (c := bins - a - b) <= b:
                out.append((a, b, c))
    return out


def fit_repeats(histogram: np.ndarray, found: list[tuple[int, ...]], rounds: int = 400) -> np.ndarray:
    """Non-negative least squares for ``patterns x repeats = histogram``, by accelerated projected gradient.

    Bins with many tokens weigh more, as an unpacked long piece costs more than a short one.
    """
    bins = len(histogram)
    weight = np.sqrt(np.arange(1, bins + 1))
    rows = np.concatenate([np.array(p) - 1 for p in found])
    cols = np.repeat(np.arange(len(found)), [len(p) for p in found])
    scale = max(histogram.max(), 1)
    target = histogram / scale * weight

    def times(x):
        return np.bincount(rows, x[cols], bins) * weight

    def back(y):
        return np.bincount(cols, (y * weight)[rows], len(found))

    probe = np.ones(len(found))
    for _ in range(20):
        probe = back(times(probe))
        probe /= (step := np.linalg.norm(probe))
    x = z = np.zeros(len(found))
    momentum = 1.0
    for _ in range(rounds):
        nxt = np.maximum(z - back(times(z) - target) / step, 0)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        z, x, momentum = nxt + (momentum - 1) / after * (nxt - x), nxt, after
    return x * scale


class Plan:
    """Runs of pieces of one length: (length, first rank, count, first sequence).

    Piece number first rank + i goes to sequence first sequence + i.
    """

    def __init__(self, counts: np.ndarray, capacity: int, bins: int = 256):
        self.left = counts.astype(np.int64).copy()
        self.used = np.zeros_like(self.left)
        self.runs: list[tuple[int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.sequences, self.capacity = 0, capacity
        bins = min(bins, capacity)
        self._patterns(max(1, capacity // bins), bins)
        self._best_fit()

    def _place(self, length: int, count: int, sequence: int, room: int) -> None:
        self.runs.append((length, int(self.used[length]), count, sequence))
        self.used[length] += count
        self.left[length] -= count
        if room > length:
            self.open.setdefault(room - length, []).append((sequence, count))

    def _patterns(self, width: int, bins: int) -> None:
        lengths = np.arange(1, self.capacity + 1)
        own = np.minimum(-(-lengths // width), bins)
        histogram = np.bincount(own, self.left[1:], bins + 1)[1:]
        if not histogram.any():
            return
        found = patterns(self.capacity, bins)
        for pattern, repeat in zip(found, fit_repeats(histogram, found), strict=True):
            todo = int(repeat)
            while todo > 0:
                # Longest pieces first; the last one is the longest that still fits exactly.
                room, chosen, most = self.capacity, [], todo
                for k, b in enumerate(pattern):
                    high = min(room, b * width if k < len(pattern) - 1 else (b + 1) * width)
                    low = max((b - 1) * width, 0)
                    taken = {x: chosen.count(x) for x in chosen}
                    length = next((x for x in range(high, low, -1) if self.left[x] > taken.get(x, 0)), 0)
                    if not length:
                        break
                    chosen.append(length)
                    room -= length
                if len(chosen) < len(pattern):
                    break
                for x in set(chosen):
                    most = min(most, int(self.left[x]) // chosen.count(x))
                first, room = self.sequences, self.capacity
                self.sequences += most
                for k, x in enumerate(chosen):
                    self.runs.append((x, int(self.used[x]), most, first))
                    self.used[x] += most
                    self.left[x] -= most
                    room -= x
                if room:
                    self.open.setdefault(room, []).append((first, most))
                todo -= most

    def _best_fit(self) -> None:
        for length in range(self.capacity, 0, -1):
            while (count := int(self.left[length])) > 0:
                room = min((r for r in self.open if r >= length), default=0)
                if not room:
                    new = -(-count // (self.capacity // length))
                    self.open.setdefault(self.capacity, []).append((self.sequences, new))
                    self.sequences += new
                    continue
                first, n = self.open[room].pop()
                if not self.open[room]:
                    del self.open[room]
                if n > count:
                    self.open.setdefault(room, []).append((first + count, n - count))
                self._place(length, min(n, count), first, room)

    def slots(self) -> np.ndarray:
        return np.array(sorted(self.runs), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int = 256) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences hold at most ``capacity`` ids.

    Only the histogram of lengths (at most ``capacity`` rows) and the plan made from it come to
    the driver. Ranks within a length are counted in ``salts`` parts, so a length that a third of
    all pieces share is not sorted in one task; offsets are sums within a sequence. Repeated rows
    are packed as often as they occur. An empty table gives no rows.
    """
    part = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(salts))
    rows = stored(pieces.withColumn("_part", part), "pieces")
    counts = rows.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("_n")).collect():
        histogram[length] = n
    slots = Plan(histogram, capacity).slots()
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece")
    ranked = rows.join(bases.drop("_n"), ["length", "_part"]).withColumn(
        "rank", F.col("_base") + F.row_number().over(within) - 1
    )
    names = [c for c in pieces.columns]
    ranked = ranked.select(*names, "rank")
    keys = slots[:, 0] * (int(histogram.max(initial=0)) + 1) + slots[:, 1]
    span, at = int(histogram.max(initial=0)) + 1, (names.index("length"), len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(i)) for i in at)
            slot = np.searchsorted(keys, length * span + rank, "right") - 1
            sequence = slots[slot, 3] + rank - slots[slot, 1] if len(slot) else rank
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence, pa.int64())], names=[*names, "sequence_id"]
            )

    schema = pieces.schema.simpleString()[7:-1] + ",sequence_id:bigint"
    placed = ranked.mapInArrow(run, schema)
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece")
    upto = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("offset", upto - F.col("length"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf_dir, "documents"), default_tokenizer()))
