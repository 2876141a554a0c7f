"""Language identification with interpolated Kneser-Ney character models.

One model per language over character n-grams of up to four letters. Counts of the longest
n-grams are taken over every training document in Spark; all lower orders follow from them
(Kneser-Ney continuation counts are numbers of distinct longer n-grams). A model is a sorted
array of 64-bit n-gram keys with their log-probabilities, one column per language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadflow.llm.common import documents_of, fold, stored, table
from roadflow.llm.registry import query

ORDER = 4
#: Steps of a nat in which rejection limits are counted.
STEPS = 10_000
_DISCOUNT = 0.75


def letter_table() -> np.ndarray:
    """For each code point the 16-bit symbol of its lower-case letter, 0 for anything but letters."""
    codes = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or not unicodedata.category(chr(c)).startswith(("L", "M")):
            continue
        low = ord(chr(c).lower()[0])
        codes[c] = low if low <= 0xFFFF else 0xE000 + low % 0x1900
    return codes


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(letter_table())
    return _letters[0]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte offset of each."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    lead = padded[starts].astype(np.uint32)
    more = [padded[starts + k].astype(np.uint32) & 0x3F for k in (1, 2, 3)]
    out = lead.copy()
    two, three, four = (lead >= 0xC0) & (lead < 0xE0), (lead >= 0xE0) & (lead < 0xF0), lead >= 0xF0
    out[two] = ((lead[two] & 0x1F) << 6) | more[0][two]
    out[three] = ((lead[three] & 0x0F) << 12) | (more[0][three] << 6) | more[1][three]
    out[four] = np.minimum(((lead[four] & 7) << 18) | (more[0][four] << 12) | (more[1][four] << 6) | more[2][four], 0x10FFFF)
    return out, starts


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams that end at each letter (or the gap after a word) and the row of each.

    A gap counts as one symbol (1), however long; every row begins with gaps.
    """
    points, starts = code_points(data)
    row = np.searchsorted(offsets, starts, "right") - 1
    symbol = letters()[points].astype(np.uint64)
    symbol[symbol == 0] = 1
    keep = symbol != 1
    keep[1:] |= (symbol[1:] == 1) & (symbol[:-1] != 1) & (row[1:] == row[:-1])
    symbol, row = symbol[keep], row[keep]
    first = np.searchsorted(row, np.arange(len(offsets) - 1))
    place = np.arange(len(row)) - first[row] if len(row) else np.empty(0, np.int64)
    packed = symbol.copy()
    for k in range(1, ORDER):
        before = np.ones(len(symbol), np.uint64)
        before[k:] = symbol[:-k]
        before[place < k] = 1
        packed |= before << np.uint64(16 * k)
    return packed, row


def ngram_counts(training: DataFrame) -> DataFrame:
    """(lang, ngram, n) over all rows of ``training``; each task adds up its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.asarray(batch.column(1).to_pylist(), object)
            parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for low, high, data, offsets in documents_of(batch):
                packed, row = ngrams(data, offsets)
                own = langs[low:high]
                for lang in set(own):
                    mask = own == lang
                    parts.setdefault(lang, []).append(np.unique(packed[mask[row]], return_counts=True))
            for lang, found in parts.items():
                keys, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                sums = np.bincount(where, np.concatenate([n for _, n in found]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(sums)],
                    names=["lang", "ngram", "n"],
                )

    rows = training.select("text", "lang").filter("lang is not null and text is not null")
    return rows.mapInArrow(run, "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))


class Models:
    """Interpolated Kneser-Ney log-probabilities of all languages by n-gram."""

    def __init__(self, langs: list[str], lang: np.ndarray, ngram: np.ndarray, n: np.ndarray):
        self.langs = langs
        size = len(langs)
        keys = np.unique(ngram)
        counts = np.zeros((len(keys), size))
        counts[np.searchsorted(keys, ngram), lang] = n
        # Level k holds n-grams of k symbols: full counts at the top, continuation counts below.
        levels = [(keys, counts)]
        for k in range(ORDER - 1, 0, -1):
            above_keys, above = levels[-1]
            suffix = above_keys & np.uint64((1 << (16 * k)) - 1)
            own, where = np.unique(suffix, return_inverse=True)
            level = np.zeros((len(own), size))
            np.add.at(level, where, (above > 0).astype(float))
            levels.append((own, level))
        levels.reverse()
        self.keys: list[np.ndarray] = []
        self.logs: list[np.ndarray] = []
        self.backoff: list[tuple[np.ndarray, np.ndarray]] = []
        symbols = max(len(levels[0][0]), 1) + 1
        below_keys, below = np.empty(0, np.uint64), np.empty((0, size))
        self.floor = np.full(size, 1.0 / symbols)
        for own, level in levels:
            context = own >> np.uint64(16)
            ctx, where = np.unique(context, return_inverse=True)
            total, kinds = np.zeros((len(ctx), size)), np.zeros((len(ctx), size))
            np.add.at(total, where, level)
            np.add.at(kinds, where, (level > 0).astype(float))
            weight = np.where(total > 0, _DISCOUNT * kinds / np.maximum(total, 1e-9), 1.0)
            if len(self.keys):
                shorter = own & np.uint64((1 << (16 * len(self.keys))) - 1)
                lower = below[np.searchsorted(below_keys, shorter)]
            else:
                lower = np.broadcast_to(self.floor, level.shape)
            prob = np.maximum(level - _DISCOUNT, 0) / np.maximum(total[where], 1e-9) + weight[where] * lower
            self.keys.append(own)
            self.logs.append(np.log(np.maximum(prob, 1e-12)).astype(np.float32))
            self.backoff.append((ctx, np.log(np.maximum(weight, 1e-12)).astype(np.float32)))
            below_keys, below = own, prob

    def score(self, packed: np.ndarray) -> np.ndarray:
        """Log-probability of the last symbol of each packed n-gram, one column per language."""
        out = np.empty((len(packed), len(self.langs)), np.float32)
        todo, penalty = np.arange(len(packed)), np.zeros((len(packed), len(self.langs)), np.float32)
        for k in range(ORDER, 0, -1):
            key = packed[todo] if k == ORDER else packed[todo] & np.uint64((1 << (16 * k)) - 1)
            own = self.keys[k - 1]
            at = np.minimum(np.searchsorted(own, key), len(own) - 1)
            hit = own[at] == key if len(own) else np.zeros(len(key), bool)
            out[todo[hit]] = self.logs[k - 1][at[hit]] + penalty[hit]
            todo, penalty, key = todo[~hit], penalty[~hit], key[~hit]
            if not len(todo):
                return out
            ctx, weight = self.backoff[k - 1]
            context = key >> np.uint64(16)
            at = np.minimum(np.searchsorted(ctx, context), len(ctx) - 1)
            penalty = penalty + np.where((ctx[at] == context)[:, None], weight[at], 0)
        out[todo] = np.log(self.floor).astype(np.float32) + penalty
        return out

    def cross_entropy(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nats per symbol of each row under each language, and the number of symbols."""
        packed, row = ngrams(data, offsets)
        rows = len(offsets) - 1
        total, n = np.zeros((rows, len(self.langs))), np.bincount(row, minlength=rows)
        if len(packed):
            scored = self.score(packed)
            held = np.flatnonzero(n)
            total[held] = -np.add.reduceat(scored.astype(np.float64), np.searchsorted(row, held), axis=0)
        return total / np.maximum(n, 1)[:, None], n


def fit(training: DataFrame) -> Models | None:
    """Models of every language of ``training`` (columns text, lang); None without training text.

    Every n-gram counts, also the rarest: the continuation counts of a small language would be
    wrong without them. So the driver, and each Python worker that scores, needs memory by the
    number of different n-grams; where it is too little, the run fails and nothing is cut.
    """
    found = ngram_counts(training).toArrow()
    if not found.num_rows:
        return None
    langs = sorted(found.column("lang").unique().to_pylist())
    lang = np.asarray(pc.index_in(found.column("lang"), pa.array(langs, pa.string())))
    return Models(langs, lang, np.asarray(found.column("ngram")).view(np.uint64), np.asarray(found.column("n")))


SCHEMA = "lang_pred string, score double, cross_entropy double, n_symbols long"


def identify(documents: DataFrame, models: Models | None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The likeliest language of every whole text: (doc_id, lang_pred, score, cross_entropy, n_symbols).

    Other columns than the id can be the ``keys`` that go along; they play no part in the result.

    The lowest length-normalised cross-entropy wins, ties go to the first language by name.
    ``score`` is its share among the languages when the per-symbol advantage is weighed by the
    root of the length. A null text, one without letters, or no model: ``und`` with score 0.
    """

    schema = ", ".join([f"`{k}` {documents.schema[k].dataType.simpleString()}" for k in keys] + [SCHEMA])
    names = [*keys, *(x.split()[0] for x in SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in documents_of(batch):
                if models is None:
                    nats, n = np.zeros((high - low, 1)), np.zeros(high - low, np.int64)
                else:
                    nats, n = models.cross_entropy(data, offsets)
                best = nats.argmin(1)
                least = nats[np.arange(len(best)), best]
                odds = np.exp(-np.minimum((nats - least[:, None]) * np.sqrt(np.maximum(n, 1))[:, None] * 2, 50))
                score = np.where(n > 0, 1 / odds.sum(1), 0.0)
                langs = [models.langs[i] if k else "und" for i, k in zip(best, n, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(low, high - low) for i in range(len(keys))),
                        pa.array(langs, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array([x if k else None for x, k in zip(least.tolist(), n, strict=True)], pa.float64()),
                        pa.array(n, pa.int64()),
                    ],
                    names=names,
                )

    return documents.select(*keys, "text").mapInArrow(run, schema)


def limits_of(scored: DataFrame, share: float = 0.995) -> dict[str, float]:
    """Per language the cross-entropy that ``share`` of its training documents stay below.

    ``scored`` holds ``identify``'s columns of the training documents, and their ``lang``. Taken over
    every document of a language with letters, rounded up to one of ``STEPS`` steps a nat: the counts
    of steps are added up before the shuffle, and no texts are sorted or gathered.
    """
    steps = scored.filter("lang is not null and n_symbols > 0")
    steps = steps.groupBy("lang", F.ceil(F.col("cross_entropy") * STEPS).alias("step")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("lang")
    reached = steps.withColumn("below", F.sum("n").over(own.orderBy("step"))).withColumn("all", F.sum("n").over(own))
    limits = reached.filter(F.col("below") >= F.col("all") * share).groupBy("lang").agg(F.min("step")).collect()
    return {lang: step / STEPS for lang, step in limits}


def calibrate(training: DataFrame, models: Models | None, share: float = 0.995) -> dict[str, float]:
    """``limits_of`` the documents of ``training``, scored here."""
    known = training.filter("lang is not null and text is not null")
    return {} if models is None else limits_of(identify(known, models, ("lang",)), share)


def accepted(limits: dict[str, float], slack: float = 1.15) -> Column:
    """Whether a prediction's cross-entropy is near what its language shows in training.

    Short texts vary more: the slack shrinks with the root of the length.
    """
    limit = F.lit(None).cast("double")
    for lang, value in limits.items():
        limit = F.when(F.col("lang_pred") == lang, F.lit(value)).otherwise(limit)
    room = F.lit(slack) + F.lit(2.0) / F.sqrt(F.greatest(F.col("n_symbols"), F.lit(1)))
    return F.coalesce(F.col("cross_entropy") <= limit * room, F.lit(False))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    models = fit(documents.filter(~held_out & F.col("lang").isNotNull()))
    # Every text is scored once; the limits are taken from the training rows of the result.
    scored = stored(identify(documents, models, ("doc_id", "lang")), "language-scores")
    limits = limits_of(scored.filter(~held_out))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "lang_pred",
        "score",
        accepted(limits).alias("accepted"),
        "cross_entropy",
    )
