"""Toxicity: a counterfactual-regularised linear classifier over words and word beginnings.

The classifier is fitted on a bounded sample of labelled rows: feature counts by label are taken
in Spark, and the features that speak for toxicity (a bounded number) enter a logistic model. Each sampled text that names a group is paired with a copy that names another
group instead, and the squared change of its score is penalised, so that a neutral mention of a
group does not raise the score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm.common import documents_of, fold, mix, releasing, table, word_hashes
from roadflow.llm.registry import query

#: Labelled rows of the fitting sample at most (those with the smallest hash of their id).
SAMPLE_ROWS = 40_000
#: Features at most, the most significant ones.
MAX_FEATURES = 4_096
#: Bytes of a word's beginnings, which generalise inflected and compounded words.
STEM_BYTES = (6, 8)
#: Terms naming groups; within a list any term may stand for another.
IDENTITY_TERMS = (
    ("women", "men"),
    ("girls", "boys"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "natives"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
)
_WORD = np.array([32 if b < 128 and not chr(b).isalnum() else b for b in range(256)], np.uint8)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and of word beginnings, and the row of each (repeats kept)."""
    rows = len(offsets) - 1
    apart = np.full(len(data) + rows, 32, np.uint8)
    of_row = np.repeat(np.arange(rows), np.diff(offsets))
    apart[np.arange(len(data)) + of_row] = _WORD[data]
    words, starts = word_hashes(apart)
    row = np.searchsorted(offsets + np.arange(rows + 1), starts, "right") - 1
    # The same text with every word cut after its first bytes.
    place = np.arange(len(apart))
    since = place - np.maximum.accumulate(np.where(apart == 32, place, -1))
    found = [words]
    for size in STEM_BYTES:
        stems, _ = word_hashes(np.where(since > size, 32, apart).astype(np.uint8))
        found.append(mix(stems ^ np.uint64(0x5354454D00 + size)))
    return np.concatenate(found), np.tile(row, len(found))


def of_words(words: Sequence[str]) -> np.ndarray:
    """Feature hashes of single words: one row of (word, beginnings) each."""
    joined = [w.encode() for w in words]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in joined])])
    found, _ = features(np.frombuffer(b"".join(joined), np.uint8), offsets)
    return found.reshape(1 + len(STEM_BYTES), -1).T


def labelled(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most about ``sample_rows`` labelled documents.

    A document's label is its highest non-null one. The sample is a range of the ids' hash, fixed
    by the number of labels, so its labels are few enough to be broadcast and no text is shuffled.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample_rows / max(known.count(), 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    chosen = known if share == 1.0 else known.filter(place < int(share * (1 << 20)))
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): how many documents of either label hold each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch.column(2).to_pylist(), np.int64)
            parts = []
            for low, _, data, offsets in documents_of(batch):
                found, row = features(data, offsets)
                order = np.lexsort((found, row))
                found, row = found[order], row[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
                parts.append((found[new], toxic[low + row[new]]))
            keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            bad = np.bincount(where, np.concatenate([p[1] for p in parts]) > 0, len(keys)).astype(np.int64)
            all_ = np.bincount(where, minlength=len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(bad), pa.array(all_ - bad)], names=["feature", "toxic", "clean"]
            )

    counted = rows.select("doc_id", "text", "toxic").mapInArrow(releasing(run), "feature long, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


class Classifier:
    """``sigmoid(bias + sum of the weights of the features present)``."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        order = np.argsort(keys)
        self.keys, self.weights, self.bias = keys[order], weights[order], float(bias)

    def present(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, position in ``keys``) of the known features of each row, each once."""
        found, row = features(data, offsets)
        if not len(self.keys) or not len(found):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        hit = self.keys[at] == found
        pair = np.unique(row[hit] * len(self.keys) + at[hit])
        return pair // len(self.keys), pair % len(self.keys)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, at = self.present(data, offsets)
        total = self.bias + np.bincount(row, self.weights[at], len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit_weights(
    row: np.ndarray, at: np.ndarray, toxic: np.ndarray, size: int, swap: dict[int, int], strength: float, ridge: float, rounds: int = 300
) -> tuple[np.ndarray, float]:
    """Logistic regression with the counterfactual penalty, by full-gradient Adam with a falling rate.

    ``swap`` maps the position of a group term's feature to that of the term it is exchanged for;
    texts that hold one get a penalty on the squared change of their logit.
    """
    n = len(toxic)
    rate = float(np.clip(toxic.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    w, b = np.zeros(size), float(np.log(rate / (1 - rate)))
    mapping = np.arange(size)
    for a, c in swap.items():
        mapping[a] = c
    moved = mapping[at] != at
    named_row, old, new = row[moved], at[moved], mapping[at[moved]]
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[at], n), -40, 40)))
        slack = p - toxic
        grad = np.bincount(at, slack[row], size) + ridge * w
        pull = 2 * strength * np.bincount(named_row, w[new] - w[old], n)
        grad += np.bincount(new, pull[named_row], size) - np.bincount(old, pull[named_row], size)
        grad = np.append(grad, slack.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
        move *= 0.2 * (1 - k / (rounds + 1))
        w, b = w - move[:-1], b - move[-1]
    return w, b


def fit(
    training: DataFrame,
    strength: float = 1.0,
    max_features: int = MAX_FEATURES,
    identity_terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
) -> Classifier:
    """A classifier from ``labelled`` rows; without both labels it scores everything as 0 or 1 by the label present.

    At most ``max_features`` features and each row's known ones come to the driver, so the rows
    must be a bounded sample.
    """
    totals = {int(k > 0): n for k, n in training.groupBy("toxic").count().collect() if k is not None}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return Classifier(np.empty(0, np.uint64), np.empty(0), 40.0 if bad else -40.0)
    lift = (F.col("toxic") + 0.5) / (bad + 1) / ((F.col("clean") + 0.5) / (good + 1))
    counts = feature_counts(training).filter(f"toxic >= {3 if bad >= 30 else 1}").withColumn("lift", lift).filter("lift >= 3")
    best = counts.orderBy(F.desc(F.col("toxic") * F.log("lift")), "feature").limit(max_features).collect()
    groups = [of_words(list(g)) for g in identity_terms]
    keys = np.unique(np.concatenate([np.array([r["feature"] for r in best], np.int64).view(np.uint64), *(g.reshape(-1) for g in groups)]))
    swap = {}
    for group in groups:
        for own, other in zip(group, np.roll(group, -1, axis=0), strict=True):
            for x, y in zip(own, other, strict=True):
                swap[int(np.searchsorted(keys, x))] = int(np.searchsorted(keys, y))
    blank = Classifier(keys, np.zeros(len(keys)), 0.0)
    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list[np.ndarray] = []
            for low, high, data, offsets in documents_of(batch):
                row, at = blank.present(data, offsets)
                lists += np.split(at, np.searchsorted(row, np.arange(1, high - low)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "at"],
            )

    rows = training.select("doc_id", "text", "toxic").mapInArrow(known, "doc_id long, toxic int, at array<int>").toArrow()
    lists = rows.column("at").combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    row, at = np.repeat(np.arange(len(sizes)), sizes), np.asarray(lists.flatten(), dtype=np.int64)
    toxic = (np.asarray(rows.column("toxic")) > 0).astype(float)
    weights, bias = fit_weights(row, at, toxic, len(keys), swap, strength, ridge=0.5)
    return Classifier(keys, weights, bias)


def score_toxicity(documents: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, score) of every whole text; a null text counts as empty, repeated rows stay.

    Other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in documents_of(batch):
                scores = model.score(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(scores, pa.float64())], names=["doc_id", "score"]
                )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def trained(documents: DataFrame, labels: DataFrame) -> Classifier:
    """The classifier of the rows outside the held-out fold."""
    return fit(labelled(documents, labels.filter(fold("doc_id", 5) != 0)))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score_toxicity(documents, trained(documents, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
