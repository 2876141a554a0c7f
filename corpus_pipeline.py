"""A training corpus from ``documents``: five stages, each working on what its predecessor kept.

1. toxicity: documents that the classifier rejects go.
2. line_dedup: lines that recur across documents go, and documents of which nothing is left.
3. ngram_jaccard_join: of each group of near-duplicates the document with the smallest id stays.
4. benchmark_decontamination: documents that hold a benchmark item go.
5. best_fit_packing: the rest is tokenised and placed in sequences of at most 4096 ids.

The classifier has no SQL form, so the pipeline has no SQL twin; it is tested against a
brute-force version.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm import decontamination, lines, ngram_join, packing, toxicity
from roadflow.llm.common import documents_of, releasing, stored, table
from roadflow.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half; the model learns from the labels of the training fold."""
    ship_package(spark)
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(data, offsets) for _, _, data, offsets in documents_of(batch)]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < 0.5))

    return docs.mapInArrow(releasing(run), docs.schema)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines taken out; a document that loses its last word goes. ``n_chars`` follows the text."""
    ship_package(spark)
    out = lines.drop_recurring_lines(docs)
    out = out.filter((F.col("n_dropped") == 0) | F.rlike("text", F.lit(r"\S")))
    if "n_chars" in docs.columns:
        own = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, own).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the smallest id, of equal ids any one text.

    Rows are compared by their own texts, so of rows that share an id but not a text each stays
    unless another one resembles it; a row repeated as a whole stays once. Rows without an id stay
    as they are.
    """
    ship_package(spark)
    row = f"row_{uuid.uuid4().hex}"
    rows = docs.filter("doc_id is not null").withColumn(row, F.xxhash64("doc_id", "text"))
    groups = ngram_join.jaccard_components(rows.select(F.col(row).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias(row), F.col("component_id").alias("group")).distinct()
    first = rows.select(row, "doc_id").join(groups, row).groupBy("group").agg(F.min(F.struct("doc_id", row)).alias("first"))
    kept = rows.join(first.select(f"first.{row}"), row, "left_semi").dropDuplicates([row])
    return kept.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item; each row goes by its own text, also without an id or with a repeated one."""
    ship_package(spark)
    row = f"row_{uuid.uuid4().hex}"
    rows = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    leaks = decontamination.find_leaks(rows.select(F.col(row).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return rows.join(leaks.select(F.col("doc_id").alias(row)).distinct(), row, "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of at most 4096 ids."""
    ship_package(spark)
    return packing.pack(packing.token_pieces(docs, packing.default_tokenizer()))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack_sequences),
]

#: The classifier cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; each stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
