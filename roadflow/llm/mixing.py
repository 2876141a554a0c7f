"""Mixing sources to target weights in blocks of a fixed number of words.

Each source's documents, in an order drawn by hash, make one long line of words that is cut into
blocks; a document's place on the line is a running sum taken per hash bucket first, so a source
with most of the rows is spread like any other. The mix is a number of output shards of slots.
Per shard the sources' slot counts are one multinomial draw. A source's slots are numbered over
all shards; slot j takes block perm(j mod n) of its n blocks, with a pseudorandom permutation
(a Feistel network) of its own for each round j div n. Blocks and slots meet by (source, block).

Draws alone would miss the targets by chance. A source's slots beyond its exact share are
therefore given to the sources that came short, in order, so every source gets its share to
within a block, and none of its blocks is used more often than the share divided by n, rounded
up. One row of a few numbers per source goes through the driver and to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadflow.llm.common import mix, stored, table
from roadflow.llm.registry import query

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
#: Slots that one task numbers.
TASK_SLOTS = 500_000
#: No source is used more often than this.
MOST_REPEATS = 3
#: Buckets of a running sum: 2 to this power for documents, and shards to a bucket.
DOC_BUCKET_BITS, SHARD_BUCKET = 12, 1024


class Mixture(NamedTuple):
    """``docs``: a row per document with its size, source rank, place on the source's line and target;
    ``slots``: (shard, slot, rank, block, pieces), a row per block of the mix, where a piece is
    (row_hash, doc_id, start, first_word, words)."""

    docs: DataFrame
    slots: DataFrame


def running_start(rows: DataFrame, key: str, bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows of the same key before them, by bucket and ``order``."""
    sums = rows.groupBy(key, bucket).agg(F.sum(value).alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(key, bucket, F.coalesce(before, F.lit(0)).cast("long").alias("_before"))
    within = F.sum(value).over(Window.partitionBy(key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    joined = rows.join(sums, [key, bucket])
    return joined.withColumn(name, F.col("_before") + F.coalesce(within, F.lit(0))).select(*rows.columns, name)


def source_ranks(sized: DataFrame) -> DataFrame:
    """(source, source_size, rank): sources by code point from rank 0, null last, ranked over range partitions."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.asc_nulls_last("source")
    parts = sums.repartitionByRange(order).withColumn("part", F.spark_partition_id())
    parts = stored(parts, "mix-sources")
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # A row per partition: small, whatever the number of sources.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(order))
    ranked = parts.withColumn("own", own).join(F.broadcast(offsets), "part")
    return ranked.select("source", "source_size", (F.col("before") + F.col("own") - 1).cast("long").alias("rank"))


def with_targets(sources: DataFrame, weight: Column) -> DataFrame:
    """``sources`` with target: all sizes shared by weight, at most ``MOST_REPEATS`` times a source's own size.

    What a source cannot take is shared again by weight among the others until none is above
    its limit. One small aggregation for each round.
    """
    rows = stored(sources.withColumns({"weight": weight.cast("long"), "limit": F.col("source_size") * MOST_REPEATS}), "mix-weights")
    total, weights = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (0.0 if not total else total / weights), -1
    while total:
        above = F.col("weight") * F.lit(level) > F.col("limit")
        limits, free, count = rows.agg(F.sum(F.when(above, F.col("limit"))), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        if count == full:
            break
        full, level = count, (total - (limits or 0)) / free
    return rows.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("limit").cast("double")))


def permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """``x`` (below ``n``) under a pseudorandom permutation of 0 .. n - 1: a Feistel network, walked until below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def network(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & mask
        for k in range(6):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + k * 0xD1342543DE82EF95) & (2**64 - 1))
            left, right = right, left ^ (mix(right + salt) & mask)
        return left << np.uint64(half) | right

    y = network(x.astype(np.uint64))
    while (out := y >= np.uint64(n)).any():
        y[out] = network(y[out])
    return y.astype(np.int64)


def drawn_counts(spark: SparkSession, share: list[int], shard_slots: int, seed: int) -> DataFrame:
    """(shard, rank, n, at): a multinomial draw for each shard; ``at`` is where the source's slots begin in it."""
    total = sum(share)
    shards = -(-total // shard_slots)
    p = np.array(share, float) / max(total, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                rng = np.random.Generator(np.random.Philox(key=seed, counter=[0, 0, 0, shard]))
                n = rng.multinomial(min(shard_slots, total - shard * shard_slots), p)
                rank = np.flatnonzero(n)
                at = np.cumsum(n)[rank] - n[rank]
                yield pa.record_batch([pa.array(np.full(len(rank), shard)), pa.array(rank), pa.array(n[rank]), pa.array(at)], ["shard", "rank", "n", "at"])

    return spark.range(shards).mapInArrow(run, "shard long, rank long, n long, at long")


def slots_of(draws: DataFrame, share: list[int], blocks: list[int], shard_slots: int, seed: int) -> DataFrame:
    """(shard, slot, rank, block): every slot with the block it takes."""
    got = dict(draws.groupBy("rank").agg(F.sum("n")).toArrow().to_pandas().itertuples(index=False, name=None))
    drawn = np.array([got.get(r, 0) for r in range(len(share))], np.int64)
    exact, n_blocks = np.array(share, np.int64), np.array(blocks, np.int64)
    over, short = np.maximum(drawn - exact, 0), np.maximum(exact - drawn, 0)
    over_at = np.cumsum(over) - over  # a source's surplus slots on a line of all of them
    takers = np.flatnonzero(short)
    short_at = (np.cumsum(short) - short)[takers]
    total = int(exact.sum())
    draws = draws.withColumn("bucket", F.floor(F.col("shard") / SHARD_BUCKET))
    placed = running_start(draws, "rank", "bucket", ["shard"], "n", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, rank, n, at, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                number = first + np.arange(n)
                ranks = np.full(n, rank)
                extra = number >= exact[rank]
                if extra.any():
                    line = over_at[rank] + number[extra] - exact[rank]
                    taker = np.searchsorted(short_at, line, "right") - 1
                    ranks[extra] = takers[taker]
                    number[extra] = drawn[takers[taker]] + line - short_at[taker]
                turn, block = np.divmod(number, n_blocks[ranks])
                for r, t in set(zip(ranks.tolist(), turn.tolist(), strict=True)):
                    here = (ranks == r) & (turn == t)
                    block[here] = permuted(block[here], int(n_blocks[r]), seed + 1 + 4 * r + t)
                slot = permuted(at + np.arange(n), min(shard_slots, total - shard * shard_slots), seed + 5 + shard)
                yield pa.record_batch([pa.array(np.full(n, shard)), pa.array(slot), pa.array(ranks), pa.array(block)], ["shard", "slot", "rank", "block"])

    # Few rows become many slots: spread them by the slots to come, not by their own size.
    tasks = max(int(draws.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // TASK_SLOTS)
    placed = placed.select("shard", "rank", "n", "at", "first").repartition(tasks, "shard", "rank")
    return placed.mapInArrow(run, "shard long, slot long, rank long, block long")


def row_hash(docs: DataFrame, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def mixture(docs: DataFrame, weight: Column | None = None, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> Mixture:
    """A mix of ``docs`` (doc_id, text, source) in which each source has its target number of words.

    ``weight`` is a column of ``rank`` (sources by code point from 0, null last); by default 1, 2, 3
    and again. All rows count, also repeated ones and those without an id; a null or empty text
    has no words and is never taken; other columns are ignored. Without words the mix is empty.
    The same rows give the same mix, however they are partitioned.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    sized = stored(docs.select("doc_id", "source", size, row_hash(docs, seed).alias("row_hash")), "mix-sizes")
    weight = F.col("rank") % 3 + 1 if weight is None else weight
    sources = with_targets(source_ranks(sized), weight)
    n_blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    share = F.coalesce(F.round(F.try_divide(F.col("target") * n_blocks, F.col("source_size"))), F.lit(0)).cast("long")
    sources = stored(sources.select("source", "source_size", "rank", "target", n_blocks.alias("n_blocks"), share.alias("share")), "mix-targets")
    plan = sources.select("rank", "n_blocks", "share").toArrow().sort_by("rank")
    shares, blocks = plan["share"].to_pylist(), plan["n_blocks"].to_pylist()

    bucket = F.shiftrightunsigned("row_hash", 64 - DOC_BUCKET_BITS).alias("bucket")
    known = sources.select(F.col("source").alias("_source"), "source_size", "rank", "target")
    placed = sized.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "size", "row_hash", "source_size", "rank", "target", bucket)
    placed = stored(running_start(placed, "rank", "bucket", ["row_hash", "doc_id", "size"], "size", "start"), "mix-places")

    pieces = placed.filter("size > 0").select(
        "rank", "row_hash", "doc_id", "start", (F.col("start") + F.col("size")).alias("end"),
        F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")).alias("block"),
    )
    low = F.greatest("start", F.col("block") * block_words)
    high = F.least("end", (F.col("block") + 1) * block_words)
    piece = F.struct("start", "row_hash", "doc_id", (low - F.col("start")).alias("first_word"), (high - low).alias("words"))
    packed = pieces.groupBy("rank", "block").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))

    draws = stored(drawn_counts(spark, shares, shard_slots, seed), "mix-draws")
    slots = slots_of(draws, shares, blocks, shard_slots, seed)
    # Spark would take the slots for as small as the draws they come from and broadcast them.
    return Mixture(placed, slots.hint("merge").join(packed, ["rank", "block"]).select("shard", "slot", "rank", "block", "pieces"))


def mixed_texts(mixed: Mixture, docs: DataFrame, seed: int = 17) -> DataFrame:
    """(shard, slot, text): the words of every slot, one space between them. ``docs`` and ``seed`` as given to ``mixture``."""
    texts = docs.select(row_hash(docs, seed).alias("row_hash"), "text").dropDuplicates(["row_hash"])
    parts = mixed.slots.select("shard", "slot", F.posexplode("pieces").alias("place", "piece"))
    parts = parts.select("shard", "slot", "place", "piece.row_hash", "piece.first_word", "piece.words").join(texts, "row_hash")
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("first_word") + 1).cast("int"), F.col("words").cast("int"))
    parts = parts.select("shard", "slot", "place", F.array_join(words, " ").alias("words"))
    whole = F.sort_array(F.collect_list(F.struct("place", "words")))["words"]
    return parts.groupBy("shard", "slot").agg(F.array_join(whole, " ").alias("text"))


def taken_words(mixed: Mixture) -> DataFrame:
    """``mixed.docs`` with the number of words that the mix takes from each row, repeats counted."""
    taken = mixed.slots.select("rank", F.explode("pieces").alias("piece"))
    taken = taken.groupBy("rank", F.col("piece.start").alias("line_start")).agg(F.sum("piece.words").alias("taken"))
    # A row without words shares its place with the next row and takes nothing.
    docs = mixed.docs.withColumn("line_start", F.when(F.col("size") > 0, F.col("start")))
    return docs.join(taken, ["rank", "line_start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


@query("op12_source_mixing")
def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture(table(spark, sf_dir, "documents"))
    return taken_words(mixed).select("doc_id", "size", "source_size", "target", "taken")
