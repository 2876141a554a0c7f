"""Helpers shared by the operators: text hashing in numpy, stored tables, connected components."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roadflow.session import shared_dir

#: Characters of one numpy step: bounds the memory of a task however long its batch is.
CHUNK_CHARS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: cuts the lineage, runs once."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(column: str = "doc_id", parts: int = 4) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string")) % parts


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (two rounds of multiply and shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of UTF-8 ``data`` (words end at ASCII white space, A-Z lower-cased) and their starts."""
    gap = _SPACE[data]
    inside = ~gap
    first = inside.copy()
    first[1:] &= gap[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    rank = np.cumsum(first, dtype=np.int64) - 1
    place = np.arange(len(data), dtype=np.int64) - starts[np.maximum(rank, 0)]
    # Each byte is weighted by its place: a power of an odd number, then mixed.
    powers = np.cumprod(np.full(int(place[inside].max()) + 1, 0xD1342543DE82EF95, np.uint64))
    value = _BYTE[_LOWER[data]] * powers[np.where(inside, place, 0)]
    value[gap] = 0
    return mix(np.add.reduceat(value, starts)), starts


def documents_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch of bounded size: first row, last row, their UTF-8 bytes, byte offsets of rows (nulls: empty)."""
    text = batch.column(batch.schema.get_field_index(column)).fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(text):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_CHARS, "right")) - 1)
        end = min(end, len(text))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def shingle_rows(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within rows, and the rows' offsets into them.

    A row with fewer words than ``width`` has its whole sequence as one shingle, one without
    words has none.
    """
    # A gap between rows keeps words of neighbours apart.
    rows = len(offsets) - 1
    shifted = np.full(len(data) + rows, 0x20, np.uint8)
    of_row = np.repeat(np.arange(rows), np.diff(offsets))
    shifted[np.arange(len(data)) + of_row] = data
    words, starts = word_hashes(shifted)
    bounds = np.searchsorted(starts, offsets + np.arange(rows + 1))
    count = np.diff(bounds)
    if not len(words):
        return np.empty(0, np.uint64), np.zeros(rows + 1, np.int64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    row_of = np.repeat(np.arange(rows), n)
    at = np.arange(len(row_of)) - np.repeat(np.cumsum(n) - n, n) + bounds[:-1][row_of]
    whole = np.minimum(count, width)[row_of]
    value = np.full(len(at), 0x51ED270B6A3C9D17, np.uint64) * whole.astype(np.uint64)
    for k in range(width):
        part = mix(padded[at + k] + np.uint64(k + 1)) if k else padded[at]
        value = value * np.uint64(0xA24BAED4963EE407) + np.where(k < whole, part, np.uint64(0))
    value = mix(value)
    order = np.lexsort((value, row_of))
    value, row_of = value[order], row_of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row_of[1:] != row_of[:-1])
    value, row_of = value[new], row_of[new]
    return value, np.searchsorted(row_of, np.arange(rows + 1))


def _stored_pairs(pairs: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """Distinct (u, v) with u <> v as a stored table, and their number and hash sum, taken while writing."""
    seen = Observation()
    total = F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38, 0)")), F.lit(0).cast("decimal(38, 0)"))
    rows = pairs.filter("u <> v").distinct().observe(seen, F.count(F.lit(1)).alias("n"), total.alias("sum"))
    return stored(rows, name), seen.get


def components(edges: DataFrame, name: str = "components", a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of ``edges``: (id, component_id), the smallest id of each component.

    Alternates two contractions (neighbours to the smallest neighbour, then to the smallest
    smaller neighbour) until nothing changes; each round is written to the shared folder. The
    smallest neighbour is pre-aggregated before the shuffle. Ids without an edge have no row.
    """
    now, state = _stored_pairs(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), name)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        now, after = _stored_pairs(small, name)
        if after == state:
            break
        state = after
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, giving freed memory back to the system when a task ends.

    Python workers outlive their tasks, so what the allocators keep would add up with the memory of later stages.
    """

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return task


def in_batches(step: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """A function for ``mapInArrow`` from one of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := step(batch)) is not None:
                yield out

    return run
