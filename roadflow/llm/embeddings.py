"""Embedding near-duplicates: a forest of random-projection trees with overlapping splits.

Every tree splits by random directions at the median of a bounded sample; vectors near a split go
to both sides, in a margin that narrows from level to level, so a vector's number of leaves does
not grow with the table. Where the sample ends and leaves are still large they are split on by
medians that Spark takes over each leaf. All vectors are routed to the leaves of all trees, as
ids and leaf codes, and compared within leaves by cosine in double precision. A pair that shares
several leaves is counted in the first one only, so leaves give counts and a spanning set of
links, never lists of pairs. Equal vectors are one class throughout. Large leaves are compared
block by block in separate tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm.common import components, stored, table
from roadflow.llm.registry import query

THRESHOLD = 0.9
TREES = 6
#: Vectors a leaf should hold, as the sample tells.
LEAF = 400
#: Distance from a split within which a vector goes to both sides (unit vectors and directions).
SPILL = 0.03
#: The margin of a level as a share of that of the level above.
SPILL_FALL = 0.85
#: Leaves of more than so many times ``LEAF`` are split on beyond the sample.
SPLIT_ON = 8
#: A split must leave its two sides together with at most this share of what they had; a knot of
#: vectors closer than the margin cannot be split.
WORTH = 1.5
#: Vectors on which the trees are fitted at most: those with the smallest hash.
SAMPLE_ROWS = 20_000
#: Vectors of one side of a comparison task.
BLOCK = 1_024
#: Fewest sampled vectors in a node that is split.
_LEAST = 16


class Forest:
    """Random-projection trees over unit vectors of one dimension; nodes in heap order."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int = TREES, spill: float = SPILL, seed: int = 7):
        self.depth, self.spill = depth, spill
        rng = np.random.default_rng(seed)
        nodes = (1 << depth) - 1
        self.planes, self.cuts = [], []
        for _ in range(trees):
            planes = rng.standard_normal((nodes, sample.shape[1]))
            planes /= np.linalg.norm(planes, axis=1, keepdims=True)
            cuts = np.full(nodes, np.nan)
            members = {0: np.arange(len(sample))}
            for node in range(nodes):
                own = members.pop(node, np.empty(0, np.int64))
                # A node with few sampled vectors stays whole: all of its vectors go left.
                if len(own) < _LEAST:
                    continue
                along = sample[own] @ planes[node]
                cuts[node] = np.median(along)
                members[2 * node + 1], members[2 * node + 2] = own[along <= cuts[node]], own[along > cuts[node]]
            self.planes.append(planes)
            self.cuts.append(cuts)

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, tree, leaf) for every leaf a vector belongs to."""
        out = []
        for tree, (planes, cuts) in enumerate(zip(self.planes, self.cuts, strict=True)):
            row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
            for level in range(self.depth):
                off = np.einsum("ij,ij->i", x[row], planes[node]) - cuts[node]
                spill = self.spill * SPILL_FALL**level
                whole = np.isnan(off)
                left, right = whole | (off <= spill), ~whole & (off > -spill)
                row = np.concatenate([row[left], row[right]])
                node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
            out.append((row, np.full(len(row), tree), node))
        return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def unit_rows(column: pa.Array) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision."""
    flat = np.asarray(column.flatten(), np.float64)
    x = flat.reshape(len(column), -1)
    # Scaled first, so that very large or small components neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``n`` by links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _share_earlier(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether two padded rows of leaf codes (0: none) share one."""
    hit = np.zeros(len(left), bool)
    for k in range(left.shape[1]):
        hit |= ((left[:, k : k + 1] == right) & (left[:, k : k + 1] != 0)).any(1)
    return hit


def _padded(lists: pa.Array) -> np.ndarray:
    offsets = np.asarray(lists.offsets)
    size = np.diff(offsets)
    out = np.zeros((len(size), max(int(size.max(initial=0)), 1)), np.int64)
    flat = np.asarray(lists.flatten(), np.int64)
    at = np.repeat(np.arange(len(size)), size)
    out[at, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)] = flat
    return out


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    leaf: int = LEAF,
    spill: float = SPILL,
    sample_rows: int = SAMPLE_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    and so do vectors of different length. Rows with the same vector all link, repeated rows
    included. Other columns are not read; an empty table gives no rows. The upper levels of the
    trees are fitted on at most ``sample_rows`` vectors; every vector is routed and compared.
    """
    spark = vectors.sparkSession
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.coalesce(finite & F.exists(e, lambda v: v != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    rows = vectors.select("vec_id", usable.alias("ok"), F.when(usable, e).alias("e"))
    # Zeros of either sign are the same vector.
    rows = rows.withColumn("e", F.transform("e", lambda v: v + F.lit(0.0)))
    rows = rows.withColumn("h1", F.xxhash64("e")).withColumn("h2", F.xxhash64(F.lit("second"), F.reverse("e")))
    classes = stored(
        rows.filter("ok").groupBy("h1", "h2", "e").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes"
    )
    per_dim = []
    for dim, n in classes.groupBy(F.size("e")).count().collect():
        own = classes.filter(F.size("e") == dim)
        share = min(1.0, 1.2 * sample_rows / n)
        picked = own.filter(F.pmod("h1", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        sample = picked.orderBy("h1", "h2").limit(sample_rows).select("e").toArrow().column("e").combine_chunks()
        depth = max(0, min(math.ceil(math.log2(max(n / leaf, 1))), int(math.log2(max(len(sample) / _LEAST, 1)))))
        per_dim.append(_compare(own, Forest(unit_rows(sample), depth, trees, spill), dim, threshold, block, leaf))
    if not per_dim:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = per_dim[0]
    for more in per_dim[1:]:
        found = found.unionByName(more)
    found = stored(found, "leaf-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")), "vector-components")
    by_class = (
        classes.select("h1", "h2", "rep", "copies")
        .join(links, "rep", "left")
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    )
    out = rows.select("vec_id", "h1", "h2").join(by_class, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "rep", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _unit(packed: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors from their bytes."""
    return np.frombuffer(b"".join(packed.to_pylist())).reshape(-1, dim)


def _split_on(entries: DataFrame, units: DataFrame, dim: int, spill: float, depth: int, leaf: int) -> DataFrame:
    """``entries`` (rep, code) with leaves beyond ``SPLIT_ON`` times ``leaf`` split again, level by level.

    A leaf's direction follows from its code and its cut is the median over all its vectors. What a
    split would hardly lessen stays as it is.
    """
    limit, level, whole = SPLIT_ON * leaf, depth, None
    while True:
        large = entries.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
        if whole is not None:
            large = large.join(whole, "code", "left_anti")
        large = stored(large, "leaf-sizes")
        if large.isEmpty():
            return entries

        def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, codes = _unit(batch.column(2), dim), np.asarray(batch.column(1))
                out = np.empty(len(codes))
                for code in np.unique(codes):
                    plane = np.random.default_rng(int(code)).standard_normal(dim)
                    mine = codes == code
                    out[mine] = x[mine] @ (plane / np.linalg.norm(plane))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], names=["rep", "code", "at"])

        placed = entries.join(large.select("code"), "code").join(units.select("rep", "u"), "rep").select("rep", "code", "u")
        placed = stored(placed.mapInArrow(along, "rep long, code long, at double"), "leaf-places")
        cuts = stored(placed.groupBy("code").agg(F.percentile_approx("at", 0.5, 1000).alias("cut")), "leaf-cuts")
        margin = spill * SPILL_FALL**level
        off = F.col("at") - F.col("cut")
        sides = placed.join(cuts, "code").select("rep", "code", (off <= margin).alias("left"), (off > -margin).alias("right"))
        sums = sides.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.count_if("left").alias("l"), F.count_if("right").alias("r"))
        both = F.col("l") + F.col("r") <= WORTH * F.col("n")
        better = stored(sums.select("code", both.alias("better")), "leaf-better")
        moved = sides.join(better.filter("better").select("code"), "code")
        # Codes are heap positions under a tree's number: children follow from the parent.
        tree, node = F.shiftright("code", 40), (F.col("code") - 1).bitwiseAND((1 << 40) - 1)
        child = lambda k: (F.call_function("shiftleft", tree, F.lit(40)) + 2 * node + k + 1).alias("code")
        rest = entries.join(better.filter("better").select("code"), "code", "left_anti").select("rep", "code")
        entries = stored(
            rest.unionByName(moved.filter("left").select("rep", child(1))).unionByName(moved.filter("right").select("rep", child(2))),
            "leaf-entries",
        )
        stuck = better.filter("not better").select("code")
        whole = stuck if whole is None else whole.unionByName(stuck)
        level += 1
        if level >= 38:
            return entries


def _compare(classes: DataFrame, forest: Forest, dim: int, threshold: float, block: int, leaf: int) -> DataFrame:
    """(rep, links, root): per leaf block, how many vectors each class links with and its smallest linked class."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                data = unit_rows(batch.column(2)).tobytes()
                offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * (8 * dim)
                u = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), u], names=["rep", "copies", "u"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                row, tree, node = forest.leaves(_unit(part.column(1), dim))
                code = (tree.astype(np.int64) << 40) + node + 1
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(code)], names=["rep", "code"])

    units = classes.select("rep", "copies", "e").mapInArrow(pack, "rep long, copies long, u binary")
    units = stored(units.repartition("rep"), "unit-vectors")
    routed = stored(units.select("rep", "u").mapInArrow(route, "rep long, code long"), "leaf-entries")
    routed = _split_on(routed, units, dim, forest.spill, forest.depth, leaf)
    sizes = routed.groupBy("code").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1")
    # Each entry carries the vector's codes before it: where its pairs may have met already.
    codes = routed.groupBy("rep").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    parts = units.join(codes, "rep").select("rep", "copies", "u", "codes", F.posexplode("codes").alias("at", "code"))
    parts = parts.select("rep", "copies", "u", "code", F.slice("codes", F.lit(1), F.col("at")).alias("earlier"))
    parts = parts.join(sizes, "code", "left").fillna(1, ["blocks"])
    mine = F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks")).cast("int")
    parts = parts.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    parts = parts.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))

    def compare(found: pa.Table) -> pa.Table:
        found = found.combine_chunks()
        rep, copies, mine = (np.asarray(found.column(k)) for k in ("rep", "copies", "mine"))
        i, j = found.column("i")[0].as_py(), found.column("j")[0].as_py()
        x = _unit(found.column("u").combine_chunks(), dim)
        earlier = _padded(found.column("earlier").combine_chunks())
        one, two = (np.flatnonzero(mine == i), np.flatnonzero(mine == j))
        links, left, right = np.zeros(len(rep), np.int64), [], []
        for at in range(0, len(one), 512):
            rows = one[at : at + 512]
            a, b = np.nonzero(x[rows] @ x[two].T >= threshold)
            a, b = rows[a], two[b]
            keep = a < b if i == j else np.ones(len(a), bool)
            a, b = a[keep], b[keep]
            new = np.ones(len(a), bool)
            for k in range(0, len(a), 200_000):
                s = slice(k, k + 200_000)
                new[s] = ~_share_earlier(earlier[a[s]], earlier[b[s]])
            a, b = a[new], b[new]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            left.append(a)
            right.append(b)
        order = np.argsort(rep, kind="stable")
        back = np.argsort(order, kind="stable")
        a = back[np.concatenate(left)] if left else np.empty(0, np.int64)
        b = back[np.concatenate(right)] if right else np.empty(0, np.int64)
        root = rep[order][linked_roots(len(rep), a, b)][back]
        held = np.flatnonzero(links)
        return pa.table({"rep": rep[held], "links": links[held], "root": root[held]})

    return parts.drop("other", "blocks").groupBy("code", "i", "j").applyInArrow(compare, "rep long, links long, root long")


@query("op5_embedding_near_dedup")
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
