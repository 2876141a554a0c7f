"""N-gram Jaccard join with signature trees.

A document is the set of its five-word shingles. Equal sets are one class from the start. Every
class has a bitmap of its shingles, four to eight bits to a shingle, so bitmaps of any two classes
can be folded to one width. Bits of x that y lacks bound the overlap from above; a tree node
holds the union and the intersection of its members' bitmaps and their size range, and two nodes
are only opened against each other if their greatest possible overlap allows a link.

Trees are built and joined in Spark in two rounds:

1. Tree nodes of similar classes: classes with an equal minimum hash, in nodes of bounded size.
   Each node is joined with itself, candidates are verified on the texts, and the links give
   preliminary components. This repeats, one class standing for each component under a hash,
   until a pass finds no link.
2. All other node pairs: two linked sets share a shingle among the rarest quarter of each, so
   classes meet in the cells of those shingles. A cell within one component is closed at once;
   the others are joined by trees as before, passing over pairs already connected.

Both rounds lose nothing: the bounds are exact, and no cell is cut. The result is the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm.common import components, documents_of, mix, releasing, shingle_rows, stored, table
from roadflow.llm.registry import query

WIDTH = 5
#: A link: LINK[1] * intersection >= LINK[0] * union.
LINK = (3, 4)
#: Independent minimum hashes by which first nodes are formed, and members of a node.
SLOTS, NODE = 3, 32
#: Entries of a tree's leaf, children of an inner node.
LEAF, FANOUT = 16, 8
#: A shingle counts as frequent from so many documents; the most frequent go last in the order by rarity.
#: Any order gives the same links, so neither bound affects results.
FREQUENT, MAX_FREQUENT = 8, 400_000
#: Rows up to which a table of ids is broadcast (16 to 40 bytes each); larger ones are joined by shuffle.
BROADCAST_IDS = 400_000


def small(ids: DataFrame) -> DataFrame:
    """``ids`` marked for broadcast if counted few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def least_overlap(a, b):
    """The smallest intersection with which sets of sizes ``a`` and ``b`` link."""
    p, q = LINK
    return -(-(p * (a + b)) // (p + q))


def prefix_size(n):
    """How many of a set's rarest shingles any linked set must meet."""
    p, q = LINK
    return n - -(-(p * n) // q) + 1


# --- documents to signatures -------------------------------------------------------------------


def frequent_shingles(documents: DataFrame) -> np.ndarray:
    """(key, documents) of shingles that many documents hold, the most frequent ``MAX_FREQUENT`` by key.

    All documents are counted, so a shingle's place in the order does not depend on batches. A key is the first
    42 bits of a shingle's hash: ten name a bucket, the others are sent packed in four bytes.
    """

    def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
        key, counts = np.unique(np.concatenate(parts), return_counts=True)
        bucket = (key >> np.uint64(32)).astype(np.int64)
        # Shingles held more than once come first in each bucket; only they carry a count.
        order = np.argsort(2 * bucket + (counts == 1), kind="stable")
        rest, counts, bucket = key[order].astype(np.uint32), counts[order].astype(np.uint32), bucket[order]
        names, starts = np.unique(bucket, return_index=True)
        cuts = list(zip(starts, [*starts[1:], len(bucket)], strict=True))
        several = [(c := counts[a:b])[c > 1].tobytes() for a, b in cuts]
        columns = [pa.array(names), pa.array([rest[a:b].tobytes() for a, b in cuts], pa.binary()), pa.array(several, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for _, _, data, offsets in documents_of(batch):
                value = shingle_rows(data, offsets, WIDTH)[0]
                parts.append(value >> np.uint64(22))
                size += len(parts[-1])
                if size > 1_000_000:
                    yield packed(parts)
                    parts, size = [], 0
        if size:
            yield packed(parts)

    def count(rows: pa.Table) -> list[tuple]:
        keys, counts = (rows.column(k).to_pylist() for k in (1, 2))
        key = np.frombuffer(b"".join(keys), np.uint32)
        n, at = np.ones(len(key), np.uint32), 0
        for own, several in zip(keys, counts, strict=True):
            n[at : at + len(several) // 4] = np.frombuffer(several, np.uint32)
            at += len(own) // 4
        order = np.argsort(key)
        key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        total = np.add.reduceat(n[order], starts, dtype=np.int64)
        held = total >= FREQUENT
        whole = key[starts[held]].astype(np.int64) + (rows.column(0)[0].as_py() << 32)
        return list(zip(whole.tolist(), total[held].tolist(), strict=True))

    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])
    rows = documents.select("text").mapInArrow(releasing(run), "bucket long, keys binary, counts binary")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    found = rows.mapInArrow(by_runs(count, schema), "key long, n long")
    top = found.orderBy(F.desc("n"), "key").limit(MAX_FREQUENT).toArrow()
    out = np.stack([np.asarray(top.column(0), np.int64), np.asarray(top.column(1), np.int64)])
    return out[:, np.argsort(out[0])]


def places(keys: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the key of each of the packed shingles ``token`` is in the sorted ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(token), np.int64), np.zeros(len(token), bool)
    key = token >> np.uint64(6)
    near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return near, keys[near] == key


def bitmap(values: np.ndarray) -> bytes:
    """One bit for each hash, in a power of two of bits that is at least four times the number of hashes."""
    width = max(64, 1 << (4 * len(values) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(values >> np.uint64(16)) & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


SIGNATURE = "doc_id long, text_hash long, row long, n long, h1 long, h2 long, mins array<long>, bits binary, prefix binary"


def signatures(documents: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Per row: set size, hash of the set, minimum hashes, bitmap, and the 6-byte shingles of its prefix."""
    hot, weight = frequent[0].astype(np.uint64), frequent[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in documents_of(batch):
                value, bounds = shingle_rows(data, offsets, WIDTH)
                rows, n = high - low, np.diff(bounds)
                held = np.flatnonzero(n)
                at = bounds[:-1][held]
                h1, h2 = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
                mins = np.zeros((rows, SLOTS), np.int64)
                if len(held):
                    h1[held] = np.add.reduceat(mix(value + np.uint64(1)), at).view(np.int64)
                    h2[held] = np.add.reduceat(mix(value ^ np.uint64(0xABCDEF)), at).view(np.int64)
                    for k in range(SLOTS):
                        mins[held, k] = np.minimum.reduceat(mix(value + np.uint64(77 + k)), at).view(np.int64)
                token, row = value >> np.uint64(16), np.repeat(np.arange(rows), n)
                count = np.zeros(len(token), np.int64)
                near, held = places(hot, token)
                count[held] = weight[near[held]]
                want = prefix_size(n)
                rare = count == 0
                total = np.concatenate([[0], np.cumsum(rare)])
                chosen = rare & (total[:-1] - total[bounds[:-1]][row] < want[row])
                short = want - (total[bounds[1:]] - total[bounds[:-1]])
                common = np.flatnonzero(~rare & (short[row] > 0))
                if len(common):
                    common = common[np.lexsort((token[common], count[common], row[common]))]
                    rank = np.arange(len(common)) - np.searchsorted(row[common], row[common])
                    chosen[common[rank < short[row[common]]]] = True
                picks = np.flatnonzero(chosen)
                packed = token[picks].view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                cuts = np.searchsorted(picks, bounds) * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, rows),
                        batch.column(2).slice(low, rows),
                        batch.column(3).slice(low, rows),
                        pa.array(n.astype(np.int64)),
                        pa.array(h1),
                        pa.array(h2),
                        pa.array(list(mins), pa.list_(pa.int64())),
                        pa.array([bitmap(value[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary()),
                        pa.array([packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                    ],
                    names=[x.split()[0] for x in SIGNATURE.split(", ")],
                )

    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(releasing(run), SIGNATURE)


def tokens_of(prefix: bytes) -> np.ndarray:
    out = np.zeros((len(prefix) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(prefix, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


# --- signature trees ---------------------------------------------------------------------------


def fold(words: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64-bit words folded to ``width`` words by union."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


class SignatureTree:
    """Classes in order of size under nodes with union and intersection bitmaps and size ranges."""

    def __init__(self, sizes: np.ndarray, bits: list[bytes], group: np.ndarray):
        self.order = np.lexsort((group, sizes))
        self.sizes, self.group = sizes[self.order], group[self.order]
        self.words = [np.frombuffer(bits[i], np.uint64) for i in self.order]
        # level 0: leaves; each node: first entry, end, union, intersection, only group or -1
        level = [self._leaf(a, min(a + LEAF, len(sizes))) for a in range(0, len(sizes), LEAF)]
        self.levels = [level]
        while len(level) > 1:
            level = [self._join(level[a : a + FANOUT]) for a in range(0, len(level), FANOUT)]
            self.levels.append(level)

    def _leaf(self, a: int, b: int):
        width = min(len(w) for w in self.words[a:b])
        rows = np.stack([fold(w, width) for w in self.words[a:b]])
        only = int(self.group[a]) if (self.group[a:b] == self.group[a]).all() else None
        return a, b, np.bitwise_or.reduce(rows), np.bitwise_and.reduce(rows), only

    @staticmethod
    def _join(nodes):
        width = min(len(x[2]) for x in nodes)
        union = np.bitwise_or.reduce([fold(x[2], width) for x in nodes])
        # Intersections can't be folded by union: bits common to all members stay common, so folding keeps a lower set.
        common = np.bitwise_and.reduce([fold(x[3], width) for x in nodes])
        only = nodes[0][4] if all(x[4] == nodes[0][4] for x in nodes) else None
        return nodes[0][0], nodes[-1][1], union, common, only

    def _may_link(self, x, y) -> bool:
        """Whether the greatest overlap that the nodes' bitmaps and sizes allow suffices for a link."""
        if x[4] is not None and x[4] == y[4]:
            return False
        (low_x, high_x), (low_y, high_y) = ((self.sizes[n[0]], self.sizes[n[1] - 1]) for n in (x, y))
        p, q = LINK
        if q * high_x < p * low_y or q * high_y < p * low_x:
            return False
        width = min(len(x[2]), len(y[2]))
        need = least_overlap(low_x, low_y)
        lacks = np.bitwise_count(fold(x[3], width) & ~fold(y[2], width)).sum()
        lacked = np.bitwise_count(fold(y[3], width) & ~fold(x[2], width)).sum()
        return high_x - int(lacks) >= need and high_y - int(lacked) >= need

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (as positions given) that the dual traversal of the tree with itself can't exclude."""
        todo = [(len(self.levels) - 1, 0, 0)]
        while todo:
            level, i, j = todo.pop()
            x, y = self.levels[level][i], self.levels[level][j]
            if i != j and not self._may_link(x, y) or i == j and x[4] is not None:
                continue
            if level:
                kids = [range(k * FANOUT, min((k + 1) * FANOUT, len(self.levels[level - 1]))) for k in (i, j)]
                todo += [(level - 1, a, b) for a in kids[0] for b in kids[1] if a <= b]
                continue
            a, b = np.meshgrid(np.arange(x[0], x[1]), np.arange(y[0], y[1]), indexing="ij")
            a, b = a.ravel(), b.ravel()
            p, q = LINK
            fine = (a < b) & (self.group[a] != self.group[b]) & (q * np.minimum(self.sizes[a], self.sizes[b]) >= p * np.maximum(self.sizes[a], self.sizes[b]))
            a, b = a[fine], b[fine]
            if not len(a):
                continue
            width = min(min(len(self.words[k]) for k in np.unique(a)), min(len(self.words[k]) for k in np.unique(b)))
            rows = {k: fold(self.words[k], width) for k in np.unique(np.concatenate([a, b])).tolist()}
            left, right = np.stack([rows[k] for k in a.tolist()]), np.stack([rows[k] for k in b.tolist()])
            need = least_overlap(self.sizes[a], self.sizes[b])
            fits = self.sizes[a] - np.bitwise_count(left & ~right).sum(1, dtype=np.int64) >= need
            fits &= self.sizes[b] - np.bitwise_count(right & ~left).sum(1, dtype=np.int64) >= need
            if fits.any():
                yield self.order[a[fits]], self.order[b[fits]]


def members_hash(ids: np.ndarray) -> int:
    """One name for a set of ids, whatever their order."""
    mixed = mix(ids.view(np.uint64))
    pair = np.array([mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed)], np.uint64)
    return int(mix(pair ^ np.array([0, 0x5EED], np.uint64)).view(np.int64).sum())


class Roots:
    """Union-find over the entries of one cell."""

    def __init__(self, group: np.ndarray):
        first: dict[int, int] = {}
        self.up = [first.setdefault(g, i) for i, g in enumerate(group.tolist())]

    def of(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.of(i), self.of(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def by_runs(work: Callable[[pa.Table], list[tuple]], schema: pa.Schema):
    """A function for ``mapInArrow`` over rows sorted by their first column: ``work`` gets one run of equal keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[tuple] = []

        def flush():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column(0))
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts = [0, *cuts.tolist(), len(keys)]
            for a, b in zip(starts, starts[1:], strict=False):
                if held and held[0].column(0)[0].as_py() != keys[a]:
                    out += work(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                if len(out) > 20_000:
                    yield flush()
        if held:
            out += work(pa.Table.from_batches(held))
        if out:
            yield flush()

    return releasing(run)


def candidate_groups(cells: DataFrame) -> DataFrame:
    """(group, rep, comp): classes of a cell that a chain of possible links connects.

    ``cells``: (cell, rep, comp, n, bits). Equal groups from several cells are one.
    """

    def work(rows: pa.Table) -> list[tuple]:
        if rows.num_rows < 2:
            return []
        rep = np.asarray(rows.column(1))
        _, once = np.unique(rep, return_index=True)
        rep, comp, n = rep[once], np.asarray(rows.column(2))[once], np.asarray(rows.column(3))[once]
        bits = rows.column(4).take(pa.array(once)).to_pylist()
        roots = Roots(np.arange(len(rep)))
        for a, b in SignatureTree(n, bits, comp).candidates():
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                roots.join(i, j)
        groups: dict[int, list[int]] = {}
        for i in range(len(rep)):
            groups.setdefault(roots.of(i), []).append(i)
        out = []
        for members in groups.values():
            if len(members) > 1:
                name = members_hash(rep[members])
                out += [(name, int(rep[i]), int(comp[i])) for i in members]
        return out

    schema = pa.schema([("group", pa.int64()), ("rep", pa.int64()), ("comp", pa.int64())])
    rows = cells.select("cell", "rep", "comp", "n", "bits").repartition("cell").sortWithinPartitions("cell")
    found = rows.mapInArrow(by_runs(work, schema), "group long, rep long, comp long")
    return stored(found.distinct(), "candidate-groups")


def candidate_stars(cells: DataFrame) -> DataFrame:
    """(group, rep, comp): each class with the classes of greater id that it may link with.

    For cells that overlap much: every pair counts once, in whichever cells it is met. A class
    with many partners has them in several groups of bounded size.
    """

    def work(rows: pa.Table) -> list[tuple]:
        rep = np.asarray(rows.column(1))
        _, once = np.unique(rep, return_index=True)
        rep, comp, n = rep[once], np.asarray(rows.column(2))[once], np.asarray(rows.column(3))[once]
        bits = rows.column(4).take(pa.array(once)).to_pylist()
        out = []
        for a, b in SignatureTree(n, bits, comp).candidates():
            low, high = np.minimum(a, b), np.maximum(a, b)
            out += zip(*(x.tolist() for x in (rep[low], rep[high], comp[low], comp[high])), strict=True)
        return out

    names = ("a", "b", "comp_a", "comp_b")
    rows = cells.select("cell", "rep", "comp", "n", "bits").repartition("cell").sortWithinPartitions("cell")
    found = rows.mapInArrow(by_runs(work, pa.schema([(c, pa.int64()) for c in names])), ", ".join(f"{c} long" for c in names))
    pairs = stored(found.distinct(), "candidate-pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / (2 * NODE)).cast("int").alias("parts"))
    group = F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("parts"))).alias("group")
    placed = pairs.join(parts, "a").select(group, "*")
    centres = placed.select("group", F.col("a").alias("rep"), F.col("comp_a").alias("comp")).distinct()
    return stored(centres.unionByName(placed.select("group", F.col("b").alias("rep"), F.col("comp_b").alias("comp"))), "candidate-stars")


def verified_links(groups: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """(a, b): enough true links of each group to connect all that are linked in it.

    The texts of candidates only are joined to their groups; sets are compared exactly.
    """

    def work(rows: pa.Table) -> list[tuple]:
        if rows.num_rows < 2:
            return []
        rep = np.asarray(rows.column(1))
        _, once = np.unique(rep, return_index=True)
        batch = rows.take(pa.array(once)).combine_chunks().to_batches()[0]
        rep, comp = np.asarray(batch.column(1)), np.asarray(batch.column(2))
        sets: list[np.ndarray] = []
        for _, _, data, offsets in documents_of(batch):
            value, bounds = shingle_rows(data, offsets, WIDTH)
            sets += np.split(value, bounds[1:-1])
        n = np.array([len(s) for s in sets])
        roots, out = Roots(comp), []
        p, q = LINK
        for a, b in SignatureTree(n, [bitmap(s) for s in sets], comp).candidates():
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                if roots.of(i) == roots.of(j):
                    continue
                x, y = (sets[i], sets[j]) if n[i] <= n[j] else (sets[j], sets[i])
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                if q * both >= p * (n[i] + n[j] - both):
                    roots.join(i, j)
                    out.append((int(rep[i]), int(rep[j])))
        return out

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    wanted = stored(groups.select("rep").distinct(), "candidate-ids")
    ids = small(stored(classes.select("rep", "text_hash").join(small(wanted), "rep"), "candidate-texts"))
    texts = documents.select(F.col("doc_id").alias("rep"), "text", F.xxhash64("text").alias("text_hash"))
    texts = texts.join(ids, ["rep", "text_hash"], "left_semi").dropDuplicates(["rep"])
    rows = groups.join(texts, "rep").select("group", "rep", "comp", "text").repartition("group").sortWithinPartitions("group")
    return stored(rows.mapInArrow(by_runs(work, schema), "a long, b long"), "verified-links")


# --- the join ----------------------------------------------------------------------------------


def _similar_nodes(placed: DataFrame) -> DataFrame:
    """Cells of the first round: classes with an equal minimum hash, split at random into nodes of bounded size.

    One class of each component stands for it under a hash.
    """
    keyed = placed.select("rep", "comp", F.posexplode("mins").alias("slot", "least"))
    keyed = keyed.groupBy("slot", "least", "comp").agg(F.min("rep").alias("rep"))
    shared = keyed.groupBy("slot", "least").agg(F.count("*").alias("_c")).filter("_c > 1")
    salt = F.pmod(F.xxhash64("rep", "slot"), F.ceil(F.col("_c") / NODE))
    named = keyed.join(shared, ["slot", "least"]).select("rep", "comp", F.xxhash64("slot", "least", salt).alias("cell"))
    return named.join(placed.select("rep", "n", "bits"), "rep")


def _in_components(reps: DataFrame, links: DataFrame) -> DataFrame:
    """``reps`` with their component so far; only classes with a link are in the joined table."""
    known = components(links, "components").withColumnRenamed("id", "rep")
    placed = reps.join(small(stored(known, "linked")), "rep", "left")
    return placed.withColumn("comp", F.coalesce("component_id", "rep")).drop("component_id")


def _rare_cells(reps: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(cell, rep, comp): classes of several components that share a rare prefix shingle.

    Each batch sends its shingles packed by bucket; a task then sorts its buckets' shingles. Frequent ones,
    which could fill a bucket, are left to ``_frequent_cells``.
    """
    hot = frequent[0].astype(np.uint64)
    spark = reps.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column(3).to_pylist()
            token = tokens_of(b"".join(prefix))
            owner = np.repeat(np.arange(batch.num_rows), [len(p) // 6 for p in prefix])
            rare = ~places(hot, token)[1]
            token, owner = token[rare], owner[rare]
            bucket = (mix(token) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            token, owner, bucket = token[order], owner[order], bucket[order]
            facts = [np.asarray(batch.column(k), np.int64) for k in range(3)]
            names, starts = np.unique(bucket, return_index=True)
            rows = []
            for name, a, b in zip(names.tolist(), starts, [*starts[1:], len(bucket)], strict=True):
                own, where = np.unique(owner[a:b], return_inverse=True)
                rows.append((name, token[a:b].tobytes(), where.astype(np.uint32).tobytes(), *(f[own].tobytes() for f in facts)))
            if rows:
                kinds = [pa.int64()] + [pa.binary()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "tokens", "owners", "rep", "comp", "n"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, facts = [], [[], [], []]
        for batch in batches:
            for _, token, owner, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.frombuffer(owner, np.uint32)
                tokens.append(np.frombuffer(token, np.uint64))
                for k, f in enumerate(own):
                    facts[k].append(np.frombuffer(f, np.int64)[at])
        if not tokens:
            return
        token = np.concatenate(tokens)
        rep, comp, n = (np.concatenate(f) for f in facts)
        order = np.lexsort((rep, token))
        token, rep, comp, n = token[order], rep[order], comp[order], n[order]
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        ends = np.append(starts[1:], len(token))
        open_ = np.minimum.reduceat(comp, starts) != np.maximum.reduceat(comp, starts)
        seen, out = set(), ([], [], [])
        p, q = LINK
        for a, b in zip(starts[open_].tolist(), ends[open_].tolist(), strict=True):
            if b - a == 2 and q * min(n[a], n[a + 1]) < p * max(n[a], n[a + 1]):
                continue
            cell = members_hash(rep[a:b])
            if cell not in seen:
                seen.add(cell)
                for column, part in zip(out, (np.full(b - a, cell), rep[a:b], comp[a:b]), strict=True):
                    column.append(part)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["cell", "rep", "comp"])

    packed = reps.select("rep", "comp", "n", "prefix").mapInArrow(
        releasing(split), "bucket long, tokens binary, owners binary, rep binary, comp binary, n binary"
    )
    return packed.repartition("bucket").mapInArrow(releasing(meet), "cell long, rep long, comp long").distinct()


def _frequent_cells(reps: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(cell, rep, comp) as ``_rare_cells``, for frequent shingles.

    Components are pre-aggregated by shingle, which closes most. In an open cell the largest
    component is split over blocks and all other classes go to every block.
    """
    hot = frequent[0].astype(np.uint64)

    def listed(keep: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                prefix = batch.column(2).to_pylist()
                token = tokens_of(b"".join(prefix))
                owner = np.repeat(np.arange(batch.num_rows), [len(p) // 6 for p in prefix])
                near, held = places(keep, token)
                if held.any():
                    take = pa.array(owner[held])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keep[near[held]].view(np.int64)), batch.column(0).take(take), batch.column(1).take(take)], names=["token", "rep", "comp"]
                    )

        return reps.select("rep", "comp", "prefix").mapInArrow(run, "token long, rep long, comp long")

    spans = listed(hot).groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    # At most MAX_FREQUENT keys come to the driver.
    live = np.sort(np.asarray(spans.select("token").toArrow().column(0), np.int64).view(np.uint64))
    rows = listed(live)
    by_comp = rows.groupBy("token", "comp").agg(F.count("*").alias("c"))
    largest = by_comp.groupBy("token").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.ceil(F.max("c") / 512).cast("int").alias("blocks"))
    own = F.array(F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    spread = rows.join(largest, "token").withColumn(
        "block", F.explode(F.when(F.col("comp") == F.col("main"), own).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    return spread.select(F.xxhash64("token", "block").alias("cell"), "rep", "comp")


def jaccard_components(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``documents`` (doc_id, text).

    Words end at ASCII white space, A-Z count as a-z. Rows with the same id are one document; if
    their texts differ, the one with the fewest shingles is compared (ties by hash). A null or
    empty text has no shingles and links with nothing, nor does a row without an id. Other columns
    are not read; an empty table gives no rows.
    """
    texts = documents.select("doc_id", "text")
    frequent = frequent_shingles(texts)
    signed = stored(signatures(texts, frequent), "signatures")
    chosen = F.min(F.struct("n", "h1", "h2", "text_hash", "row")).alias("s")
    one = stored(signed.filter("doc_id is not null").groupBy("doc_id").agg(chosen).select("doc_id", "s.*"), "document-sets")
    by_set = one.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min(F.struct("doc_id", "text_hash", "row")).alias("r"))
    by_set = stored(by_set.select("n", "h1", "h2", F.col("r.doc_id").alias("rep"), "r.text_hash", "r.row"), "set-classes")
    reps = signed.select("row", "n", "mins", "bits", "prefix").join(small(by_set.select("row", "rep", "text_hash")), "row")
    reps = reps.drop("row") if by_set.count() <= BROADCAST_IDS else stored(reps.drop("row"), "classes")
    placed, links = reps.withColumn("comp", F.col("rep")), None
    while True:
        more = verified_links(candidate_groups(_similar_nodes(placed)), by_set, texts)
        if more.isEmpty():
            break
        links = more if links is None else links.unionByName(more)
        placed = _in_components(reps, links)
    cells = _rare_cells(placed, frequent).unionByName(_frequent_cells(placed, frequent))
    cells = cells.join(placed.select("rep", "n", "bits"), "rep")
    more = verified_links(candidate_stars(cells), by_set, texts)
    joined = components(more if links is None else links.unionByName(more), "set-components")
    by_class = by_set.join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    by_class = by_class.select("n", "h1", "h2", F.coalesce("component_id", "rep").alias("component_id"))
    found = one.select("doc_id", "n", "h1", "h2").join(by_class, ["n", "h1", "h2"], "left").select("doc_id", "component_id")
    out = signed.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


@query("op3_ngram_jaccard_join")
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
