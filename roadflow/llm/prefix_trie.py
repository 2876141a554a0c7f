"""Conversation prefix trie, rolled up by centroid decomposition of its parent edges.

A node is a distinct sequence of first turns; its id is a 128-bit digest chained over the turns.
Sums over subtrees come from a recursive split. Each component of the forest is cut at its
centroid: the lowest node that still has half of the component's weight below it. The total of
what hangs at the centroid inside its component is added to the centroid and to every node on
the path up to the component's top; then the centroid goes, the rest falls into components of
at most half the weight, and each is split again. Every pair of a node and one of its
ancestors is separated exactly once, so every value is added exactly once, after at most
log2(weight) rounds however deep or wide the trie is.

A node's weight is the number of turns of its members from it on. It is one aggregation of the
members' rows, so no weight has to be rolled up first. A centroid's path is read from the rows
of one member, by equality joins. Components of at most ``LOCAL_WEIGHT`` are finished by the
same recursion inside tasks; larger ones are cut by Spark jobs, all of them in one round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadflow.llm.common import stored, table
from roadflow.llm.registry import query

ROOT = bytes(16)
#: Components of at most this weight, and so of at most as many nodes, are finished within a task.
LOCAL_WEIGHT = 50_000
#: Parents with more children than this are joined by broadcast; there are at most nodes / HOT_CHILDREN.
HOT_CHILDREN = 100_000
#: Ids of this many numbers in a row are written down together before they are hashed.
ID_BLOCK = 1024


def _digest(*texts: str) -> Column:
    """128 bits of SHA-256 over texts, each preceded by its length."""
    parts = [p for t in texts for p in (F.length(t).cast("string"), F.lit(":"), F.col(t))]
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, turn_digest, chars): turns in order, a null turn first.

    Ties go by role, then by digest. Null role or text is empty; rows without a conversation id
    belong to no conversation and are left out; other columns are ignored.
    """
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.select("conv_id", "turn", "role", _digest("role", "text").alias("turn_digest"), F.length("text").cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "turn_digest")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "turn_digest", "chars")


def shared_openings(turns: DataFrame, base: Column, length: Column, most: int) -> DataFrame:
    """Sequences in which every conversation begins with another one's first turns.

    The first ``length`` turns (at most ``most``; all where there are fewer, none where there is no
    such conversation) of ``base``, then the own turns after the first ``length``. Returns
    (conv_id, pos, turn_digest, chars, n), with n turns in all, and for each conversation a row
    with pos 0, also where no turn is left.
    """
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    counts = counts.select("conv_id", "n_own", base.alias("base"), length.cast("long").alias("opening"))
    have = counts.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    joined = counts.join(have, "base", "left")
    shared = F.least("opening", F.coalesce("n_base", F.lit(0).cast("long")))
    rest = F.greatest(F.col("n_own") - F.col("opening"), F.lit(0).cast("long"))
    convs = stored(joined.select("conv_id", "base", "opening", shared.alias("shared"), (shared + rest).alias("n")), "trie-convs")
    heads = turns.filter(F.col("pos") <= most).select(F.col("conv_id").alias("base"), "pos", "turn_digest", "chars")
    opened = convs.filter("shared > 0").join(heads, "base").filter("pos <= shared")
    opened = opened.select("conv_id", "pos", "turn_digest", "chars", "n")
    own = turns.join(convs, "conv_id").filter("pos > opening")
    own = own.select("conv_id", (F.col("pos") - F.col("opening") + F.col("shared")).alias("pos"), "turn_digest", "chars", "n")
    tops = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(ROOT).alias("turn_digest"), F.lit(0).cast("long").alias("chars"), "n")
    return opened.unionByName(own).unionByName(tops)


_PATH = "conv_id long, depth long, node binary, parent binary, next binary, chars long, rest long"
_PATH_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary())]
    + [("next", pa.binary()), ("chars", pa.int64()), ("rest", pa.int64())]
)


def paths_of(sequences: DataFrame) -> DataFrame:
    """The nodes a conversation passes, from the root on: (conv_id, depth, node, parent, next, chars, rest).

    ``rest`` counts the conversation's nodes from here on. Conversations are spread by id and read
    in order, a row at a time; a long one needs no memory of its own.
    """

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, until its successor is known
        for batch in batches:
            out = []
            for conv, pos, digest, chars, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if pos == 0:
                    row = [conv, 0, ROOT, None, None, 0, n + 1]
                else:
                    node = hashlib.blake2b(held[2] + digest, digest_size=16).digest()
                    held[4] = node
                    row = [conv, pos, node, held[2], None, chars, n - pos + 1]
                if held is not None:
                    out.append(held)
                held = row
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PATH_ARROW, strict=True)], _PATH_ARROW)
        if held is not None:
            yield pa.record_batch([pa.array([c], f.type) for c, f in zip(held, _PATH_ARROW, strict=True)], _PATH_ARROW)

    rows = sequences.select("conv_id", "pos", "turn_digest", "chars", "n")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(chain, _PATH)


def nodes_of(paths: DataFrame) -> DataFrame:
    """(node, parent, depth, chars, conv_id, n_convs, weight); members of a node are counted before the shuffle."""
    grouped = paths.groupBy("node", "parent", "depth", "chars")
    return grouped.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("rest").alias("weight"))


def split_sums(parent: Sequence[int], weight: Sequence[int], values: Sequence[Sequence[int]]) -> list[list[int]]:
    """Subtree sums of ``values`` in a forest, by centroid decomposition.

    ``parent`` holds positions (-1: a top); ``weight`` is each node's weight with all below it and
    is above that of every node below.
    """
    weight, sums = list(weight), [[0] * len(parent) for _ in values]
    children: list[list[int]] = [[] for _ in parent]
    for i, p in enumerate(parent):
        if p >= 0:
            children[p].append(i)
    gone = [False] * len(parent)  # nodes whose edge upwards is cut
    todo = [i for i, p in enumerate(parent) if p < 0]
    while todo:
        top = cut = todo.pop()
        whole = weight[top]
        while (heavy := next((k for k in children[cut] if not gone[k] and 2 * weight[k] >= whole), None)) is not None:
            cut = heavy
        below = [cut]
        for i in below:
            below.extend(k for k in children[i] if not gone[k])
        totals = [sum(map(v.__getitem__, below)) for v in values]
        less, i = weight[cut], cut
        while True:
            for s, t in zip(sums, totals, strict=True):
                s[i] += t
            if i == top:
                break
            i = parent[i]
            weight[i] -= less
        gone[cut] = True
        for k in children[cut]:
            if not gone[k]:
                gone[k] = True
                todo.append(k)
        if cut != top:
            todo.append(top)
    return sums


def _cut_round(state: DataFrame, paths: DataFrame, tops: DataFrame, values: Sequence[str]) -> DataFrame:
    """Every component of ``tops`` cut at its centroid; ``tops`` has fewer rows than weight / LOCAL_WEIGHT."""
    heavy = state.join(F.broadcast(tops), "comp").filter(2 * F.col("weight") >= F.col("whole"))
    least = F.min_by(F.struct("node", "rep", "depth", "weight"), "weight").alias("c")
    cuts = heavy.groupBy("comp").agg(least, F.min("top_depth").alias("top_depth"))
    cuts = cuts.select(
        "comp", "top_depth", F.col("c.node").alias("cut"), F.col("c.rep").alias("cut_rep"),
        F.col("c.depth").alias("cut_depth"), F.col("c.weight").alias("cut_weight"),
    )
    cuts = stored(cuts, "trie-cuts")
    # Whether a node hangs below the centroid is read from a member's path at the centroid's depth.
    at = paths.select(F.col("conv_id").alias("rep"), F.col("depth").alias("cut_depth"), F.col("node").alias("at"), "next")
    found = state.join(F.broadcast(cuts.select("comp", "cut", "cut_depth")), "comp", "left").join(at, ["rep", "cut_depth"], "left")
    below = F.coalesce((F.col("depth") >= F.col("cut_depth")) & (F.col("at") == F.col("cut")), F.lit(False))
    found = stored(found.select(*state.columns, "cut", "next", below.alias("below")), "trie-below")
    totals = found.filter("below").groupBy("comp").agg(*[F.sum(v).alias(f"add_{v}") for v in values])
    up = paths.select(F.col("conv_id").alias("cut_rep"), F.col("depth").alias("path_depth"), "node")
    path = cuts.join(totals, "comp").join(up, "cut_rep").filter("path_depth between top_depth and cut_depth")
    lighter = F.when(F.col("path_depth") < F.col("cut_depth"), F.col("cut_weight")).otherwise(0).alias("less")
    path = path.select("node", lighter, *[f"add_{v}" for v in values])
    zero = F.lit(0).cast("long")
    comp = F.when(~F.col("below"), F.col("comp")).when(F.col("node") != F.col("cut"), F.col("next"))
    moved = found.join(path, "node", "left").select(
        "node", "parent", "rep", "depth", *values,
        comp.alias("comp"),
        (F.col("weight") - F.coalesce("less", zero)).alias("weight"),
        *[(F.col(f"sum_{v}") + F.coalesce(f"add_{v}", zero)).alias(f"sum_{v}") for v in values],
    )
    return stored(moved.select(*state.columns), "trie-state")


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: Sequence[str], local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """(node, sum_<value>, ...): each value (long) summed over the node and all nodes below it.

    ``nodes`` has node, parent, depth, conv_id (a member), weight (positive, with all below) and the
    values; ``paths`` the rows of ``paths_of``. An empty trie gives no rows.
    """
    zero = F.lit(0).cast("long")
    state = stored(
        nodes.select(
            "node", "parent", F.col("conv_id").alias("rep"), "depth", *values, F.lit(ROOT).alias("comp"), "weight",
            *[zero.alias(f"sum_{v}") for v in values],
        ),
        "trie-state",
    )
    done = None
    sums = [f"sum_{v}" for v in values]
    while True:
        # Components that are small enough leave the rounds; a centroid has no component any more.
        sizes = state.filter("comp is not null").groupBy("comp").agg(F.max("weight").alias("whole"), F.min("depth").alias("top_depth"))
        tops = stored(sizes.filter(F.col("whole") > local_weight), "trie-tops")
        large = state.join(F.broadcast(tops.select("comp")), "comp", "left_semi").select(*state.columns)
        small = state.join(F.broadcast(tops.select("comp")), "comp", "left_anti").select(*state.columns)
        done = small if done is None else done.unionByName(small)
        if tops.isEmpty():
            break
        state = _cut_round(large, paths, tops, values)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: list) -> pa.RecordBatch:
            place = {r[0]: i for i, r in enumerate(rows)}
            parent = [-1 if r[2] == r[0] else place[r[1]] for r in rows]
            own = list(zip(*(r[4 : 4 + k] for r in rows), strict=True))
            extra = split_sums(parent, [r[3] for r in rows], own)
            add = [[r[4 + k + j] + s[i] for i, r in enumerate(rows)] for j, s in enumerate(extra)]
            return pa.record_batch([pa.array([r[0] for r in rows], pa.binary()), *(pa.array(a, pa.int64()) for a in add)], ["node", *sums])

        k, rows = len(values), []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Whole components only, so many small ones are solved together.
                if len(rows) >= local_weight and row[2] != rows[-1][2]:
                    yield solved(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield solved(rows)

    columns = ["node", "parent", "comp", "weight", *values, *sums]
    schema = ", ".join(["node binary", *[f"{s} long" for s in sums]])
    rest = done.filter("comp is not null").select(*columns).repartition("comp").sortWithinPartitions("comp")
    return done.filter("comp is null").select("node", *sums).unionByName(rest.mapInArrow(finish, schema))


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 over the ids of ``ends`` (node, conv_id), ascending, joined by commas.

    Ids that lie close together are written down in parallel, so one node's many ids reach the
    task that hashes them in few rows, which it reads one at a time.
    """
    block = F.floor(F.col("conv_id") / ID_BLOCK) if ID_BLOCK & (ID_BLOCK - 1) else F.shiftright("conv_id", ID_BLOCK.bit_length() - 1)
    written = ends.groupBy("node", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    written = written.select("node", "block", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda rows: pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.string()), strict=True)], ["node", "ends_sha256"])
        node = sha = None
        for batch in batches:
            out = []
            for this, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if this != node:
                    if sha is not None:
                        out.append((node, sha.hexdigest()))
                    node, sha = this, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pack(out)
        if sha is not None:
            yield pack([(node, sha.hexdigest())])

    return written.repartition("node").sortWithinPartitions("node", "block").mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(sequences: DataFrame, local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """One row per node of the trie over ``sequences`` (as ``shared_openings`` returns them).

    Columns: node, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Repeated conversations are members like any other; without
    conversations there is no node.
    """
    paths = stored(paths_of(sequences), "trie-paths")
    nodes = stored(nodes_of(paths), "trie-nodes")
    born = nodes.filter("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    zero = F.lit(0).cast("long")
    nodes = nodes.join(born.withColumnRenamed("parent", "node"), "node", "left")
    nodes = stored(
        nodes.select(
            "node", "parent", "depth", "conv_id", "n_convs", "weight",
            F.coalesce("n_children", zero).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        ),
        "trie-nodes",
    )
    sums = subtree_sums(nodes, paths, ["leaf", "saved"], local_weight)
    hashes = hashed_ends(paths.filter("rest = 1").select("node", "conv_id"))
    # A parent with very many children is broadcast, so that its children need not meet in one task.
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parents.filter(F.col("n_children") > HOT_CHILDREN).drop("n_children"))
    usual = parents.filter(F.col("n_children") <= HOT_CHILDREN).drop("n_children")
    own = nodes.select("node", "parent", "conv_id", "depth", "n_convs", "n_children")
    with_parent = own.join(hot, "parent").unionByName(own.join(hot, "parent", "left_anti").join(usual, "parent", "left"))
    return (
        with_parent.join(sums, "node")
        .join(hashes, "node", "left")
        .select(
            "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            F.col("sum_leaf").alias("n_leaves"),
            F.col("sum_saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def opened_conversations(conversations: DataFrame) -> DataFrame:
    """Each conversation c with the first crc32(c) % 6 turns of conversation c - c % 100 in place of its own."""
    turns = stored(numbered_turns(conversations), "trie-turns")
    c = F.col("conv_id")
    return shared_openings(turns, c - c % 100, F.crc32(c.cast("string")) % 6, 5)


SQL = """
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, count(*) AS n_own,
    (xor(4294967295::UBIGINT, list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::UBIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, step: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)))) % 6)::BIGINT AS h
  FROM own GROUP BY conv_id),
shared AS (
  SELECT c.*, least(c.h, coalesce(b.n_own, 0)) AS k FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
turns AS (
  SELECT s.conv_id, o.pos, o.role, o.text FROM shared s JOIN own o ON o.conv_id = s.base AND o.pos <= s.k
  UNION ALL SELECT s.conv_id, o.pos - s.h + s.k, o.role, o.text FROM shared s JOIN own o USING (conv_id) WHERE o.pos > s.h),
keyed AS (SELECT *, md5(length(role) || ':' || role || text) AS key FROM turns),
steps AS (
  SELECT conv_id, pos AS depth, length(text) AS chars,
    string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY pos) AS node FROM keyed
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM steps GROUP BY conv_id) GROUP BY node),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM steps GROUP BY node, depth),
born AS (SELECT left(node, length(node) - 32) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
own_values AS (
  SELECT n.*, coalesce(b.n_children, 0) AS n_children, (n.n_convs - 1) * n.chars AS saved
  FROM nodes n LEFT JOIN born b USING (node)),
above AS (SELECT o.*, left(node, 32 * unnest(range(depth + 1))::BIGINT) AS top FROM own_values o),
sums AS (SELECT top AS node, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY top)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM own_values o JOIN sums USING (node)
LEFT JOIN nodes p ON o.depth > 0 AND p.node = left(o.node, length(o.node) - 32)
LEFT JOIN ends e ON e.node = o.node
"""


@query("op11_conversation_prefix_trie", SQL)
def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(opened_conversations(table(spark, sf_dir, "conversations"))).drop("node")
