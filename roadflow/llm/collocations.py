"""Phrase collocations per language, counted by multikey quicksort of suffix pointers.

A suffix pointer is a word's place in a piece; the words from there on are its keys, at most
``MAX_WORDS`` of them. Sorting pointers by three-way partitions, word by word, makes every equal
part the occurrences of one phrase: its size is the count, and a part below the least count is
abandoned with all longer phrases in it.

Spark routes pointers by their leading words, so a part lies in one task whole. Before that, what
cannot lead anywhere goes: a phrase is frequent only if all its words and neighbouring pairs
are, so a pointer's keys end at the first pair that is surely rare. "Surely" is read from bit
sets of a fixed size: a bit is set when all words (pairs) that fall on it together reach the
least count. Words sharing a bit let too much through, never too little, and no set grows with
the data. Pointers travel in blocks, all of one step and route in a row. Pairs in very many places
travel alone: they are counted by aggregation and their pointers are routed by one word more, and
so on, so no task gets an unbounded part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadflow.llm.common import lower_ascii, mix, stored, table
from roadflow.llm.registry import query

MAX_WORDS = 5
#: Bits of the two sets; 4 MB each, whatever the data.
BITS = 1 << 25
#: Characters of texts of one language that a task works on at once.
STEP_CHARS = 2_000_000
#: Leading words with more pointers than this are routed by one word more.
HOT_LEAD = 200_000
#: Pointers that a route holds, about, and that are sorted at once; more only where one lead has them.
SORT_ROWS = 200_000
#: Routes at least, so that a small table is spread as well.
ROUTES = 256

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\x0a\x0b\x0c\x0d"]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Words:
    """Words of a run of texts: their bytes joined by one space, hashes, and whether the next word follows."""

    def __init__(self, data: np.ndarray) -> None:
        """``data`` is UTF-8 with a break after each text; words end at space, tab or a break."""
        gap = _GAP[data]
        first = ~gap
        first[1:] &= gap[:-1]
        starts = np.flatnonzero(first)
        last = ~gap
        last[:-1] &= gap[1:]
        ends = np.flatnonzero(last) + 1
        self.lengths = ends - starts
        # A word follows the one before when no break lies between them.
        breaks = np.cumsum(_BREAK[data], dtype=np.int64)
        self.follows = np.zeros(len(starts), bool)  # word i + 1 follows word i
        if len(starts):
            self.follows[:-1] = breaks[starts[1:]] == breaks[ends[:-1] - 1]
        keep = ~gap
        keep[1:] |= last[:-1]  # one space behind each word
        self.data = np.where(gap, np.uint8(0x20), data)[keep]
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.hashes = np.empty(0, np.uint64)
        if len(starts):
            place = np.arange(len(self.data), dtype=np.int64) - np.repeat(self.starts, self.lengths + 1)
            powers = np.cumprod(np.full(int(self.lengths.max()) + 1, 0xD1342543DE82EF95, np.uint64))
            value = _BYTE[self.data] * powers[place]
            self.hashes = mix(np.add.reduceat(value, self.starts))

    def _bytes(self, at: np.ndarray, words: np.ndarray, more: int) -> tuple[np.ndarray, np.ndarray]:
        size = self.starts[at + words - 1] + self.lengths[at + words - 1] - self.starts[at] + more
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        index = np.arange(offsets[-1], dtype=np.int64) + np.repeat(self.starts[at] - offsets[:-1], size)
        return self.data[index], offsets

    def slices(self, at: np.ndarray, words: np.ndarray) -> pa.Array:
        """Strings of ``words`` words from the words ``at`` on."""
        data, offsets = self._bytes(at, words, 0)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))

    def blocks(self, at: np.ndarray, words: np.ndarray, edges: np.ndarray) -> pa.Array:
        """The same, a line each, with the lines from edge to edge in one string."""
        data, offsets = self._bytes(at, words, 1)
        data[offsets[1:] - 1] = 0x0A
        return pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(offsets[edges]), pa.py_buffer(data))

    def pairs(self, lang: np.uint64) -> np.ndarray:
        """Hash of each word and the next; the last one means nothing."""
        return mix((self.hashes + lang) * np.uint64(0xA24BAED4963EE407) + mix(np.roll(self.hashes, -1)))


def _bit(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes & np.uint64(bits - 1)).astype(np.int64)


def _is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _bit(hashes, 8 * len(bits))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _seed(lang: str) -> np.uint64:
    return mix(np.array([sum((b + 1) * 257**i for i, b in enumerate(lang.encode())) & (2**64 - 1)], np.uint64))[0]


def _steps(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[str, Words]]:
    """(lang, words) over texts of one language at a time, of bounded size (or one text)."""
    for batch in batches:
        langs = pc.dictionary_encode(batch.column(0))
        text = batch.column(1).cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            part, size = [], 0
            for row in np.flatnonzero(codes == code):
                part += (raw[offsets[row] : offsets[row + 1]], np.array([0x0A], np.uint8))
                size += offsets[row + 1] - offsets[row]
                if size >= chars:
                    yield lang, Words(np.concatenate(part))
                    part, size = [], 0
            if part:
                yield lang, Words(np.concatenate(part))


def _texts(docs: DataFrame) -> DataFrame:
    """(lang, text) with A-Z lower-cased; a null language is ``und``, a null text has no words."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    return docs.filter("text is not null").select(lang, lower_ascii(F.col("text")).alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, bit, f): occurrences of every word, counted within steps before the shuffle."""

    chars, bits = STEP_CHARS, BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _steps(batches, chars):
            if not len(words.hashes):
                continue
            seed = _seed(lang)
            found, at, n = np.unique(words.hashes, return_index=True, return_counts=True)
            yield pa.record_batch(
                [
                    pa.DictionaryArray.from_arrays(np.zeros(len(found), np.int32), [lang]).cast(pa.string()),
                    words.slices(at, np.ones(len(at), np.int64)).cast(pa.string()),
                    pa.array(_bit(mix(found + seed), bits).astype(np.int32)),
                    pa.array(n.astype(np.int64)),
                ],
                ["lang", "phrase", "bit", "f"],
            )

    rows = texts.mapInArrow(run, "lang string, phrase string, bit int, f long")
    return rows.groupBy("lang", "phrase", "bit").agg(F.sum("f").alias("f"))


def full_bits(counts: DataFrame, least: int) -> DataFrame:
    """(bit, f) of the bits that together reach ``least``."""
    return counts.groupBy("bit").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def bit_set(full: DataFrame) -> np.ndarray:
    """Bits as a set; at most ``BITS`` / 64 numbers reach the driver."""
    one = F.lit(1).cast("long")
    words = full.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", one, F.col("bit").bitwiseAND(63))).alias("set"))
    got = words.toArrow()
    bits = np.zeros(BITS // 64, np.int64)
    bits[got["at"].to_numpy()] = got["set"].to_numpy()
    return bits.astype("<i8").view(np.uint8)


def pair_counts(texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(bit, f): occurrences of neighbouring words that may both be frequent, by the bit of their pair."""
    shared, chars = texts.sparkSession.sparkContext.broadcast(frequent), STEP_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for lang, words in _steps(batches, chars):
            seed = _seed(lang)
            often = _is_set(bits, mix(words.hashes + seed))
            both = often & words.follows & np.roll(often, -1)
            found, n = np.unique(_bit(words.pairs(seed)[both], 8 * len(bits)), return_counts=True)
            if len(found):
                yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(n.astype(np.int64))], ["bit", "f"])

    return texts.mapInArrow(run, "bit int, f long")


def pointers(texts: DataFrame, words_set: np.ndarray, pairs_set: np.ndarray, hot: np.ndarray, routes: int) -> DataFrame:
    """The words from a place on, up to ``MAX_WORDS`` and the first rare pair: (route, lang, keys, counts, f).

    Equal pointers of a step are counted. Pointers of one route make a row: a line each in ``keys``,
    their counts (64-bit little-endian) in ``counts``. Where the leading pair's bit is in ``hot``, the
    route is -1 and each pointer has a row, with its count in ``f``.
    """
    shared, chars = texts.sparkSession.sparkContext.broadcast((words_set, pairs_set, hot)), STEP_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_bits, pair_bits, hot_bits = shared.value
        for lang, words in _steps(batches, chars):
            seed = _seed(lang)
            often = _is_set(word_bits, mix(words.hashes + seed))
            goes_on = often & words.follows & np.roll(often, -1)
            pairs = words.pairs(seed)
            goes_on[goes_on] = _is_set(pair_bits, pairs[goes_on])
            at = np.flatnonzero(goes_on)
            if not len(at):
                continue
            padded = np.concatenate([goes_on, np.zeros(MAX_WORDS, bool)])
            length, alive = np.full(len(at), 2, np.int64), np.ones(len(at), bool)
            key = mix(words.hashes[at]) + words.hashes[at + 1]
            for k in range(1, MAX_WORDS - 1):
                alive &= padded[at + k]
                length += alive
                key = np.where(alive, mix(key) + words.hashes[np.minimum(at + k + 1, len(words.hashes) - 1)], key)
            # Equal hashes only suggest equal pointers; their texts decide.
            key = mix(key) + length.astype(np.uint64)
            _, first, group, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            again = np.flatnonzero((n > 1)[group])
            same = pc.equal(words.slices(at[again], length[again]), words.slices(at[first[group[again]]], length[first[group[again]]])).to_numpy(zero_copy_only=False)
            odd = again[~same]
            rows = np.concatenate([first, odd])
            n = np.concatenate([n - np.bincount(group[odd], minlength=len(first)), np.ones(len(odd), np.int64)])
            bit = _bit(pairs[at[rows]], 8 * len(pair_bits))
            route = np.where(np.isin(bit, hot_bits), -1, bit % routes)
            order = np.argsort(route, kind="stable")
            rows, n, route = rows[order], n[order], route[order]
            alone = int(np.searchsorted(route, 0))
            edges = np.concatenate([np.arange(alone), alone + np.flatnonzero(np.diff(route[alone:], prepend=-1)), [len(route)]])
            counts = n.astype("<i8")
            yield pa.record_batch(
                [
                    pa.array(route[edges[:-1]].astype(np.int32)),
                    pa.DictionaryArray.from_arrays(np.zeros(len(edges) - 1, np.int32), [lang]).cast(pa.string()),
                    words.blocks(at[rows], length[rows], edges).cast(pa.string()),
                    pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer((8 * edges).astype(np.int64)), pa.py_buffer(counts)]).cast(pa.binary()),
                    pa.array(counts[edges[:-1]]),
                ],
                ["route", "lang", "keys", "counts", "f"],
            )

    return texts.mapInArrow(run, "route int, lang string, keys string, counts binary, f long")


def quicksort_counts(keys: np.ndarray, weight: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(pointer, depth, count) of every prefix of the rows of ``keys`` whose weights sum to ``least``.

    ``keys`` holds a word's number at each depth, -1 behind the last. Three-way partitions: the
    parts below and above the pivot stay at their depth, the equal one is a prefix one word
    longer. Parts that are too light are abandoned.
    """
    out, todo = [], [(np.arange(len(keys)), 0)]
    while todo:
        part, depth = todo.pop()
        column = keys[part, depth]
        if len(part) > 2:  # a median of three
            pivot = int(np.median(column[[0, len(part) // 2, -1]]))
            pivot = column[np.argmin(np.abs(column - pivot))]
        else:
            pivot = column[0]
        equal = part[column == pivot]
        count = int(weight[equal].sum())
        if pivot >= 0 and count >= least:
            out.append((int(equal[0]), depth + 1, count))
            if depth + 1 < keys.shape[1]:
                todo.append((equal, depth + 1))
        for side in (part[column < pivot], part[column > pivot]):
            if len(side) and int(weight[side].sum()) >= least:
                todo.append((side, depth))
    return out


def _counted(lang: pa.Array, pointer: pa.Array, f: np.ndarray, lead_words: int, least: int) -> pa.RecordBatch:
    """(lang, phrase, f) of the phrases of ``lead_words`` words and more."""
    words = pc.split_pattern(pointer, " ")
    size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    codes = pc.dictionary_encode(words.flatten()).indices.to_numpy()
    keys = np.full((len(size), MAX_WORDS + 1), -1, np.int64)
    row_of = np.repeat(np.arange(len(size)), size)
    keys[row_of, 1 + np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)] = codes
    keys[:, 0] = pc.dictionary_encode(lang).indices.to_numpy()  # the language is the first key
    # Shorter prefixes are spread over tasks and counted elsewhere.
    counted = [(i, d - 1, n) for i, d, n in quicksort_counts(keys, f, least) if d > lead_words]
    at = pa.array([i for i, _, _ in counted], pa.int64())
    phrases = [" ".join(k.split(" ", d)[:d]) for k, (_, d, _) in zip(pointer.take(at).to_pylist(), counted, strict=True)]
    return pa.record_batch([lang.take(at).cast(pa.string()), pa.array(phrases, pa.string()), pa.array([n for _, _, n in counted], pa.int64())], ["lang", "phrase", "f"])


def _block_counts(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, f) from the blocks of ``pointers``; a route lies in one task whole."""
    most = SORT_ROWS

    def solved(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        lines = pc.split_pattern(rows["keys"].combine_chunks(), "\n")
        number = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
        pointer = lines.flatten()
        full = pc.not_equal(pointer, "")  # each block ends with a line break
        lang = pc.dictionary_encode(rows["lang"].combine_chunks()).take(pa.array(np.repeat(np.arange(len(number)), number))).filter(full)
        f = np.frombuffer(b"".join(rows["counts"].to_pylist()), "<i8")
        return _counted(lang.cast(pa.string()), pointer.filter(full), f, 2, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, last = 0, None
        for batch in batches:
            route = batch["route"].to_numpy()
            size = pc.binary_length(batch["counts"]).to_numpy() // 8
            edges = np.concatenate([np.flatnonzero(np.diff(route, prepend=route[:1] - 1)), [len(route)]])
            for low, high in zip(edges, edges[1:]):
                if held and route[low] != last and count >= most:
                    yield solved(held)
                    held, count = [], 0
                held.append(batch.slice(low, high - low))
                count, last = count + int(size[low:high].sum()), route[low]
        if held:
            yield solved(held)

    return blocks.repartition("route").sortWithinPartitions("route").mapInArrow(run, "lang string, phrase string, f long")


def _sorted_counts(routed: DataFrame, lead_words: int, least: int) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``lead_words`` words and more, from (lang, lead, keys, f)."""
    most = SORT_ROWS

    def solved(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        return _counted(rows["lang"].combine_chunks(), rows["keys"].combine_chunks(), rows["f"].to_numpy(), lead_words, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if sum(b.num_rows for b in held) >= most:
                # The rows of the lead that ends in this batch belong to the part before.
                lead = (held[-1]["lang"][-1], held[-1]["lead"][-1])
                other = pc.or_(pc.not_equal(batch["lang"], lead[0]), pc.not_equal(batch["lead"], lead[1])).to_numpy(zero_copy_only=False)
                edge = int(np.argmax(other)) if other.any() else batch.num_rows
                held.append(batch.slice(0, edge))
                batch = batch.slice(edge)
                if batch.num_rows:
                    yield solved(held)
                    held = []
            if batch.num_rows:
                held.append(batch)
        if held:
            yield solved(held)

    routed = routed.select("lang", "lead", "keys", "f")
    return routed.repartition("lang", "lead").sortWithinPartitions("lang", "lead").mapInArrow(run, "lang string, phrase string, f long")


def _words(phrase: str, k: int | Column) -> Column:
    """The first ``k`` words, or the last where ``k`` is negative."""
    return F.call_function("substring_index", F.col(phrase), F.lit(" "), k if isinstance(k, Column) else F.lit(k))


def phrase_counts(found: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, f) of every phrase of two words and more in at least ``least`` places.

    ``found`` is as ``pointers`` returns it. Pointers that came alone are routed by two leading words,
    or by more where these lead more than ``HOT_LEAD`` different ones; such a lead is counted by
    aggregation.
    """
    out, alone = _block_counts(found.filter("route >= 0"), least), found.filter("route < 0")
    if alone.isEmpty():
        return out
    rest = alone.groupBy("lang", F.rtrim("keys", F.lit("\n")).alias("keys")).agg(F.sum("f").alias("f"))
    rest = stored(rest, "collocation-alone")
    for k in range(2, MAX_WORDS + 1):
        rest = rest.withColumn("lead", _words("keys", k))
        leads = rest.groupBy("lang", "lead").agg(F.sum("f").alias("total"), F.count(F.lit(1)).alias("rows"))
        # Leads too hot for one task: at most pointers / HOT_LEAD of them.
        hot = stored(leads.filter(F.col("rows") > HOT_LEAD), "collocation-leads")
        usual = rest.join(F.broadcast(hot.select("lang", "lead")), ["lang", "lead"], "left_anti")
        counted = _sorted_counts(usual, k, least)
        out = out.unionByName(counted)
        if hot.isEmpty():
            break
        out = out.unionByName(hot.filter(F.col("total") >= least).select("lang", F.col("lead").alias("phrase"), F.col("total").alias("f")))
        rest = rest.join(F.broadcast(hot.select("lang", "lead")), ["lang", "lead"], "left_semi").select("lang", "keys", "f")
        rest = rest.filter(F.size(F.split("keys", " ")) > k)
    return out


def collocations(docs: DataFrame, least: int = 100) -> DataFrame:
    """Phrases of 2 to 5 words with their scores: (lang, phrase, a, l, r, n, score), the filtered candidates.

    ``docs`` has lang and text. Words and pieces as the module says; a phrase's score is the lowest of
    floor(1000 * a * n / (l * r)) over its cuts, the first of equal ones, computed with exact
    decimals. A phrase inside a longer one with as many places is left out. Documents without
    text add nothing; repeated documents count each; other columns are ignored.
    """
    texts = _texts(docs)
    words = stored(word_counts(texts), "collocation-words")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    words_set = bit_set(full_bits(words, least))
    pairs = stored(full_bits(pair_counts(texts, words_set), least), "collocation-pairs")
    # Bits above HOT_LEAD: at most pairs / HOT_LEAD.
    hot = np.sort(pairs.filter(F.col("f") > HOT_LEAD).select("bit").toArrow()["bit"].to_numpy())
    places = pairs.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    found = stored(pointers(texts, words_set, bit_set(pairs), hot, max(ROUTES, places // SORT_ROWS)), "collocation-pointers")
    frequent = stored(phrase_counts(found, least), "collocation-phrases")
    # Only a phrase one word longer can be the reason: what lies between has the same count.
    size = F.size(F.split("phrase", " "))
    parts = F.array(_words("phrase", size - 1), _words("phrase", 1 - size))
    longer = frequent.filter(size > 2).select("lang", F.explode(parts).alias("phrase"), F.col("f").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = frequent.join(longer, ["lang", "phrase"], "left").filter("longer is null or 100 * longer < 100 * f")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), size.alias("_size"))
    cuts = cuts.select("*", F.explode(F.sequence(F.lit(1), F.col("_size") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": _words("phrase", F.col("k")), "tail": _words("phrase", F.col("k") - F.col("_size"))})
    counts = frequent.select("lang", "phrase", "f").unionByName(words.filter(F.col("f") >= least).select("lang", "phrase", "f"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    # One row a language.
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(F.broadcast(total), "lang")
    exact = lambda c: F.col(c).cast("decimal(19, 0)")
    scored = scored.withColumns({"_top": exact("a") * exact("n"), "_below": exact("l") * exact("r")})
    scored = scored.withColumn("score", F.expr("cast(_top * 1000 as decimal(38, 0)) div _below"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    scored = scored.groupBy("lang", "phrase", "a", "n").agg(best)
    return scored.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def ranked(found: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` of each language by score, places, then phrase in UTF-8 order; cut before the shuffle."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= most)


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
grams AS (SELECT lang, unnest(list_transform(range(1, least(5, len(words) - i + 1) + 1), lambda s: words[i : i + s - 1])) AS gram FROM places),
counts AS (SELECT lang, gram, count(*) AS f FROM grams GROUP BY lang, gram),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
candidates AS (SELECT lang, gram, f FROM counts WHERE len(gram) > 1 AND f >= 100),
inside AS (
  SELECT lang, gram, max(longer) AS longer FROM (
    SELECT lang, unnest([gram[1 : size] for size in range(2, len(gram))]) AS gram, f AS longer FROM candidates
    UNION ALL SELECT lang, unnest([gram[first : ] for first in range(2, len(gram))]), f FROM candidates
    UNION ALL SELECT lang, unnest([gram[2 : size] for size in range(3, len(gram))]), f FROM candidates
    UNION ALL SELECT lang, unnest([gram[3 : size] for size in range(4, len(gram))]), f FROM candidates)
  GROUP BY lang, gram),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inside i ON i.lang = c.lang AND i.gram = c.gram
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.f),
cuts AS (SELECT *, unnest(range(1, len(gram))) AS k FROM kept),
scored AS (
  SELECT c.lang, c.gram, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
    ((1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.gram = c.gram[1 : k]
  JOIN counts y ON y.lang = c.lang AND y.gram = c.gram[k + 1 : ] JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM (SELECT *, array_to_string(gram, ' ') AS phrase FROM best)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


@query("op13_phrase_collocations", SQL)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(collocations(table(spark, sf_dir, "documents")))
