"""Benchmark decontamination: fingerprints of item-sized windows, found within a Hamming radius.

A window that is similar enough to an item shares at least one of its shingles, so windows are
laid where a document has a shingle of the benchmark: as long as the item, aligned at that
shingle. No other window can pass the last step. Each distinct window gets a 64-bit SimHash of
its words. The bits are cut into radius + 1 blocks, so that any two fingerprints within the
radius agree in a whole block; an item is compared with the windows that share a block. Similar
pairs may lie beyond the radius (words replaced at an end move many bits); none of these can
lack all of an item's rarest shingles, so they are found by those. All pairs are verified by the
weighted similarity of their shingles, a shingle weighing as often as it occurs, so the
fingerprints lose nothing. Built-in functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm.common import lower_ascii, stored, table
from roadflow.llm.registry import query

WIDTH = 5
SIMILARITY = 0.75
RADIUS = 11
#: Rows of the benchmark's shingle table up to which it is broadcast (24 bytes each); larger ones are joined by shuffle.
BROADCAST_ROWS = 2_000_000


def words_of(text: Column) -> Column:
    """Words end at ASCII white space; A-Z lower-cased; a null text has none."""
    cut = F.split(lower_ascii(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+")
    return F.filter(cut, lambda w: w != "")


def shingles_of(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order, repeats kept; empty with fewer words."""
    last = F.size(words) - width + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(width)]))


def fingerprint(words: Column) -> Column:
    """64-bit SimHash of a word sequence, every occurrence of a word counting once."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def bit(k: Column) -> Column:
        votes = F.aggregate(hashes, F.lit(0), lambda s, h: s + F.call_function("shiftright", h, k).bitwiseAND(1).cast("int") * 2 - 1)
        return F.call_function("shiftleft", F.when(votes > 0, 1).otherwise(0).cast("long"), k)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda f, k: f.bitwiseOR(bit(k)))


def blocks(value: Column, radius: int) -> Column:
    """(block number, its bits) of a fingerprint cut into ``radius + 1`` blocks."""
    n = radius + 1
    cuts = [64 * i // n for i in range(n + 1)]
    parts = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(value, low).bitwiseAND((1 << (high - low)) - 1).alias("bits"))
        for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]
    return F.array(*parts)


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two lists of shingle hashes: sum of lesser over sum of greater counts."""
    both = F.array_distinct(F.concat(a, b))

    def count(xs: Column, x: Column) -> Column:
        return F.size(F.filter(xs, lambda y: y == x))

    low = F.aggregate(both, F.lit(0), lambda s, x: s + F.least(count(a, x), count(b, x)))
    return low / (F.size(a) + F.size(b) - low)


def rarest(listed: DataFrame, threshold: float) -> DataFrame:
    """(item_id, width, shingle): of each item the rarest shingles of the benchmark that cannot all be missing.

    A similarity of ``threshold`` takes at least that share of the item's m shingles, so with
    m - need + 1 of them, repeats counted, absent it is out of reach.
    """
    each = listed.select("item_id", "width", F.col("shingles").alias("_all"), F.explode("shingles").alias("shingle"))
    held = each.select("item_id", "shingle").distinct().groupBy("shingle").agg(F.count("*").alias("_held"))
    ranked = each.join(held, "shingle").groupBy("item_id", "width", "_all").agg(F.array_sort(F.collect_list(F.struct("_held", "shingle"))).alias("_ranked"))
    few = F.slice("_ranked", F.lit(1), F.size("_all") - needed(F.size("_all"), threshold) + 1)
    return ranked.select("item_id", "width", F.explode(few).alias("r")).select("item_id", "width", F.col("r.shingle").alias("shingle")).distinct()


def needed(size: Column, threshold: float) -> Column:
    """Shingles, repeats counted, that a window shares at least with an item of ``size`` shingles."""
    return F.greatest(F.lit(1), F.ceil(size * F.lit(threshold) - F.lit(1e-9)).cast("int"))


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    threshold: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): the best window of each leaked item.

    Words are counted from 0. Items with fewer than ``width`` words are one shingle of all their
    words. Of equally similar windows the first counts; repeated rows of a document give one
    result; null or empty texts and items match nothing; other columns are not read. Memory of a task: one text's words.
    """
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    items = items.withColumn("width", F.least(F.size("words"), F.lit(width)))
    listed = None
    for k in range(1, width + 1):
        part = items.filter(F.col("width") == k).withColumn("shingles", shingles_of(F.col("words"), k))
        listed = part if listed is None else listed.unionByName(part)
    listed = stored(listed.withColumn("fp", fingerprint(F.col("words"))), "items")
    # Where in an item each shingle stands: it aligns the window.
    spots = listed.select("width", F.size("words").alias("n_words"), F.posexplode("shingles").alias("at", "shingle")).distinct()
    spots = stored(spots, "item-shingles")
    small = spots.count() <= BROADCAST_ROWS
    rows = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_row")).filter(F.length("text") > 0)
    hits = None
    widths = [r[0] for r in spots.select("width").distinct().orderBy("width").collect()]
    for k in widths:
        own = spots.filter(F.col("width") == k).drop("width")
        split = rows.select("_row", words_of(F.col("text")).alias("words"))
        placed = split.select("_row", F.size("words").alias("size"), F.posexplode(shingles_of(F.col("words"), k)).alias("p", "shingle"))
        met = placed.join(F.broadcast(own) if small else own, "shingle")
        met = met.select("_row", F.greatest(F.lit(0), F.col("p") - F.col("at")).alias("start"), "n_words", "size")
        hits = met if hits is None else hits.unionByName(met)
    if hits is None:
        return documents.sparkSession.createDataFrame(
            [], "doc_id bigint, item_id bigint, start_word int, n_words int, similarity double"
        )
    # A window that would pass the end is moved back inside.
    hits = hits.select("_row", F.greatest(F.lit(0), F.least("start", F.col("size") - F.col("n_words"))).alias("start"), "n_words").distinct()
    per_row = stored(hits.groupBy("_row").agg(F.collect_set(F.struct("start", "n_words")).alias("spans")), "windows")
    held = rows.join(per_row, "_row").select("doc_id", words_of(F.col("text")).alias("words"), "spans")
    windows = held.select("doc_id", "words", F.explode("spans").alias("s")).select(
        "doc_id", F.col("s.start").alias("start_word"), F.slice("words", F.col("s.start") + 1, F.col("s.n_words")).alias("words")
    )
    windows = stored(windows.withColumn("window", F.xxhash64("words")), "window-words")
    distinct = windows.groupBy("window").agg(F.any_value("words").alias("words")).withColumn("fp", fingerprint(F.col("words")))
    distinct = stored(distinct, "fingerprints")
    keyed = distinct.select("window", "fp", F.explode(blocks(F.col("fp"), radius)).alias("b"))
    wanted = listed.select("item_id", F.col("fp").alias("item_fp"), F.explode(blocks(F.col("fp"), radius)).alias("b"))
    near = keyed.join(wanted, "b").filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    near = near.select("window", "item_id")
    rare = stored(rarest(listed, threshold), "rare-shingles")
    small = rare.count() <= BROADCAST_ROWS
    for k in widths:
        sought = rare.filter(F.col("width") == k).drop("width")
        held = distinct.select("window", F.explode(F.array_distinct(shingles_of(F.col("words"), k))).alias("shingle"))
        near = near.unionByName(held.join(F.broadcast(sought) if small else sought, "shingle").select("window", "item_id"))
    near = near.distinct()
    pairs = near.join(distinct.drop("fp"), "window").join(listed.select("item_id", "width", "shingles"), "item_id")
    own = F.lit(None).cast("array<bigint>")
    for k in range(1, width + 1):
        own = F.when(F.col("width") == k, shingles_of(F.col("words"), k)).otherwise(own)
    # Each of an item's shingles that the window lacks costs one at least: what cannot reach the threshold is not counted out.
    most = F.size("shingles") - F.size(F.array_except("shingles", "own"))
    scored = pairs.withColumn("own", own).filter(most >= needed(F.size("shingles"), threshold))
    scored = scored.withColumn("similarity", similarity(F.col("own"), F.col("shingles")))
    scored = scored.filter(F.col("similarity") >= threshold).select("window", "item_id", "similarity")
    found = windows.select("doc_id", "start_word", F.size("words").alias("n_words"), "window").join(scored, "window")
    best = F.min_by(F.struct("start_word", "n_words", "similarity"), F.struct(-F.col("similarity"), "start_word", "n_words"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("m")).select("doc_id", "item_id", "m.*")


SQL = f"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark
), bs AS (
  SELECT item_id, len(w) AS n, unnest(range(len(w) - {WIDTH - 1})) AS q, w FROM b WHERE len(w) >= {WIDTH}
), bk AS (SELECT item_id, n, q, array_to_string(w[q + 1:q + {WIDTH}], ' ') AS s FROM bs
), ds AS (SELECT doc_id, len(w) AS size, unnest(range(len(w) - {WIDTH - 1})) AS p, w FROM d WHERE len(w) >= {WIDTH}
), dk AS (SELECT doc_id, size, p, array_to_string(w[p + 1:p + {WIDTH}], ' ') AS s FROM ds
), spans AS (
  SELECT DISTINCT doc_id, item_id, greatest(0, least(greatest(0, p - q), size - n)) AS start, n FROM dk JOIN bk USING (s)
), held AS (
  SELECT s.doc_id, s.item_id, s.start, s.n, d.w[s.start + 1:s.start + s.n] AS words, b.w AS item
  FROM spans s JOIN d USING (doc_id) JOIN b USING (item_id)
), counted AS (
  SELECT doc_id, item_id, start, len(words) AS n_words,
         list_transform(range(greatest(len(words) - {WIDTH - 1}, 0)), lambda i: array_to_string(words[i + 1:i + {WIDTH}], ' ')) AS x,
         list_transform(range(len(item) - {WIDTH - 1}), lambda i: array_to_string(item[i + 1:i + {WIDTH}], ' ')) AS y
  FROM held
), scored AS (
  SELECT doc_id, item_id, start, n_words, len(x) + len(y) AS total,
         list_sum(list_transform(list_distinct(x || y), lambda k: least(len(list_filter(x, lambda z: z = k)), len(list_filter(y, lambda z: z = k))))) AS low
  FROM counted
), kept AS (
  SELECT doc_id, item_id, start, n_words, low::DOUBLE / (total - low)::DOUBLE AS similarity FROM scored WHERE low::DOUBLE / (total - low) >= {SIMILARITY}
)
SELECT doc_id, item_id, start AS start_word, n_words, similarity FROM kept
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, n_words) = 1
"""


@query("op6_benchmark_decontamination", SQL)
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
