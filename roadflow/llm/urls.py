"""URL filters: given host and path rules first, then association rules mined from labels.

Spark's FP-growth finds combinations of URL tokens among the bad pages, tokens that always come
together folded to one; rules below the bounds of support, confidence and lift are pruned. A
rule is indexed by one of its tokens (the rarest), so a URL is compared only with rules of which it holds that token. Built-in functions
throughout.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm.common import lower_ascii, stored, table
from roadflow.llm.registry import query

#: (verdict, host, path prefix): the rules of the registered query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_SUPPORT = 0.002
MIN_PAGES = 5
MIN_CONFIDENCE = 0.7
MIN_LIFT = 1.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's. Of rules of the
    same length the one with the longer host wins, then block before allow.
    """
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    order = sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r[0] == "block"))
    for verdict, own, prefix in order:
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(prefix))
        best = F.when(fits, F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def url_tokens(url: Column) -> Column:
    """Distinct tokens: labels of the host, parts of the path with numbers as ``#``, names of query fields."""
    host = F.transform(F.split(host_of(url), r"\."), lambda x: F.concat(F.lit("h:"), x))
    path = F.transform(
        F.split(F.regexp_replace(lower_ascii(path_of(url)), "[0-9]+", "#"), "[^a-z#]+"), lambda x: F.concat(F.lit("p:"), x)
    )
    fields = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), "[&;]")
    fields = F.transform(fields, lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    scheme = F.concat(F.lit("s:"), lower_ascii(F.substring_index(F.coalesce(url, F.lit("")), "://", 1)))
    scheme = F.when(F.contains(url, F.lit("://")), F.array(scheme)).otherwise(F.array().cast("array<string>"))
    whole = F.array(F.concat(F.lit("site:"), host_of(url)))
    found = F.array_distinct(F.concat(scheme, whole, host, path, fields))
    return F.filter(found, lambda x: ~x.isin("h:", "p:", "q:", "site:"))


def bad_pages(labels: DataFrame) -> DataFrame:
    """(page_id, bad): pages marked toxic or of low quality; conflicting rows count as bad."""
    known = labels.filter("doc_id is not null and (toxic is not null or quality is not null)")
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    return known.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad.cast("int")).alias("bad"))


def fold_tokens(baskets: DataFrame, least: int) -> DataFrame:
    """(token, name, alike) of tokens on at least ``least`` pages; tokens on just the same pages share a name.

    Tokens that always come together double the combinations with each of them and tell nothing
    more, so mining sees one name for all. ``baskets`` holds row and items. Tokens alike lie in one
    URL, which bounds their list.
    """
    held = baskets.select("row", F.explode("items").alias("token"))
    hashed = F.xxhash64("row")
    same = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(hashed).alias("x"), F.sum(hashed.cast("decimal(38, 0)")).alias("s"))
    groups = same.filter(F.col("n") >= least).groupBy("n", "x", "s").agg(F.sort_array(F.collect_list("token")).alias("alike"))
    return groups.select(F.explode("alike").alias("token"), F.col("alike")[0].alias("name"), "alike")


def mine_rules(
    pages: DataFrame,
    labels: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """(tokens, alike, key, confidence, support): token combinations that go with a bad label.

    Combinations are mined among the bad pages alone, where a rule's support lies, and then counted
    among the good ones. ``tokens`` names one token for each list of ``alike`` ones, which were on
    the same labelled pages: a rule wants one of each list. Rules that a subset of their tokens
    states with at least the same confidence are redundant and pruned. ``key`` is a token by which
    the rule is indexed, a row for each token alike. A rule needs at least ``min_pages`` bad
    pages; with fewer labels there are none.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", "url").join(bad_pages(labels), "page_id")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "bad", url_tokens(F.col("url")).alias("items"))
    baskets = stored(rows, "url-baskets")
    schema = "tokens array<string>, alike array<array<string>>, key string, confidence double, support double"
    known, bad = baskets.agg(F.count(F.lit(1)), F.count_if(F.col("bad") == 1)).first()
    least = max(math.ceil(min_support * known), min_pages)
    if bad < least:
        return spark.createDataFrame([], schema)
    folded = stored(fold_tokens(baskets, least), "url-tokens")
    held = baskets.select("row", "bad", F.explode("items").alias("token")).join(folded.drop("alike"), "token")
    named = stored(held.groupBy("row", "bad").agg(F.sort_array(F.collect_set("name")).alias("items")), "url-names")
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / bad, minConfidence=1.0).fit(named.filter("bad = 1").select("items"))
    sets = stored(model.freqItemsets.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n_bad")), "url-sets")
    if sets.isEmpty():
        return spark.createDataFrame([], schema)
    sets = sets.withColumn("id", F.xxhash64("tokens"))
    counts = named.select(F.explode("items").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    rarest = (
        sets.select("id", F.explode("tokens").alias("token")).join(counts, "token").groupBy("id").agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    )
    sets = stored(sets.join(rarest, "id"), "url-sets-by-key")
    good = named.filter("bad = 0").select("items", F.explode("items").alias("key")).join(sets.select("id", "key", "tokens"), "key")
    good = good.filter(F.size(F.array_except("tokens", "items")) == 0).groupBy("id").agg(F.count(F.lit(1)).alias("n_good"))
    confidence = F.col("n_bad") / (F.col("n_bad") + F.coalesce("n_good", F.lit(0)))
    rules = sets.join(good, "id", "left").select("id", "tokens", "key", confidence.alias("confidence"), (F.col("n_bad") / known).alias("support"))
    rules = stored(rules.filter((F.col("confidence") >= min_confidence) & (F.col("confidence") >= min_lift * bad / known)), "url-rules")
    # A shorter rule that is part of another meets it at each of its own tokens.
    parts = rules.select("id", F.size("tokens").alias("n"), "confidence", F.explode("tokens").alias("token"))
    shared = parts.alias("a").join(parts.alias("b"), "token").filter("a.id <> b.id and a.n < b.n and a.confidence >= b.confidence")
    redundant = shared.groupBy("a.id", "b.id", "a.n").count().filter("count = n").select(F.col("b.id").alias("id")).distinct()
    kept = rules.join(redundant, "id", "left_anti")
    alike = folded.filter("token = name").select("name", "alike")
    lists = kept.select("id", F.explode("tokens").alias("name")).join(alike, "name")
    lists = lists.groupBy("id").agg(F.sort_array(F.collect_list("alike")).alias("lists"))
    keyed = kept.join(lists, "id").join(alike.toDF("key", "keys"), "key")
    return stored(keyed.select("tokens", F.col("lists").alias("alike"), F.explode("keys").alias("key"), "confidence", "support"), "url-index")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], mined: DataFrame) -> DataFrame:
    """Every page with host, path, rule, verdict and the confidence of the best mined rule.

    The given rules come first; else a page is blocked if a mined rule's tokens are all in its
    URL, and allowed if not. A null URL has empty host and path and is allowed. Each distinct URL
    is matched once, so repeated URLs cost one look-up. Other columns stay; those named as a result are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "confidence")
    # A name that no column of the input has.
    fit = f"fit_{uuid.uuid4().hex}"
    distinct = pages.filter("url is not null").select("url").distinct().withColumn("held", url_tokens(F.col("url")))
    held = distinct.select("url", "held", F.explode("held").alias("key"))
    matched = (
        held.join(mined, "key")
        .filter(F.forall("alike", lambda one_of: F.arrays_overlap(one_of, "held")))
        .groupBy("url")
        .agg(F.max("confidence").alias("confidence"))
    )
    out = pages.join(matched, "url", "left").withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    out = out.withColumn(fit, fitting_rule(F.col("host"), F.col("path"), rules))
    learned = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return out.select(
        *pages.columns,
        "host",
        "path",
        F.col(f"{fit}.rule").alias("rule"),
        F.coalesce(f"{fit}.verdict", learned).alias("verdict"),
        "confidence",
    )


@query("op8_url_filters")
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    mined = mine_rules(pages, table(spark, sf_dir, "labels"))
    return judge_urls(pages, RULES, mined).select("page_id", "host", "path", "rule", "verdict", "confidence")
