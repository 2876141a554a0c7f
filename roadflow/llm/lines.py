"""Line dedup with a log-template tree: lines that recur across documents, up to their variable fields.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading tokens,
where a token with a digit counts as a variable field. In a leaf, a token is constant where
several documents have it at that place and it makes up a fair share of the leaf's different
lines there; so a field stays variable however often each of its values recurs. A line with
enough constant tokens follows the template that its constants state; any other line is a
template of its own. Of each template that several documents share, the lines in the document
with the smallest id stay and all others go. Lines of few tokens are compared as they are:
those of some length like any other, shorter ones only where many documents have them.
Built-in functions throughout.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm.common import stored, table
from roadflow.llm.registry import query

#: Tokens that a line needs to be taken apart; those with fewer recur by chance.
MIN_TOKENS = 5
#: Characters from which such a line still tells enough to go as an exact repeat, as in scripts without spaces.
MIN_CHARS = 20
#: Documents that must have a line below both limits.
SHORT_DOCUMENTS = 20
#: A token is constant at a place where at least one in so many different lines of the leaf has it.
CONSTANT_ONE_IN = 4
#: Leading tokens that lead to a leaf.
DEPTH = 3
#: Share of a line's tokens that must be constant.
SIMILARITY = 0.75
_FIELD = "<*>"
_NO_ID = -(2**63)


def masked(line: Column) -> Column:
    """The line with every token that holds a digit replaced by a variable field."""
    return F.when(F.rlike(line, F.lit("[0-9]")), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", _FIELD)).otherwise(line)


def _lines(documents: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """(_doc, _row, pos, masked, leaf, whole, short): all lines but blank ones of few tokens.

    Tokens are separated by single blanks, and any white space inside a line counts as a blank. A
    line of fewer than ``min_tokens`` tokens is a leaf of its own; ``short`` are those below ``MIN_CHARS``.
    """
    text = F.col("text")
    odd = r"[\t\r\x0B\f]"
    blanked = F.when(F.rlike(text, F.lit(odd)), F.regexp_replace(text, odd, " ")).otherwise(text)
    rows = documents.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("_doc"), "_row", F.posexplode(F.split(blanked, "\n")).alias("pos", "line"))
    rows = rows.select("_doc", "_row", "pos", masked(F.col("line")).alias("masked"))
    # Tokens are counted by their gaps, in bytes; the leading ones are cut off without splitting the rest.
    tokens = F.octet_length("masked") - F.octet_length(F.replace("masked", F.lit(" "))) + 1
    rows = rows.withColumn("_n", tokens).filter((F.col("_n") >= min_tokens) | (F.trim("masked") != ""))
    whole = F.xxhash64("masked")
    few = F.col("_n") < min_tokens
    leaf = F.when(few, whole).otherwise(F.xxhash64("_n", F.substring_index("masked", " ", depth)))
    short = few & (F.length("masked") < MIN_CHARS)
    return rows.select("_doc", "_row", "pos", "masked", leaf.alias("leaf"), whole.alias("whole"), short.alias("short"))


def recurring_templates(lines: DataFrame, hashes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(leaf, whole, keep): which document keeps each recurring line of ``lines``.

    ``hashes`` are the same lines without their text, stored, so that texts are taken apart once less.

    Leaves are summed up first, which settles those with one document (nothing recurs) and those
    with one text (an exact template). Only lines of the other leaves are taken apart, each
    distinct text once however often it occurs.
    """
    leaves = hashes.groupBy("leaf").agg(
        F.min("_doc").alias("keep"), F.max("_doc").alias("_last"), F.min("whole").alias("whole"), F.max("whole").alias("_other"),
        F.bool_or("short").alias("short"), F.count(F.lit(1)).alias("_lines"),
    )
    leaves = stored(leaves.filter(f"keep <> _last and (not short or _lines >= {SHORT_DOCUMENTS})"), "line-leaves")
    exact = leaves.filter("whole = _other and not short").select("leaf", "whole", "keep")
    # Of short lines the documents are counted, not the lines.
    many = leaves.filter("short").select("leaf")
    many = hashes.join(many, "leaf", "left_semi").select("leaf", "_doc").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("_docs"))
    often = leaves.filter("short").join(many.filter(F.col("_docs") >= SHORT_DOCUMENTS), "leaf").select("leaf", "whole", "keep")
    mixed = leaves.filter("whole <> _other").select("leaf")
    texts = lines.join(mixed, "leaf", "left_semi").groupBy("leaf", "whole", "masked").agg(F.min("_doc").alias("a"), F.max("_doc").alias("b"))
    texts = stored(texts, "line-texts")
    tokens = texts.select("leaf", "whole", "a", "b", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    tokens = tokens.withColumn("key", F.xxhash64("leaf", "at", "token"))
    per_token = tokens.groupBy("key").agg(
        F.min("a").alias("_a"), F.max("b").alias("_b"), F.count(F.lit(1)).alias("_texts"), F.min("leaf").alias("leaf")
    )
    sizes = texts.groupBy("leaf").agg(F.count(F.lit(1)).alias("_of"))
    constant = per_token.filter("_a <> _b").join(sizes, "leaf").filter(F.col("_texts") * CONSTANT_ONE_IN >= F.col("_of"))
    # The sum of the constants' hashes states the template: same leaf, places and tokens.
    per_line = (
        tokens.join(constant.select("key"), "key")
        .groupBy("leaf", "whole")
        .agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(key, 'place'))").alias("template"))
    )
    sized = texts.select("leaf", "whole", "a", "b", F.size(F.split("masked", " ")).alias("size"))
    fits = F.coalesce(F.col("n") >= F.ceil(F.col("size") * F.lit(similarity)), F.lit(False))
    own = F.when(fits, F.col("template")).otherwise(F.xxhash64("whole", F.lit("exact")))
    fitted = sized.join(per_line, ["leaf", "whole"], "left").withColumn("template", own)
    shared = fitted.groupBy("leaf", "template").agg(F.min("a").alias("keep"), F.max("b").alias("_last")).filter("keep <> _last")
    general = fitted.join(shared.drop("_last"), ["leaf", "template"]).select("leaf", "whole", "keep")
    return exact.unionByName(often).unionByName(general)


def drop_recurring_lines(
    documents: DataFrame, min_tokens: int = MIN_TOKENS, depth: int = DEPTH, similarity: float = SIMILARITY
) -> DataFrame:
    """``documents`` with recurring lines taken out of ``text``, plus ``n_lines`` and ``n_dropped``.

    Lines end at newlines, tokens at single white-space characters. Lines that recur only within one
    document stay, and blank ones of few tokens. A null text stays null and has no lines; a null id counts as one document before all others; repeated
    rows of one document lose the same lines. Other columns, also those that share a name with
    a result of this function, keep their values unless it writes them. An empty table gives no
    rows. A document's own line numbers are the only list gathered.
    """
    out = [c for c in documents.columns if c not in ("text", "n_lines", "n_dropped")]
    # Names that no column of the input has.
    row, list_ = (f"_{name}_{uuid.uuid4().hex[:12]}" for name in ("row", "gone"))
    rows = documents.select(*out, "text", F.xxhash64("doc_id", "text").alias(row))
    lines = _lines(rows.select("doc_id", "text", F.col(row).alias("_row")), min_tokens, depth)
    hashes = stored(lines.drop("masked"), "line-hashes")
    templates = recurring_templates(lines, hashes, similarity)
    gone = hashes.join(templates, ["leaf", "whole"]).filter("_doc <> keep")
    gone = gone.groupBy(F.col("_row").alias(row)).agg(F.collect_set("pos").alias(list_))
    split = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(list_))
    text = F.when(F.col(list_).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    )
    return rows.join(gone, row, "left").select(
        *out,
        text.alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.coalesce(F.size(list_), F.lit(0)).cast("long").alias("n_dropped"),
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM documents
), marked AS (
  SELECT doc_id, pos, regexp_replace(
    translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    '), '[^ ]*[0-9][^ ]*', '{_FIELD}', 'g') AS masked
  FROM lines
), split AS (
  SELECT *, string_split(masked, ' ') AS tokens FROM marked
), texts AS (
  SELECT (len(tokens), tokens[1:{DEPTH}])::VARCHAR AS leaf, masked, tokens, min(doc_id) AS a, max(doc_id) AS b
  FROM split WHERE len(tokens) >= {MIN_TOKENS} GROUP BY masked, tokens
), leaves AS (
  SELECT leaf, count(*) AS n_texts FROM texts GROUP BY leaf
), places AS (
  SELECT leaf, masked, a, b, generate_subscripts(tokens, 1) AS place, unnest(tokens) AS token FROM texts
), constant AS (
  SELECT leaf, place, token FROM places JOIN leaves USING (leaf) GROUP BY leaf, place, token, n_texts
  HAVING min(a) <> max(b) AND count(*) * {CONSTANT_ONE_IN} >= n_texts
), fitted AS (
  SELECT p.masked, list((p.place, p.token) ORDER BY p.place)::VARCHAR AS template
  FROM places p JOIN constant c ON p.leaf = c.leaf AND p.place = c.place AND p.token = c.token
  GROUP BY p.masked HAVING count(*) >= ceil(len(string_split(p.masked, ' ')) * {SIMILARITY})
), kept AS (
  SELECT masked, min(a) OVER (PARTITION BY leaf, coalesce(template, ''), CASE WHEN template IS NULL THEN masked END) AS keep
  FROM texts LEFT JOIN fitted USING (masked)
  UNION ALL
  SELECT masked, min(doc_id) FROM split WHERE len(tokens) < {MIN_TOKENS} AND trim(masked) <> ''
  GROUP BY masked HAVING length(masked) >= {MIN_CHARS} OR count(DISTINCT doc_id) >= {SHORT_DOCUMENTS}
), gone AS (
  SELECT doc_id, pos FROM split JOIN kept USING (masked) WHERE doc_id <> keep
)
SELECT l.doc_id,
       coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text,
       count(*) AS n_lines, count(g.pos) AS n_dropped
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
GROUP BY l.doc_id
"""


@query("op1_line_dedup", SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
