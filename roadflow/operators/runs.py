"""Run lengths over ordered rows.

``streaks`` splits each key into time chunks so that a key holding a large part of all rows is
worked on by many tasks: runs are counted inside a chunk, the open run at a chunk's end is
carried on over the chunk summaries (one row per key and chunk), and only then added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def streaks(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    conditions: dict[str, Column],
    chunk: Column | None = None,
) -> DataFrame:
    """Add per condition the number of rows in a row, up to this one, that fulfil it.

    Null counts as not fulfilled. Without ``chunk`` one window per key is used: right for
    series with a bounded number of rows per key (one row per five minutes), not for raw rows.
    """
    flags = {name: F.coalesce(cond, F.lit(False)) for name, cond in conditions.items()}
    if chunk is None:
        return _local(rows, keys, order, flags).drop("_row", *[f"_stop_{n}" for n in flags])

    local = _local(rows.withColumn("_chunk", chunk), [*keys, "_chunk"], order, flags)
    summary = local.groupBy(*keys, "_chunk").agg(
        F.max("_row").alias("_rows"), *[F.max(f"_stop_{n}").alias(f"_last_{n}") for n in flags]
    )
    by_key = W.partitionBy(*keys).orderBy("_chunk")
    so_far = by_key.rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = summary
    for name in flags:
        last = F.col(f"_last_{name}")
        carried = carried.withColumn(f"_breaks_{name}", F.count_if(last > 0).over(so_far))
        open_run = F.col("_rows") - last
        in_group = W.partitionBy(*keys, f"_breaks_{name}").orderBy("_chunk").rowsBetween(
            W.unboundedPreceding, W.currentRow
        )
        carried = carried.withColumn(f"_open_{name}", F.sum(open_run).over(in_group))
    carried = carried.select(
        *keys,
        "_chunk",
        *[F.lag(f"_open_{n}", 1, 0).over(by_key).alias(f"_in_{n}") for n in flags],
    )
    out = local.join(carried, [*keys, "_chunk"])
    for name in flags:
        before_stop = F.col(f"_stop_{name}") == 0
        out = out.withColumn(
            name, F.col(name) + F.when(before_stop, F.col(f"_in_{name}")).otherwise(0)
        )
    helpers = ["_row", "_chunk"] + [f"{p}{n}" for n in flags for p in ("_stop_", "_in_")]
    return out.drop(*helpers)


def _local(
    rows: DataFrame, keys: list[str], order: list[str], flags: dict[str, Column]
) -> DataFrame:
    by = W.partitionBy(*keys).orderBy(*order)
    so_far = by.rowsBetween(W.unboundedPreceding, W.currentRow)
    out = rows.withColumn("_row", F.row_number().over(by).cast("bigint"))
    out = out.withColumns({f"_flag_{n}": flag for n, flag in flags.items()})
    for name in flags:
        stop = F.when(F.col(f"_flag_{name}"), F.lit(0)).otherwise(F.col("_row"))
        out = out.withColumn(f"_stop_{name}", F.max(stop).over(so_far))
        out = out.withColumn(name, F.col("_row") - F.col(f"_stop_{name}"))
    return out.drop(*[f"_flag_{n}" for n in flags])


def longest_true_run(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    conditions: dict[str, Column],
    chunk: Column | None = None,
) -> DataFrame:
    """Longest streak of each condition per key; 0 where it never holds."""
    counted = streaks(rows, keys, order, conditions, chunk)
    return counted.groupBy(*keys).agg(*[F.max(n).alias(n) for n in conditions])
