"""Closure status: run counters, profile match, thresholds, weighted running mean.

Everything that does not depend on the mean itself is computed in columns: which rule a row
falls under, its weights, and the momentum factor. What is left is the recurrence
``mean = (p * mean + w * x) / (p + w) * alpha`` with at most one ``max``, which has no
constant-size combiner and is run over the sorted rows with one number of state per segment.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadflow import config as cfg
from roadflow.functions import scalars as S
from roadflow.session import shared_dir, ship_package

PROFILE_VALUES = [
    "fcd_mean_median",
    "max_consecutive_zeros_q95",
    "max_consecutive_zeros_or_ones_q95",
]
STATE = [
    "consecutive_zeros",
    "consecutive_low",
    "max_consecutive_zeros_q95",
    "max_consecutive_zeros_or_ones_q95",
    "running_mean",
]
OUTPUT = [
    "segment_id",
    "time",
    "fcd",
    "consecutive_zeros",
    "consecutive_low",
    "day_of_week",
    "hour_of_day",
    *PROFILE_VALUES,
    "running_mean",
    "segment_closure_status",
]


def coverage_in_range(fcd: Column) -> Column:
    return fcd.isNull() | fcd.between(0, 10)


def coverage_rejects(series: DataFrame) -> DataFrame:
    """Rows whose coverage is outside 0..10."""
    return series.filter(~coverage_in_range(F.col("fcd"))).withColumn("reason", F.lit("fcd_out_of_range"))


def _by_time() -> W:
    return W.partitionBy("segment_id").orderBy("time")


def _so_far() -> W:
    return _by_time().rowsBetween(W.unboundedPreceding, W.currentRow)


def zero_run_counters(series: DataFrame) -> DataFrame:
    """Running count of rows in a row with 0, and with 0 or 1; null resets both.

    ``series`` has one row per (segment, five-minute window), so a segment's window is bounded by
    the validated time range. For raw rows use ``runs.streaks`` with a chunk.
    """
    fcd = F.col("fcd")
    row = F.row_number().over(_by_time())
    out = series.withColumn("_row", row)
    for name, holds in (("consecutive_zeros", fcd == 0), ("consecutive_low", fcd.isin(0, 1))):
        stop = F.when(F.coalesce(holds, F.lit(False)), 0).otherwise(F.col("_row"))
        out = out.withColumn(name, (F.col("_row") - F.max(stop).over(_so_far())).cast("int"))
    return out.drop("_row")


def match_profile(series: DataFrame, profile: DataFrame) -> DataFrame:
    """Left join of live rows with the profile bucket of their weekday and hour.

    The profile is packed to one row per segment (at most 168 buckets), so the join key is the
    segment alone and the shuffle is the one the counters and thresholds need as well.
    """
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    day = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("day_of_week")) - 1
    bucket = (day * 24 + F.col("hour_of_day")).cast("int")
    packed = (
        profile.groupBy("segment_id")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct(bucket.alias("key"), F.struct(*PROFILE_VALUES).alias("value")))
            ).alias("_map")
        )
        .select(
            "segment_id",
            F.transform(F.sequence(F.lit(0), F.lit(167)), lambda b: F.col("_map")[b]).alias("_week"),
        )
    )
    time = F.col("time")
    place = S.day_index(time) * 24 + S.hour_of_day(time)
    return (
        series.join(packed, "segment_id", "left")
        .withColumn("_bucket", F.get("_week", place))
        .select(
            *series.columns,
            S.day_name(time).alias("day_of_week"),
            S.hour_of_day(time).alias("hour_of_day"),
            *[F.col(f"_bucket.{c}").alias(c) for c in PROFILE_VALUES],
        )
    )


def _last_stored(stored: DataFrame) -> DataFrame:
    return stored.groupBy("segment_id").agg(F.max_by(F.struct(*STATE, "time"), "time").alias("_stored"))


def attach_previous(rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Add ``_stored``: the last stored validation row per segment, null where there is none.

    Only rows newer than the stored one continue it; the others are left out here and listed by
    ``replayed_rows``.
    """
    if stored is None:
        kinds = dict(consecutive_zeros="int", consecutive_low="int", time="timestamp")
        empty = F.struct(*[F.lit(None).cast(kinds.get(c, "double")).alias(c) for c in [*STATE, "time"]])
        return rows.withColumn("_stored", F.when(F.lit(False), empty))
    newer = F.col("_stored").isNull() | (F.col("time") > F.col("_stored.time"))
    return rows.join(_last_stored(stored), "segment_id", "left").filter(newer)


def replayed_rows(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows not newer than what is stored for their segment: for a repair run over the whole range."""
    last = stored.groupBy("segment_id").agg(F.max("time").alias("stored_until"))
    return rows.join(last, "segment_id").filter(F.col("time") <= F.col("stored_until"))


def lag_thresholds(rows: DataFrame) -> DataFrame:
    """Current and previous run length and the threshold of the previous row.

    The current row's usual coverage decides whether runs of 0 or of {0, 1} are looked at; a
    missing bucket counts as the latter. The first row falls back on the stored row.
    """
    before = lambda c: F.coalesce(F.lag(c).over(_by_time()), F.when(F.col("_first"), F.col(f"_stored.{c}")))
    rows = rows.withColumn("_first", F.row_number().over(_by_time()) == 1)
    zeros = F.coalesce(F.col("fcd_mean_median") < cfg.ZEROS_OR_ONES_BELOW, F.lit(False))
    pick = lambda a, b: F.when(zeros, a).otherwise(b)
    threshold = pick(F.col("_prev_q95_zeros"), F.col("_prev_q95_low"))
    return (
        rows.withColumn("_prev_zeros", before("consecutive_zeros"))
        .withColumn("_prev_low", before("consecutive_low"))
        .withColumn("_prev_q95_zeros", before("max_consecutive_zeros_q95"))
        .withColumn("_prev_q95_low", before("max_consecutive_zeros_or_ones_q95"))
        .withColumn(
            "run", F.coalesce(pick(F.col("consecutive_zeros"), F.col("consecutive_low")), F.lit(0))
        )
        .withColumn("previous_run", F.coalesce(pick(F.col("_prev_zeros"), F.col("_prev_low")), F.lit(0)))
        .withColumn(
            "threshold",
            F.when(threshold.isNull(), cfg.NULL_PROFILE).otherwise(
                F.greatest(threshold, F.lit(cfg.MIN_PROFILE))
            ),
        )
    )


def mean_weights(rows: DataFrame) -> DataFrame:
    """The rule of each row as numbers: ``_p`` and ``_w`` weights, ``_x`` value, ``_floor``.

    The new mean is ``(p*r + w*v) / (p + w)`` with ``v = max(r, x)`` where ``_floor`` is set and
    ``v = x`` elsewhere; weight 0 leaves the mean alone. Null coverage leaves it alone too.
    """
    run, prev, limit = F.col("run"), F.col("previous_run"), F.col("threshold")
    fcd, usual = F.col("fcd"), F.col("fcd_mean_median")
    ratio = run / (2 * limit)
    drop = F.coalesce(usual - fcd > cfg.COVERAGE_DROP, F.lit(False))
    rule = (
        F.when(fcd.isNull(), 0)
        .when((limit > cfg.MAX_PROFILE) & (run > limit), 0)
        .when((run == 0) & (prev < limit), 2)
        .when(run != 0, 3)
        .when(drop, 4)
        .when(fcd > cfg.COVERAGE_HIGH, 5)
        .otherwise(0)
    )
    k = F.col("_rule")
    weak = F.lit(cfg.MIN_PROFILE)
    return (
        rows.withColumn("_rule", rule)
        .withColumn("_p", F.when(k.isin(2, 3), limit).when(k.isin(4, 5), weak).otherwise(1.0))
        .withColumn(
            "_w",
            F.when(k.isin(2, 5), fcd.cast("double"))
            .when(k == 3, F.greatest(F.lit(1.0), ratio * ratio))
            .when(k == 4, cfg.DROP_WEIGHT)
            .otherwise(0.0),
        )
        .withColumn(
            "_x",
            F.when(k == 2, prev / (2 * limit))
            .when(k == 3, F.least(F.lit(1.0), ratio))
            .when(k == 4, 1.0)
            .otherwise(0.0),
        )
        .withColumn("_floor", k == 3)
    )


def momentum(rows: DataFrame) -> DataFrame:
    """Add ``k`` and ``_alpha``, the factor that speeds up reopening at low coverage.

    ``k`` restarts at 0 cars and doubles on repeated events, so it is a power of two of the
    doublings since the last restart: two running aggregates instead of a loop.
    """
    fcd, usual = F.col("fcd"), F.col("fcd_mean_median")
    live = ~F.col("_first") | F.col("_stored").isNotNull()
    gate = (
        live
        & F.coalesce(fcd < cfg.COVERAGE_HIGH, F.lit(False))
        & F.coalesce(usual - fcd <= cfg.COVERAGE_DROP, F.lit(False))
    )
    q95 = F.greatest(F.coalesce("_prev_q95_low", F.lit(cfg.MIN_PROFILE)), F.lit(cfg.MIN_PROFILE))
    again = (F.col("consecutive_low") == 0) & (F.col("_prev_low") <= F.col("_span"))
    restart = F.col("_gate") & (fcd == 0)
    doubles = F.col("_gate") & (fcd != 0) & F.coalesce(again, F.lit(False))
    since = F.col("_doubled") - F.coalesce(F.col("_at_restart"), F.lit(0))
    echo = F.greatest(
        F.lit(0.0), (F.col("_span") - F.col("consecutive_low")) / F.col("_span")
    )
    return (
        rows.withColumn("_gate", gate)
        .withColumn("_span", cfg.DECAY * q95)
        .withColumn("_doubled", F.count_if(doubles).over(_so_far()))
        .withColumn("_at_restart", F.max(F.when(restart, F.col("_doubled"))).over(_so_far()))
        .withColumn(
            "k", F.least(F.lit(cfg.K_MAX), cfg.K_START * F.pow(F.lit(2.0), F.least(since, F.lit(60))))
        )
        .withColumn("_alpha", F.when(F.col("_gate"), F.exp(-F.col("k") * echo)).otherwise(1.0))
    )


def _running_mean(rows: DataFrame, keys: Sequence[str] = ("segment_id",)) -> DataFrame:
    """Run the recurrence over rows that carry ``_p, _w, _x, _floor, _alpha, _start``.

    The windows before have put a segment's rows into one partition; the sort is a no-op then.
    Batches stream through with one number of state, so memory does not grow with a segment.
    ``_start`` restarts the mean on a segment's first row (the row itself changes nothing if it
    has no stored predecessor: its weights are neutral). ``keys`` tell where rows that belong together lie.
    """
    ordered = rows.sortWithinPartitions(*keys, "time")
    fields = [f for f in ordered.schema.fields if f.name not in ("_p", "_w", "_x", "_floor", "_alpha", "_start")]
    names = [f.name for f in fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    # Bound here, so that workers need no module of this package.
    initial = cfg.INITIAL_MEAN

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = initial
        for batch in batches:
            column = {c: batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("_p", "_w", "_x", "_alpha")}
            start = batch.column("_start").to_pylist()
            floor = batch.column("_floor").to_pylist()
            out = np.empty(batch.num_rows)
            steps = zip(start, column["_p"], column["_w"], column["_x"], floor, column["_alpha"])
            for i, (first, p, w, x, raised, alpha) in enumerate(steps):
                if first is not None:
                    mean = first
                if raised and mean > x:
                    x = mean
                mean = (p * mean + w * x) / (p + w) * alpha
                out[i] = mean
            arrays = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(out)], names=[*names, "running_mean"])

    return ordered.mapInArrow(scan, f"{schema}, running_mean double")


#: The mean as a function of the mean before: on [lo, next lo) it is a * mean + b, rising and convex.
Pieces = list[tuple[float, float, float]]


def compose(pieces: Pieces, p: float, w: float, x: float, raised: bool, alpha: float) -> Pieces:
    """``pieces`` followed by one row's step.

    A step is a line, or with ``raised`` the larger of two lines that meet where the mean is x.
    A map of means in 0..1 so stays rising and convex; only pieces on 0..1 are kept.
    """
    scale = alpha / (p + w)
    low, shift = p * scale, w * x * scale
    if not raised:
        return [(lo, a * low, b * low + shift) for lo, a, b in pieces]
    out: Pieces = []
    for i, (lo, a, b) in enumerate(pieces):
        hi = pieces[i + 1][0] if i + 1 < len(pieces) else 1.0
        if a * hi + b <= x:
            out.append((lo, a * low, b * low + shift))
        elif a * lo + b >= x:
            out.append((lo, a * alpha, b * alpha))
        else:
            cross = min(max((x - b) / a, lo), hi)
            out += [(lo, a * low, b * low + shift), (cross, a * alpha, b * alpha)]
    return out


def apply_pieces(pieces: Pieces, mean: float) -> float:
    """The mean after the rows that ``pieces`` stand for."""
    _, a, b = pieces[max(bisect_right(pieces, mean, key=lambda t: t[0]) - 1, 0)]
    return a * mean + b


def _running_mean_in_parts(rows: DataFrame, chunk: Column) -> DataFrame:
    """``_running_mean`` with every segment cut into chunks of time that different tasks work on.

    Each chunk becomes one map from the mean before it to the mean after it. These maps, a row
    per chunk, are run through in order and give each chunk's first mean; then all chunks are
    filled in side by side. Rows are written to the shared folder once and read twice.
    """
    spark = rows.sparkSession
    path = shared_dir(spark, "mean-parts")
    cut = rows.withColumn("_chunk", chunk.cast("bigint"))
    cut.repartition("segment_id", "_chunk").sortWithinPartitions("segment_id", "_chunk", "time").write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)
    keys = ["segment_id", "_chunk"]
    initial = cfg.INITIAL_MEAN
    # The workers need the package for the maps.
    ship_package(spark)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces = None, []

        def done() -> pa.RecordBatch:
            lo, a, b = ([float(t[i]) for t in pieces] for i in range(3))
            return pa.RecordBatch.from_pylist([{"segment_id": key[0], "_chunk": key[1], "lo": lo, "a": a, "b": b}], schema=kind)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("segment_id", "_chunk", "_start", "_p", "_w", "_x", "_floor", "_alpha"))
            for segment, part, first, p, w, x, raised, alpha in zip(*columns):
                if (segment, part) != key:
                    if key is not None:
                        yield done()
                    key, pieces = (segment, part), [(0.0, 1.0, 0.0)]
                if first is not None:
                    pieces = [(0.0, 0.0, first)]
                pieces = compose(pieces, p, w, x, raised, alpha)
        if key is not None:
            yield done()

    kind = pa.schema([("segment_id", pa.string()), ("_chunk", pa.int64())] + [(c, pa.list_(pa.float64())) for c in ("lo", "a", "b")])
    steps = cut.select(*keys, "time", "_start", "_p", "_w", "_x", "_floor", "_alpha")
    steps = steps.repartition(*keys).sortWithinPartitions(*keys, "time")
    maps = steps.mapInArrow(fold, "segment_id string, _chunk bigint, lo array<double>, a array<double>, b array<double>")

    def run_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, mean = None, initial
        for batch in batches:
            out = []
            for own, part, lo, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if own != segment:
                    segment, mean = own, initial
                out.append(mean)
                mean = apply_pieces(list(zip(lo, a, b)), mean)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=[*keys, "_before"])

    before = maps.repartition("segment_id").sortWithinPartitions(*keys).mapInArrow(run_through, "segment_id string, _chunk bigint, _before double")
    joined = cut.join(before, keys)
    first = F.row_number().over(W.partitionBy(*keys).orderBy("time")) == 1
    begun = joined.withColumn("_start", F.coalesce("_start", F.when(first, F.col("_before"))))
    return _running_mean(begun.drop("_before"), keys).drop("_chunk")


def closure_running_mean(matched: DataFrame, stored: DataFrame | None = None, chunk: Column | None = None) -> DataFrame:
    """Thresholds, weights, momentum and recurrence on rows with counters and profile values.

    ``chunk``: a number that does not fall as ``time`` rises (a day, a week); rows of a segment with
    different numbers can then be worked on by different tasks. It costs another shuffle.
    """
    rows = momentum(mean_weights(lag_thresholds(attach_previous(matched, stored))))
    neutral = F.col("_first") & F.col("_stored").isNull()
    start = F.when(
        F.col("_first"), F.coalesce(F.col("_stored.running_mean"), F.lit(cfg.INITIAL_MEAN))
    )
    ready = rows.select(
        "segment_id",
        "time",
        "fcd",
        "consecutive_zeros",
        "consecutive_low",
        "hour_of_day",
        *PROFILE_VALUES,
        "k",
        F.when(neutral, 1.0).otherwise(F.col("_p")).alias("_p"),
        F.when(neutral, 0.0).otherwise(F.col("_w")).alias("_w"),
        F.col("_x"),
        (F.col("_floor") & ~neutral).alias("_floor"),
        F.col("_alpha"),
        start.alias("_start"),
    )
    scanned = _running_mean(ready) if chunk is None else _running_mean_in_parts(ready, chunk)
    return scanned.withColumn("day_of_week", S.day_name(F.col("time")))


def validate(
    series: DataFrame, profile: DataFrame, stored: DataFrame | None = None, chunk: Column | None = None
) -> DataFrame:
    """Series (``segment_id, time, fcd``, one row per five minutes) to status rows.

    Rows with impossible coverage are left out here and listed by ``coverage_rejects``. The
    series is shuffled once, by segment: join, counters, thresholds and recurrence share it. Rows
    not newer than the stored state are left out and listed by ``replayed_rows``. ``chunk`` spreads the
    recurrence of long segments over tasks (``closure_running_mean``).
    """
    usable = series.filter(coverage_in_range(F.col("fcd")))
    if stored is not None:
        # Before the counters: a replayed row must not count towards the runs of later ones.
        last = stored.groupBy("segment_id").agg(F.max("time").alias("_until"))
        newer = F.col("_until").isNull() | (F.col("time") > F.col("_until"))
        usable = usable.join(last, "segment_id", "left").filter(newer).drop("_until")
    matched = zero_run_counters(match_profile(usable, profile))
    rows = closure_running_mean(matched, stored, chunk)
    return rows.withColumn(
        "segment_closure_status", S.closure_status(F.col("running_mean"))
    ).select(*OUTPUT)


def current_status(validation: DataFrame) -> DataFrame:
    """Newest status per segment."""
    last = F.max_by(F.struct("time", "running_mean", "segment_closure_status"), "time")
    return validation.groupBy("segment_id").agg(last.alias("_last")).select("segment_id", "_last.*")
