"""The normal week of a segment: hourly coverage, hour-of-week profile, quality gate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadflow import config as cfg
from roadflow.functions import scalars as S
from roadflow.operators.series import downsample_last
from roadflow.sources.tables import stored_days

VALUE_COLUMNS = [
    "fcd_mean_median",
    "max_consecutive_zeros_q95",
    "max_consecutive_zeros_or_ones_q95",
]


def _longest_run(present: Column, hits: Column, samples: int, fill: bool) -> Column:
    """Longest run of set bits of ``hits`` in slot order.

    A slot without a row counts as a hit when ``fill`` is on (missing means zero) and is
    skipped otherwise, as a run goes over the rows there are.
    """
    absent = "1" if fill else ""

    def mark(i: Column) -> Column:
        there, hit = F.getbit(present, i) == 1, F.getbit(hits, i) == 1
        return F.when(~there, absent).when(hit, "1").otherwise("0")

    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), mark), "")
    return F.array_max(F.transform(F.split(text, "0"), F.length)).cast("int")


def hourly_coverage(
    slots: DataFrame,
    start: Column | None = None,
    end: Column | None = None,
    fill: bool = True,
    samples_per_hour: int = cfg.SAMPLES_PER_HOUR,
) -> DataFrame:
    """Per segment and hour: mean coverage, longest run of 0 and longest run of 0 or 1.

    ``slots`` holds one row per (segment, five-minute window) with ``fcd_coverage``. With
    ``fill`` missing windows count as zero; with ``start``/``end`` (half-open, full hours) hours
    without any row appear too. The dense grid is never built: an hour is three numbers (sum
    and two bit sets of its windows), so everything is one partially aggregated shuffle.
    """
    if samples_per_hour > 60:
        raise ValueError("at most 60 samples per hour")
    time, fcd = F.col("time"), F.col("fcd_coverage")
    width = 60 // samples_per_hour
    place = F.floor(F.minute(time) / width).cast("int")
    value = S.zero_fill(fcd) if fill else fcd
    rows = slots.select(
        "segment_id",
        S.floor_hour(time).alias("hour_of_date"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), place).alias("_bit"),
        value.cast("bigint").alias("_fcd"),
    )
    ranged = start is not None and end is not None
    if ranged:
        rows = rows.filter((F.col("hour_of_date") >= start) & (F.col("hour_of_date") < end))
    none = F.lit(0).cast("bigint")
    per_hour = rows.groupBy("segment_id", "hour_of_date").agg(
        F.sum("_fcd").alias("_sum"),
        F.count("_fcd").alias("_n"),
        F.bit_or("_bit").alias("_present"),
        F.coalesce(F.bit_or(F.when(F.col("_fcd") == 0, F.col("_bit"))), none).alias("_zero"),
        F.coalesce(F.bit_or(F.when(F.col("_fcd").isin(0, 1), F.col("_bit"))), none).alias("_low"),
    )
    mean = F.coalesce("_sum", none) / samples_per_hour if fill else F.col("_sum") / F.col("_n")
    run = lambda hits: _longest_run(F.col("_present"), F.col(hits), samples_per_hour, fill)
    seen = per_hour.select(
        "segment_id",
        "hour_of_date",
        mean.alias("fcd_mean"),
        run("_zero").alias("max_consecutive_zeros"),
        run("_low").alias("max_consecutive_zeros_or_ones"),
    )
    return _with_empty_hours(seen, start, end, samples_per_hour) if ranged else seen


def _with_empty_hours(seen: DataFrame, start: Column, end: Column, samples: int) -> DataFrame:
    """Add the hours of ``[start, end)`` a segment has no row in: mean 0, one run of zeros.

    Only hours with rows are shuffled, by segment; each then unfolds into itself and the empty
    hours up to the next one, in place. The steps after it need the same partitioning. Its
    number of parts is fixed, as the shuffled bytes tell nothing about the unfolded rows.
    """
    parts = int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = seen.repartition(parts, "segment_id")
    by = W.partitionBy("segment_id").orderBy("hour_of_date")
    number = lambda t: F.floor(F.unix_seconds(t) / 3600)
    hour = number(F.col("hour_of_date"))
    spans = (
        seen.withColumn("_own", hour)
        .withColumn("_from", F.when(F.row_number().over(by) == 1, number(start)).otherwise(hour))
        .withColumn("_to", F.coalesce(F.lead(hour).over(by), number(end)) - 1)
    )
    unfolded = spans.withColumn("_hour", F.explode(F.sequence("_from", "_to")))
    own = F.col("_hour") == F.col("_own")
    full = F.lit(samples)
    return unfolded.select(
        "segment_id",
        F.timestamp_seconds(F.col("_hour") * 3600).alias("hour_of_date"),
        F.when(own, F.col("fcd_mean")).otherwise(0.0).alias("fcd_mean"),
        *[
            F.when(own, F.col(c)).otherwise(full).alias(c)
            for c in ("max_consecutive_zeros", "max_consecutive_zeros_or_ones")
        ],
    )


def mask_dead_hours(
    hourly: DataFrame, in_a_row: int = cfg.DEAD_HOURS_IN_A_ROW, dead_run: int = cfg.DEAD_HOUR_RUN
) -> DataFrame:
    """Null both run columns in stretches of at least ``in_a_row`` dead hours; the mean stays.

    An hour lies in such a stretch if the count of dead hours in a row reaches ``in_a_row`` at
    it or within the next ``in_a_row - 1`` hours without having been broken before, so one sort
    serves all steps. A segment's window sees one row per hour, a number set by the calendar.
    """
    by = W.partitionBy("segment_id").orderBy("hour_of_date")
    dead = F.coalesce(F.col("max_consecutive_zeros_or_ones") == dead_run, F.lit(False))
    alive_at = F.max(F.when(~F.col("_dead"), F.col("_row")).otherwise(0))
    so_far = by.rowsBetween(W.unboundedPreceding, W.currentRow)
    # The row before a long stretch, as far as one is seen from here; it must lie behind.
    before = F.min(F.when(F.col("_streak") >= in_a_row, F.col("_row") - F.col("_streak")))
    marked = (
        hourly.withColumn("_dead", dead)
        .withColumn("_row", F.row_number().over(by))
        .withColumn("_streak", F.col("_row") - alive_at.over(so_far))
        .withColumn("_before", before.over(by.rowsBetween(0, in_a_row - 1)))
        .withColumn("_long", F.coalesce(F.col("_before") < F.col("_row"), F.lit(False)))
    )
    keep = lambda c: F.when(~F.col("_long"), F.col(c)).alias(c)
    return marked.select(
        "segment_id",
        "hour_of_date",
        "fcd_mean",
        keep("max_consecutive_zeros"),
        keep("max_consecutive_zeros_or_ones"),
    )


def _one_decimal(value: Column) -> Column:
    """Scaled, rounded half to even and scaled back: ties as in binary arithmetic, not in decimal."""
    return F.rint(value * 10) / 10


def _quantile(values: Column, q: float) -> Column:
    """Linearly interpolated quantile of a sorted array, from the nearer neighbour.

    ``percentile`` weighs both neighbours, which differs in the last bit and so in rounding ties.
    """
    place = (F.size(values) - 1) * F.lit(q)
    low = F.floor(place).cast("int")
    t = place - low
    a, b = F.get(values, low), F.coalesce(F.get(values, low + 1), F.get(values, low))
    return F.when(t >= 0.5, b - (b - a) * (1 - t)).otherwise(a + (b - a) * t)


def hour_of_week_profile(hourly: DataFrame) -> DataFrame:
    """Per segment, weekday and hour: median of means, 95th percentiles of runs, hours seen.

    A group holds one row per week, a number set by the calendar, so its lists stay small.
    """
    time = F.col("hour_of_date")
    runs = ["max_consecutive_zeros", "max_consecutive_zeros_or_ones"]
    q95 = lambda c: _one_decimal(_quantile(F.col(f"_{c}"), 0.95)).alias(f"{c}_q95")
    return (
        hourly.groupBy(
            "segment_id",
            S.day_name(time).alias("day_of_week"),
            S.hour_of_day(time).alias("hour_of_day"),
        )
        .agg(
            _one_decimal(F.median("fcd_mean")).alias("fcd_mean_median"),
            *[F.array_sort(F.collect_list(c)).alias(f"_{c}") for c in runs],
            F.count("fcd_mean").alias("number_of_hours"),
        )
        .select(
            "segment_id",
            "day_of_week",
            "hour_of_day",
            "fcd_mean_median",
            *[q95(c) for c in runs],
            "number_of_hours",
        )
    )


def mask_low_availability(profile: DataFrame, min_weeks: int) -> DataFrame:
    enough = F.col("number_of_hours") >= min_weeks
    return profile.withColumns({c: F.when(enough, F.col(c)) for c in VALUE_COLUMNS})


def profile_quality_gate(
    profile: DataFrame,
    usable_below: float = cfg.USABLE_RUN_Q95,
    min_buckets: int = cfg.MIN_USABLE_BUCKETS,
) -> DataFrame:
    """Per segment: usable and total buckets, and whether the profile may be used."""
    usable = F.count_if(F.col("max_consecutive_zeros_q95") < usable_below)
    return (
        profile.groupBy("segment_id")
        .agg(usable.alias("usable_buckets"), F.count("*").alias("buckets"))
        .withColumn("accepted", F.col("usable_buckets") >= min_buckets)
        .withColumn("reason", F.when(~F.col("accepted"), "too_few_usable_buckets"))
    )


def fill_profile_nulls(profile: DataFrame) -> DataFrame:
    return profile.na.fill(
        {
            "max_consecutive_zeros_q95": cfg.MISSING_RUN_Q95,
            "max_consecutive_zeros_or_ones_q95": cfg.MISSING_RUN_Q95,
            "fcd_mean_median": cfg.MISSING_MEAN_MEDIAN,
        }
    )


def profile_from_hourly(
    hourly: DataFrame,
    min_weeks: int,
    in_a_row: int = cfg.DEAD_HOURS_IN_A_ROW,
    dead_run: int = cfg.DEAD_HOUR_RUN,
) -> DataFrame:
    """Masked hour-of-week profile before the gate and before null filling."""
    return mask_low_availability(
        hour_of_week_profile(mask_dead_hours(hourly, in_a_row, dead_run)), min_weeks
    )


def gated_profile(
    masked: DataFrame,
    usable_below: float = cfg.USABLE_RUN_Q95,
    min_buckets: int = cfg.MIN_USABLE_BUCKETS,
) -> DataFrame:
    """Profiles of accepted segments with nulls filled; the gate sees the unfilled values.

    The gate is a window over the at most 168 buckets of a segment, so nothing is joined.
    """
    by = W.partitionBy("segment_id")
    usable = F.count_if(F.col("max_consecutive_zeros_q95") < usable_below).over(by)
    kept = masked.withColumn("_usable", usable).filter(F.col("_usable") >= min_buckets)
    return fill_profile_nulls(kept.drop("_usable"))


def with_lifetime(
    profile: DataFrame, computed_at: Column, days: int = cfg.PROFILE_LIFETIME_DAYS
) -> DataFrame:
    return profile.withColumn("computed_at", computed_at).withColumn(
        "expires_at", computed_at + F.make_interval(days=F.lit(days))
    )


def drop_expired(profiles: DataFrame, as_of: Column) -> DataFrame:
    return profiles.filter(F.col("expires_at") >= as_of)


def expired_count(profiles: DataFrame, as_of: Column) -> DataFrame:
    """Number of expired profiles (segments), in one row."""
    old = profiles.filter(F.col("expires_at") < as_of)
    return old.agg(F.count_distinct("segment_id").alias("expired"))


def upsert_profiles(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Newest profile per segment: a segment's stored buckets go as soon as it has new ones."""
    both = stored.unionByName(new, allowMissingColumns=True)
    newest = F.max("computed_at").over(W.partitionBy("segment_id"))
    return (
        both.withColumn("_newest", newest).filter(F.col("computed_at") == F.col("_newest")).drop("_newest")
    )


def delete_profiles(stored: DataFrame, segments: DataFrame) -> DataFrame:
    return stored.join(segments.select("segment_id"), "segment_id", "left_anti")


def store_profiles(profiles: DataFrame, name: str, path: str, buckets: int = cfg.PROFILE_BUCKETS) -> DataFrame:
    """Profiles as a table bucketed and sorted by segment, under ``name`` in the session's catalog.

    Joins and groupings by segment read it without a shuffle, and a segment's profile is looked
    up in one bucket. ``path`` must be new for each version; the name then stands for the newest.
    """
    spark = profiles.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        profiles.repartition(buckets, "segment_id")
        .write.bucketBy(buckets, "segment_id")
        .sortBy("segment_id")
        .option("path", path)
        .format("parquet")
        .saveAsTable(name)
    )
    return spark.table(name)


def open_profiles(spark: SparkSession, name: str, path: str, schema: str, buckets: int = cfg.PROFILE_BUCKETS) -> DataFrame:
    """A table written by ``store_profiles``, made known to a session that has not written it."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet "
        f"CLUSTERED BY (segment_id) SORTED BY (segment_id) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def read_profile(stored: DataFrame, segments: list[str]) -> DataFrame:
    """The buckets of some segments' profiles; of a bucketed table only their files are read."""
    return stored.filter(F.col("segment_id").isin(segments))


def profile_ids(stored: DataFrame) -> DataFrame:
    return stored.select("segment_id").distinct().orderBy("segment_id")


def store_hours(
    obs: DataFrame, path: str, day: date, downsample: bool = True, tie: str | None = None, until: date | None = None
) -> None:
    """The hours of one day, with rows, as a part of the hour table; written again it replaces itself.

    Reads that day of ``obs`` alone. An hour is a mean and two runs, so the table is a small part of
    the series. With ``until`` all days of ``[day, until)`` are stored from one pass over the series,
    each as its own part; parts that are there already are emptied first, as a day may have lost its rows.
    """
    spark, stop = obs.sparkSession, F.date_add(F.lit(day), 1) if until is None else F.lit(until)
    rows = obs.filter((F.col("time") >= F.lit(day).cast("timestamp")) & (F.col("time") < stop.cast("timestamp")))
    slots = downsample_last(rows, ["fcd_coverage"], tie=tie) if downsample else rows
    hours = hourly_coverage(slots)
    if until is None:
        hours.write.mode("overwrite").parquet(f"{path}/date={day}")
        return
    for old in stored_days(spark, path):
        if day <= old < until:
            spark.createDataFrame([], hours.schema).write.mode("overwrite").parquet(f"{path}/date={old}")
    dated = hours.withColumn("date", F.to_date("hour_of_date")).hint("rebalance", "date")
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def rolling_profiles(
    spark: SparkSession, path: str, start: date, end: date, min_weeks: int, scale_rules: bool = False
) -> DataFrame:
    """``build_profiles`` of the days in ``[start, end)`` from the hour table, the series not being read.

    A new day comes in by ``store_hours`` and an old one drops out by the range. Stretches of dead
    hours run over midnight and hours without rows count, so both are worked out here, over the
    range. A range without any stored day has no profiles.
    """
    factor = cfg.SAMPLES_PER_HOUR / 60 if scale_rules else 1
    hours = "segment_id string, hour_of_date timestamp, fcd_mean double, max_consecutive_zeros int, max_consecutive_zeros_or_ones int, date date"
    rows = spark.read.schema(hours).parquet(path).filter((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(end))).drop("date")
    at = lambda day: F.lit(day).cast("timestamp")
    hourly = _with_empty_hours(rows, at(start), at(end), cfg.SAMPLES_PER_HOUR)
    masked = profile_from_hourly(hourly, min_weeks, dead_run=int(cfg.DEAD_HOUR_RUN * factor))
    return gated_profile(masked, cfg.USABLE_RUN_Q95 * factor)


def build_profiles(
    obs: DataFrame,
    start: Column,
    end: Column,
    min_weeks: int,
    downsample: bool = True,
    tie: str | None = None,
    scale_rules: bool = False,
) -> DataFrame:
    """All profiles of all segments in one job.

    ``scale_rules`` reads the dead-hour and usability limits as minutes and scales them to the
    five-minute series; by default they are compared literally.
    """
    factor = cfg.SAMPLES_PER_HOUR / 60 if scale_rules else 1
    window = obs.filter((F.col("time") >= start) & (F.col("time") < end))
    slots = downsample_last(window, ["fcd_coverage"], tie=tie) if downsample else window
    hourly = hourly_coverage(slots, start, end)
    masked = profile_from_hourly(hourly, min_weeks, dead_run=int(cfg.DEAD_HOUR_RUN * factor))
    return gated_profile(masked, cfg.USABLE_RUN_Q95 * factor)
