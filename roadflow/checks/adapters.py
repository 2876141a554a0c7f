"""The generated tables read as traffic data, in Spark and as SQL fragments saying the same.

Every fragment is a common table expression; oracles start ``WITH`` a comma list of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.functions import scalars as S
from roadflow.operators import profile as P
from roadflow.operators import series

# Range of the events table, and the fixed "now" of all queries over it and over orders.
START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
ORDERS_AS_OF = "1998-01-15 10:30:00"


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- events as observations ---------------------------------------------------------------

CONFIDENCE_SQL = "100 - event_id % 61"
FCD_SQL = (
    "CAST(CASE WHEN 100 - event_id % 61 <= 70 THEN 0 "
    "ELSE least(10, round_even((30 - event_id % 61) / 3.0, 0)) END AS INTEGER)"
)


def _observations(spark: SparkSession, d: str, segment: Column) -> DataFrame:
    events = table(spark, d, "events")
    confidence = (100 - F.col("event_id") % 61).cast("int")
    return events.select(
        segment.alias("segment_id"),
        F.col("ts").cast("timestamp").alias("time"),
        "event_id",
        confidence.alias("confidence_level"),
        S.confidence_to_fcd(confidence).alias("fcd_coverage"),
        F.col("value").alias("average_speed"),
        F.when(F.col("event_id") % 5 != 0, F.col("value") / 2).alias("current_speed"),
        "event_type",
        "user_id",
    )


def user_obs(spark: SparkSession, d: str) -> DataFrame:
    """Many segments: one per user."""
    return _observations(spark, d, F.concat(F.lit("u"), F.col("user_id").cast("string")))


def type_obs(spark: SparkSession, d: str) -> DataFrame:
    """Few dense segments: one per event type, each with a fifth of all rows."""
    return _observations(spark, d, F.col("event_type"))


def _obs_sql(name: str, segment: str) -> str:
    return f"""{name} AS (
  SELECT {segment} AS segment_id, ts AS time, event_id,
         CAST({CONFIDENCE_SQL} AS INTEGER) AS confidence_level, {FCD_SQL} AS fcd_coverage,
         value AS average_speed,
         CASE WHEN event_id % 5 <> 0 THEN value / 2 END AS current_speed, event_type, user_id
  FROM events)"""


USER_OBS = _obs_sql("obs", "'u' || user_id")
TYPE_OBS = _obs_sql("obs", "event_type")


def duplicate_obs(spark: SparkSession, d: str) -> DataFrame:
    """Observations rounded to the hour, so that keys repeat within and between files."""
    obs = type_obs(spark, d)
    return obs.withColumn("time", F.date_trunc("hour", F.col("time"))).withColumns(
        {
            "source_file": F.format_string("f%09d", F.floor(F.col("event_id") / 2)),
            "position": (F.col("event_id") % 2).cast("int"),
        }
    )


DUPLICATE_OBS = (
    TYPE_OBS
    + """, dup AS (
  SELECT * REPLACE (date_trunc('hour', time) AS time),
         printf('f%09d', event_id // 2) AS source_file, CAST(event_id % 2 AS INTEGER) AS position
  FROM obs)"""
)


# --- five-minute series, hours and profile -------------------------------------------------


def slots(spark: SparkSession, d: str) -> DataFrame:
    return series.downsample_last(type_obs(spark, d), ["fcd_coverage"], tie="event_id")


SLOTS = (
    TYPE_OBS
    + """, slots AS (
  SELECT segment_id, time_bucket(INTERVAL 5 MINUTE, time) AS time,
         arg_max(fcd_coverage, (time, event_id)) AS fcd_coverage
  FROM obs GROUP BY 1, 2)"""
)


def hourly(spark: SparkSession, d: str) -> DataFrame:
    return P.hourly_coverage(slots(spark, d), ts(START), ts(END))


GRID = f"""grid AS (
  SELECT segment_id, unnest(generate_series(TIMESTAMP '{START}',
         TIMESTAMP '{END}' - INTERVAL 5 MINUTE, INTERVAL 5 MINUTE)) AS time
  FROM (SELECT DISTINCT segment_id FROM slots))"""

HOURLY = (
    SLOTS
    + f""", {GRID}, filled AS (
  SELECT segment_id, time, date_trunc('hour', time) AS hour_of_date,
         coalesce(fcd_coverage, 0) AS fcd
  FROM grid LEFT JOIN slots USING (segment_id, time)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY segment_id, hour_of_date ORDER BY time) AS rn,
         row_number() OVER (PARTITION BY segment_id, hour_of_date, fcd = 0 ORDER BY time) AS rz,
         row_number() OVER (PARTITION BY segment_id, hour_of_date, fcd <= 1 ORDER BY time) AS rl
  FROM filled),
zero_runs AS (
  SELECT segment_id, hour_of_date, max(n) AS best FROM (
    SELECT segment_id, hour_of_date, count(*) AS n FROM numbered WHERE fcd = 0
    GROUP BY segment_id, hour_of_date, rn - rz) GROUP BY 1, 2),
low_runs AS (
  SELECT segment_id, hour_of_date, max(n) AS best FROM (
    SELECT segment_id, hour_of_date, count(*) AS n FROM numbered WHERE fcd <= 1
    GROUP BY segment_id, hour_of_date, rn - rl) GROUP BY 1, 2),
hourly AS (
  SELECT m.segment_id, m.hour_of_date, m.fcd_mean,
         CAST(coalesce(z.best, 0) AS INTEGER) AS max_consecutive_zeros,
         CAST(coalesce(l.best, 0) AS INTEGER) AS max_consecutive_zeros_or_ones
  FROM (SELECT segment_id, hour_of_date, sum(fcd) / 12.0::DOUBLE AS fcd_mean
        FROM filled GROUP BY 1, 2) m
  LEFT JOIN zero_runs z USING (segment_id, hour_of_date)
  LEFT JOIN low_runs l USING (segment_id, hour_of_date))"""
)

# Dead hours at five-minute sampling: all twelve windows without cars.
DEAD_RUN = 12
MASKED = (
    HOURLY
    + f""", flagged AS (
  SELECT *, max_consecutive_zeros_or_ones = {DEAD_RUN} AS dead,
         row_number() OVER (PARTITION BY segment_id ORDER BY hour_of_date)
         - row_number() OVER (PARTITION BY segment_id, max_consecutive_zeros_or_ones = {DEAD_RUN}
                              ORDER BY hour_of_date) AS island
  FROM hourly),
masked AS (
  SELECT segment_id, hour_of_date, fcd_mean,
         CASE WHEN NOT gone THEN max_consecutive_zeros END AS max_consecutive_zeros,
         CASE WHEN NOT gone THEN max_consecutive_zeros_or_ones END AS max_consecutive_zeros_or_ones
  FROM (SELECT *, dead AND count(*) OVER (PARTITION BY segment_id, dead, island) >= 5 AS gone
        FROM flagged))"""
)


def week(spark: SparkSession, d: str) -> DataFrame:
    return P.hour_of_week_profile(P.mask_dead_hours(hourly(spark, d), dead_run=DEAD_RUN))


def _q95_sql(values: str) -> str:
    """95th percentile of a sorted list, from the nearer neighbour, to one decimal."""
    n, place = f"len({values})", f"((len({values}) - 1) * 0.95::DOUBLE)"
    a, b = f"{values}[floor({place})::INT + 1]", f"{values}[least(floor({place})::INT + 2, {n})]"
    t = f"({place} - floor({place}))"
    value = f"CASE WHEN {t} >= 0.5 THEN {b} - ({b} - {a}) * (1 - {t}) ELSE {a} + ({b} - {a}) * {t} END"
    return f"round_even(({value}) * 10, 0) / 10"


def week_sql(hours: str) -> str:
    """Hour-of-week profile of the named hourly rows."""
    runs = ("max_consecutive_zeros", "max_consecutive_zeros_or_ones")
    lists = ", ".join(
        f"list_sort(list({c}::DOUBLE) FILTER (WHERE {c} IS NOT NULL)) AS {c}" for c in runs
    )
    q95 = ", ".join(f"{_q95_sql(c)} AS {c}_q95" for c in runs)
    return f"""week AS (
  SELECT segment_id, day_of_week, hour_of_day, fcd_mean_median, {q95}, number_of_hours FROM (
    SELECT segment_id, dayname(hour_of_date) AS day_of_week,
           CAST(hour(hour_of_date) AS INTEGER) AS hour_of_day,
           round_even(median(fcd_mean) * 10, 0) / 10 AS fcd_mean_median, {lists},
           count(fcd_mean) AS number_of_hours
    FROM {hours} GROUP BY 1, 2, 3))"""


WEEK = MASKED + ", " + week_sql("masked")

# Five weekdays occur four times, Monday and Tuesday five times in the 30 days.
MIN_WEEKS = 5


def masked_week(spark: SparkSession, d: str) -> DataFrame:
    return P.mask_low_availability(week(spark, d), MIN_WEEKS)


MASKED_WEEK = (
    WEEK
    + f""", masked_week AS (
  SELECT segment_id, day_of_week, hour_of_day,
         CASE WHEN number_of_hours >= {MIN_WEEKS} THEN fcd_mean_median END AS fcd_mean_median,
         CASE WHEN number_of_hours >= {MIN_WEEKS} THEN max_consecutive_zeros_q95 END
           AS max_consecutive_zeros_q95,
         CASE WHEN number_of_hours >= {MIN_WEEKS} THEN max_consecutive_zeros_or_ones_q95 END
           AS max_consecutive_zeros_or_ones_q95, number_of_hours
  FROM week)"""
)


def profile(spark: SparkSession, d: str) -> DataFrame:
    return P.gated_profile(masked_week(spark, d))


PROFILE = (
    MASKED_WEEK
    + """, gate AS (
  SELECT segment_id, count(*) FILTER (WHERE max_consecutive_zeros_q95 < 35) AS usable_buckets,
         count(*) AS buckets FROM masked_week GROUP BY 1),
profile AS (
  SELECT segment_id, day_of_week, hour_of_day, coalesce(fcd_mean_median, 0) AS fcd_mean_median,
         coalesce(max_consecutive_zeros_q95, 60) AS max_consecutive_zeros_q95,
         coalesce(max_consecutive_zeros_or_ones_q95, 60) AS max_consecutive_zeros_or_ones_q95,
         number_of_hours
  FROM masked_week JOIN gate USING (segment_id) WHERE usable_buckets >= 30)"""
)


def live(spark: SparkSession, d: str) -> DataFrame:
    return slots(spark, d).withColumnRenamed("fcd_coverage", "fcd")


# --- suppliers as segments ------------------------------------------------------------------

# Twenty-five places, three parallel offsets of about 1.5 m: overlaps, near and exact copies.
LINE_SQL = """lines AS (
  SELECT 's' || s_suppkey AS segment_id, s_suppkey, s_nationkey, s_acctbal,
         [{'lon': lon0, 'lat': lat0}, {'lon': lon0 + 0.004e0, 'lat': lat0 + 0.0008e0},
          {'lon': lon0 + 0.008e0, 'lat': lat0}] AS coords
  FROM (SELECT *, 24.9e0 + (s_suppkey % 25 % 5) * 0.012e0 AS lon0,
               60.15e0 + (s_suppkey % 25 // 5) * 0.004e0 + (s_suppkey // 25 % 3) * 0.0000135e0 AS lat0
        FROM (SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier)))"""


def lines(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    place = k % 25
    lon0 = F.lit(24.9) + (place % 5) * F.lit(0.012)
    lat0 = (
        F.lit(60.15)
        + F.floor(place / 5) * F.lit(0.004)
        + (F.floor(k / 25) % 3) * F.lit(0.0000135)
    )
    point = lambda lon, lat: F.struct(lon.alias("lon"), lat.alias("lat"))
    return table(spark, d, "supplier").select(
        F.concat(F.lit("s"), k.cast("string")).alias("segment_id"),
        "s_suppkey",
        "s_nationkey",
        "s_acctbal",
        F.array(
            point(lon0, lat0), point(lon0 + 0.004, lat0 + 0.0008), point(lon0 + 0.008, lat0)
        ).alias("coords"),
    )


# A nation's number says what became of its suppliers' segments between log and fresh map:
# 0-4 removed, 5-9 added, 10-14 geometry changed, the rest unchanged.
def fresh_map(spark: SparkSession, d: str) -> DataFrame:
    moved = F.transform(
        "coords", lambda p: F.struct(p["lon"].alias("lon"), (p["lat"] + 0.001).alias("lat"))
    )
    n = F.col("s_nationkey")
    return (
        lines(spark, d)
        .filter(n >= 5)
        .withColumn("coords", F.when(n.between(10, 14), moved).otherwise(F.col("coords")))
        .select("segment_id", "coords")
    )


FRESH_SQL = """fresh AS (
  SELECT segment_id, CASE WHEN s_nationkey BETWEEN 10 AND 14
         THEN list_transform(coords, lambda p: {'lon': p.lon, 'lat': p.lat + 0.001e0})
         ELSE coords END AS coords
  FROM lines WHERE s_nationkey >= 5)"""

LOG_DATE = "2024-01-01 00:00:00"
CYCLE_DATE = "2024-01-10 00:00:00"


def _records(rows: DataFrame) -> DataFrame:
    version = F.struct(ts("2023-06-01").alias("date_archived"), F.col("coords").alias("coords"))
    return rows.select(
        "segment_id",
        "coords",
        S.geometry_hash(F.col("coords")).alias("current_hash"),
        (ts(LOG_DATE) + F.make_interval(hours=F.col("s_nationkey"))).alias("date_added"),
        F.when(F.col("s_acctbal") < 5000, F.array(version)).otherwise(F.array()).alias("history"),
        F.lit(None).cast("string").alias("geo_inherited_from"),
        F.lit(None).cast("timestamp").alias("timeseries_migrated_at"),
    )


def changelog(spark: SparkSession, d: str) -> DataFrame:
    return _records(lines(spark, d).filter(~F.col("s_nationkey").between(5, 9)))


def archive(spark: SparkSession, d: str) -> DataFrame:
    """An earlier archive: every supplier under an older id, archived at different times."""
    old = lines(spark, d).withColumn("segment_id", F.concat(F.lit("old-"), "segment_id"))
    at = ts(LOG_DATE) + F.make_interval(hours=(F.col("s_suppkey") % 240).cast("int"))
    dated = old.select("segment_id", at.alias("date_archived"))
    return _records(old).join(dated, "segment_id")


HASH_SQL = (
    "sha256(array_to_string(list_transform(coords, "
    "lambda p: printf('%.7f %.7f', p.lon, p.lat)), ','))"
)
LOG_SQL = f"""log AS (
  SELECT segment_id, coords, {HASH_SQL} AS current_hash,
         TIMESTAMP '{LOG_DATE}' + INTERVAL 1 HOUR * s_nationkey AS date_added,
         CASE WHEN s_acctbal < 5000 THEN 1 ELSE 0 END AS n_history
  FROM lines WHERE s_nationkey NOT BETWEEN 5 AND 9)"""
ARCHIVE_SQL = f"""archive AS (
  SELECT 'old-' || segment_id AS segment_id, coords, {HASH_SQL} AS current_hash,
         TIMESTAMP '{LOG_DATE}' + INTERVAL 1 HOUR * (s_suppkey % 240) AS date_archived,
         CASE WHEN s_acctbal < 5000 THEN 1 ELSE 0 END AS n_history
  FROM lines)"""


# --- nations as roadwork areas --------------------------------------------------------------

AREA_SQL = """areas AS (
  SELECT 'n' || n_nationkey AS disturbance_id, n_name, n_nationkey,
         24.9e0 + (n_nationkey % 5) * 0.012e0 + 0.002e0 AS x0,
         24.9e0 + (n_nationkey % 5) * 0.012e0 + 0.003e0 AS x1,
         60.15e0 + (n_nationkey // 5) * 0.004e0 - 0.0002e0 + (n_nationkey % 4) * 0.0003e0 AS y0,
         60.15e0 + (n_nationkey // 5) * 0.004e0 + (n_nationkey % 4) * 0.0003e0 AS y1
  FROM nation)"""


def areas(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    x0 = F.lit(24.9) + (k % 5) * F.lit(0.012) + F.lit(0.002)
    x1 = F.lit(24.9) + (k % 5) * F.lit(0.012) + F.lit(0.003)
    row = F.lit(60.15) + F.floor(k / 5) * F.lit(0.004)
    shift = (k % 4) * F.lit(0.0003)
    y0, y1 = row - F.lit(0.0002) + shift, row + shift
    p = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    ring = F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0))
    return table(spark, d, "nation").select(
        F.concat(F.lit("n"), k.cast("string")).alias("disturbance_id"),
        "n_name",
        "n_nationkey",
        F.array(F.array(ring)).alias("polygons"),
    )


# --- orders as roadwork reports ---------------------------------------------------------------

REPORT_SQL = """reports AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS disturbance_id, 'c' || o_custkey AS segment_id,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'soon'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start_text,
         CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN '2024-02-30'
              ELSE strftime(o_orderdate + INTERVAL 1 DAY * (o_orderkey % 60 - 5), '%Y-%m-%d') END
           AS end_text,
         o_orderpriority AS type, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS address
  FROM orders)"""


def reports(spark: SparkSession, d: str) -> DataFrame:
    """One report per order: start on its date, end -5..54 days later, some texts malformed."""
    day = F.to_date("o_orderdate")
    end = F.date_add(day, (F.col("o_orderkey") % 60 - 5).cast("int"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    bad_start = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    bad_end = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("disturbance_id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("segment_id"),
        F.when(bad_start, "soon").otherwise(text(day)).alias("start_text"),
        F.when(bad_end, "2024-02-30").otherwise(text(end)).alias("end_text"),
        F.col("o_orderpriority").alias("type"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("address"),
    )


VALIDATION_DATE = "1997-12-01 00:00:00"
START_DATE_SQL = "try_strptime(start_text, '%Y-%m-%d')::DATE"
END_DATE_SQL = "try_strptime(end_text, '%Y-%m-%d')::DATE"
CLASSIFIED = (
    REPORT_SQL
    + f""", classified AS (
  SELECT *, CASE WHEN s IS NULL OR e IS NULL THEN 'malformed'
                 WHEN e < DATE '{ORDERS_AS_OF[:10]}' THEN 'ended'
                 WHEN s > e THEN 'inverted'
                 WHEN s > DATE '{ORDERS_AS_OF[:10]}' THEN 'future'
                 WHEN s >= DATE '{VALIDATION_DATE[:10]}' THEN 'current' ELSE 'too_old' END AS verdict
  FROM (SELECT *, {START_DATE_SQL} AS s, {END_DATE_SQL} AS e FROM reports))"""
)
