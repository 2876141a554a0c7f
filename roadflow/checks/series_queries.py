"""Ingest, series access, profile and validation over the events table."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from roadflow.checks import adapters as A
from roadflow.checks.registry import query
from roadflow.functions import scalars as S
from roadflow.operators import observations as O
from roadflow.operators import profile as P
from roadflow.operators import quality as Q
from roadflow.operators import runs, series
from roadflow.operators import validation as V
from roadflow.sources import exports, snapshots, tables
from roadflow.session import shared_dir

# --- P2, P3, H13, H7 ------------------------------------------------------------------------


@query(
    "confidence_to_fcd",
    f"SELECT event_id, CAST({A.CONFIDENCE_SQL} AS INTEGER) AS confidence_level, "
    f"{A.FCD_SQL} AS fcd_coverage FROM events",
)
def confidence_to_fcd(spark, d):
    return A.user_obs(spark, d).select("event_id", "confidence_level", "fcd_coverage")


NAMED = """named AS (
  SELECT event_id, ts, CASE event_id % 10
    WHEN 3 THEN 'feed/plain-' || event_id || '.json'
    WHEN 7 THEN 'feed/2024-13-01T00-00-00.json'
    WHEN 5 THEN 'feed/' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.json'
    ELSE 'feed/' || strftime(ts, '%Y-%m-%dT%H-%M-%S') || '.' || strftime(ts, '%f') || '.json' END
    AS file_name FROM events)"""


def _named(spark, d):
    e = A.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    k = F.col("event_id") % 10
    text = lambda p: F.date_format("ts", p)
    name = (
        F.when(k == 3, F.concat(F.lit("plain-"), "event_id"))
        .when(k == 7, F.lit("2024-13-01T00-00-00"))
        .when(k == 5, text("yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(text("yyyy-MM-dd'T'HH-mm-ss.SSSSSS"))
    )
    return e.withColumn("file_name", F.concat(F.lit("feed/"), name, F.lit(".json")))


@query(
    "time_from_file_name",
    f"""WITH {NAMED} SELECT event_id,
      CASE WHEN event_id % 10 NOT IN (3, 7) THEN date_trunc('second', ts) END AS file_time,
      CASE WHEN event_id % 10 IN (3, 7) THEN NULL
           WHEN event_id % 10 = 5 THEN date_trunc('second', ts) ELSE ts END AS file_time_exact
    FROM named""",
)
def time_from_file_name(spark, d):
    name = F.col("file_name")
    return _named(spark, d).select(
        "event_id",
        S.time_from_file_name(name).alias("file_time"),
        S.time_from_file_name(name, keep_fraction=True).alias("file_time_exact"),
    )


@query(
    "iso_times_and_ids",
    """SELECT CAST(user_id AS VARCHAR) AS segment_id,
         CASE WHEN event_id % 4 < 3 THEN date_trunc('second', ts) END AS time, event_id
       FROM events""",
)
def iso_times_and_ids(spark, d):
    """``Z``, naive and offset texts become UTC; a broken one becomes null; ids become text."""
    e = A.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    k = F.col("event_id") % 4
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    shifted = F.date_format(F.col("ts") + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(k == 0, F.concat(base, F.lit("Z")))
        .when(k == 1, base)
        .when(k == 2, F.concat(shifted, F.lit("+02:00")))
        .otherwise(F.concat(F.lit("x"), base))
    )
    return e.select(
        S.as_id(F.col("user_id")).alias("segment_id"), S.iso_to_timestamp(text).alias("time"), "event_id"
    )


@query(
    "nan_to_null",
    "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events",
)
def nan_to_null(spark, d):
    e = A.table(spark, d, "events")
    noisy = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return e.select("event_id", S.nan_to_null(noisy).alias("value"))


# --- S1, S2, S3, P1, A14, P5, D7 --------------------------------------------------------------


def _documents(spark, d):
    """One snapshot document per event: three entries, some documents broken in known ways."""
    e = A.user_obs(spark, d)
    k = F.col("event_id")
    body = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.col("segment_id").alias("segmentIdStr"),
                    F.col("confidence_level").alias("confidence"),
                    F.col("average_speed").alias("averageSpeed"),
                    F.col("current_speed").alias("currentSpeed"),
                    F.array(
                        F.struct(F.lit(24.9).alias("longitude"), F.lit(60.1).alias("latitude")),
                        F.struct(
                            F.lit(25.0).alias("longitude"),
                            F.when(k % 3 == 0, F.lit(60.2)).alias("latitude"),
                        ),
                    ).alias("shape"),
                    F.lit(None).cast("bigint").alias("segmentId"),
                ),
                F.struct(
                    F.lit(None).cast("string").alias("segmentIdStr"),
                    F.lit(None).cast("int").alias("confidence"),
                    F.col("average_speed").alias("averageSpeed"),
                    F.lit(None).cast("double").alias("currentSpeed"),
                    F.lit(None)
                    .cast("array<struct<longitude:double,latitude:double>>")
                    .alias("shape"),
                    F.when(k % 4 != 0, F.col("user_id")).alias("segmentId"),
                ),
            ).alias("detailedSegments")
        )
    )
    document = (
        F.when(k % 97 == 0, F.substring(body, 1, 40))
        .when(k % 89 == 0, F.lit('{"detailedSegments": {"a": 1}}'))
        .when(k % 83 == 0, F.lit('{"other": []}'))
        .otherwise(body)
    )
    stamp = F.when(k % 79 == 0, F.lit("unstamped")).otherwise(
        F.date_format("time", "yyyy-MM-dd'T'HH-mm-ss")
    )
    name = F.concat(stamp, F.lit("_"), F.lpad(k.cast("string"), 9, "0"), F.lit(".json"))
    return e.select(name.alias("file_name"), document.alias("document"))


DOCS = (
    A.USER_OBS
    + """, docs AS (
  SELECT *, CASE WHEN event_id % 79 = 0 THEN 'unstamped' ELSE strftime(time, '%Y-%m-%dT%H-%M-%S') END
            || '_' || lpad(CAST(event_id AS VARCHAR), 9, '0') || '.json' AS file_name,
         CASE WHEN event_id % 97 = 0 THEN 'malformed_json'
              WHEN event_id % 79 = 0 THEN 'no_timestamp'
              WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'segments_not_a_list' END AS reason
  FROM obs),
entries AS (
  SELECT segment_id, date_trunc('second', time) AS time, fcd_coverage, average_speed, current_speed,
         confidence_level, file_name AS source_file, 0 AS position,
         CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS n_points
  FROM docs WHERE reason IS NULL
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), date_trunc('second', time), NULL, average_speed, NULL, NULL,
         file_name, 1, 0
  FROM docs WHERE reason IS NULL AND event_id % 4 <> 0)"""
)


@query(
    "snapshots_to_obs",
    f"""WITH {DOCS} SELECT segment_id, time, CAST(fcd_coverage AS INTEGER) AS fcd_coverage,
      average_speed, current_speed, CAST(confidence_level AS INTEGER) AS confidence_level,
      source_file, position, n_points FROM entries""",
)
def snapshots_to_obs(spark, d):
    good, _ = snapshots.split_good(snapshots.parse_snapshot_text(_documents(spark, d)))
    return O.snapshots_to_obs(good).select(
        "segment_id",
        "time",
        "fcd_coverage",
        "average_speed",
        "current_speed",
        "confidence_level",
        "source_file",
        "position",
        F.size("coords").alias("n_points"),
    )


@query(
    "ingest_report",
    f"""WITH {DOCS} SELECT coalesce(reason, 'ok') AS status, count(*) AS files,
      CAST(sum(CASE WHEN reason IS NULL OR reason = 'no_timestamp' AND event_id % 89 <> 0
                         AND event_id % 83 <> 0 THEN 2 ELSE 0 END) AS BIGINT) AS entries
    FROM docs GROUP BY 1""",
)
def ingest_report(spark, d):
    return O.ingest_report(snapshots.parse_snapshot_text(_documents(spark, d)))


@query(
    "unusable_files",
    f"WITH {DOCS} SELECT file_name, reason FROM docs WHERE reason IS NOT NULL",
)
def unusable_files(spark, d):
    _, bad = snapshots.split_good(snapshots.parse_snapshot_text(_documents(spark, d)))
    return bad.select("file_name", "reason")


@query(
    "segment_geometries",
    f"""WITH {DOCS} SELECT segment_id, CAST(arg_min(n_points, (source_file, -position)) AS INTEGER)
      AS n_points FROM entries GROUP BY 1""",
)
def segment_geometries(spark, d):
    good, _ = snapshots.split_good(snapshots.parse_snapshot_text(_documents(spark, d)))
    lines = O.segment_geometries(O.snapshots_to_obs(good))
    return lines.select("segment_id", F.size("coords").alias("n_points"))


# Documents landed as JSON lines, one folder per day; the folder's name is the snapshot time.
LANDED = (
    A.USER_OBS
    + """, landed AS (
  SELECT segment_id, date_trunc('day', time) AS time, event_id, fcd_coverage FROM obs
  WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), date_trunc('day', time), event_id, NULL FROM obs
  WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AND event_id % 4 <> 0)"""
)


def land_documents(spark, d):
    folder = shared_dir(spark, "landing")
    documents = _documents(spark, d)
    event = F.regexp_extract("file_name", r"_(\d+)", 1).cast("bigint")
    times = A.user_obs(spark, d).select("event_id", F.date_format("time", "yyyy-MM-dd'T'00-00-00").alias("day"))
    (
        documents.withColumn("event_id", event)
        .join(times, "event_id")
        .select(F.col("document").alias("value"), "day")
        .repartition("day")
        .write.partitionBy("day")
        .text(folder)
    )
    return folder


@query(
    "read_fcd_snapshots",
    f"""WITH {LANDED} SELECT segment_id, time, count(*) AS entries,
      CAST(sum(fcd_coverage) AS BIGINT) AS coverage FROM landed GROUP BY 1, 2""",
)
def read_fcd_snapshots(spark, d):
    """Documents written to landing folders and read back from the files."""
    files = snapshots.read_fcd_snapshots(spark, land_documents(spark, d), one_per_file=False)
    good, _ = snapshots.split_good(files)
    return O.snapshots_to_obs(good).groupBy("segment_id", "time").agg(
        F.count("*").alias("entries"), F.sum("fcd_coverage").alias("coverage")
    )


def _listing(spark, d):
    e = A.type_obs(spark, d)
    folder = F.concat(F.lit("/landing/"), "event_type")
    return e.select(
        F.concat(folder, F.lit("/"), F.date_format("time", "yyyy-MM-dd'T'HH-mm-ss"), F.lit("_"),
                 F.col("event_id").cast("string")).alias("file_path"),
        F.date_trunc("second", F.col("time")).alias("file_time"),
        F.to_date("time").alias("dt"),
        # Arrival order differs from name order.
        (F.col("time") + F.make_interval(mins=(F.col("event_id") % 600).cast("int"))).alias("modified_at"),
    )


LISTING = """listing AS (
  SELECT '/landing/' || event_type AS folder,
         '/landing/' || event_type || '/' || strftime(ts, '%Y-%m-%dT%H-%M-%S') || '_' || event_id AS file_path,
         date_trunc('second', ts) AS file_time,
         ts + INTERVAL 1 MINUTE * (event_id % 600) AS modified_at
  FROM events)"""


@query(
    "files_in_range",
    f"""WITH {LISTING} SELECT file_path, file_time FROM listing
      WHERE file_time BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00'""",
)
def files_in_range(spark, d):
    files = snapshots.files_in_range(
        _listing(spark, d), datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 18, 30)
    )
    return files.select("file_path", "file_time")


@query(
    "read_fcd_snapshots_in_range",
    f"""WITH {LANDED} SELECT segment_id, time, count(*) AS entries FROM landed
      WHERE time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 18:30:00' GROUP BY 1, 2""",
)
def read_fcd_snapshots_in_range(spark, d):
    """A range of the landed folders: other days are not listed."""
    files = snapshots.read_fcd_snapshots(
        spark, land_documents(spark, d), datetime(2024, 1, 5), datetime(2024, 1, 20, 18, 30), one_per_file=False
    )
    good, _ = snapshots.split_good(files)
    return O.snapshots_to_obs(good).groupBy("segment_id", "time").agg(F.count("*").alias("entries"))


@query(
    "first_and_latest_file",
    f"""WITH {LISTING} SELECT folder, arg_min(file_path, (modified_at, file_path)) AS first_file,
      arg_max(file_path, (modified_at, file_path)) AS latest_file, count(*) AS files
    FROM listing GROUP BY 1""",
)
def first_and_latest_file(spark, d):
    return snapshots.first_and_latest_file(_listing(spark, d))


# --- A9, P4, H19 --------------------------------------------------------------------------------


@query(
    "obs_first_wins",
    f"""WITH {A.DUPLICATE_OBS} SELECT segment_id, time, fcd_coverage, source_file, position FROM (
      SELECT *, row_number() OVER (PARTITION BY segment_id, time ORDER BY source_file, position DESC) AS rn
      FROM dup) WHERE rn = 1""",
)
def obs_first_wins(spark, d):
    return O.merge_observations(A.duplicate_obs(spark, d)).select(
        "segment_id", "time", "fcd_coverage", "source_file", "position"
    )


@query(
    "merge_report",
    f"""WITH {A.DUPLICATE_OBS} SELECT count(*) AS records_scanned,
      count(DISTINCT (segment_id, time)) AS records_new FROM dup""",
)
def merge_report(spark, d):
    return O.merge_report(A.duplicate_obs(spark, d))


def _series_documents(spark, d):
    """One nested document per event: entry, line and dated properties, broken in known ways."""
    e = A.user_obs(spark, d)
    k = F.col("event_id")
    stamp = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss")
    key = F.when(k % 11 == 0, F.concat(F.lit("x"), "user_id")).otherwise(F.col("user_id").cast("string"))
    kind = F.when(k % 13 == 0, F.lit("Point")).otherwise(F.lit("LineString"))
    points = F.when(k % 17 == 0, F.lit("[[24,60.5]]")).otherwise(F.lit("[[24.9,60.1],[24.91,60.1]]"))
    date = F.when(k % 19 == 0, F.lit("[]")).otherwise(
        F.concat(F.lit('{"'), stamp, F.lit('":{"properties":{"fcd_coverage":'), "fcd_coverage", F.lit("}}}"))
    )
    text = F.concat(
        F.lit('{"segmentId":{"'), key, F.lit('":{"geometry":{"type":"'), kind,
        F.lit('","coordinates":'), points, F.lit('},"detailedSegment":{"date":'), date, F.lit("}}}}"),
    )
    return e.select(F.col("event_id").cast("string").alias("source_file"), text.alias("document"))


RULE_SQL = """CASE WHEN event_id % 11 = 0 THEN 'id_not_digits' WHEN event_id % 13 = 0 THEN 'not_a_line'
  WHEN event_id % 17 = 0 THEN 'bad_coordinates' WHEN event_id % 19 = 0 THEN 'date_not_object' END"""


@query(
    "document_violations",
    f"""SELECT CAST(event_id AS VARCHAR) AS source_file, {RULE_SQL} AS rule FROM events
      WHERE {RULE_SQL} IS NOT NULL""",
)
def document_violations(spark, d):
    return O.document_violations(_series_documents(spark, d)).select("source_file", "rule")


@query(
    "valid_obs_documents",
    f"SELECT CAST(event_id AS VARCHAR) AS source_file FROM events WHERE {RULE_SQL} IS NULL",
)
def valid_obs_documents(spark, d):
    return O.valid_obs_documents(_series_documents(spark, d)).select("source_file")


@query(
    "rows_from_document",
    f"""SELECT CAST(event_id AS VARCHAR) AS source_file, CAST(user_id AS VARCHAR) AS segment_id,
      date_trunc('second', ts) AS time, CAST({A.FCD_SQL} AS VARCHAR) AS fcd_coverage
    FROM events WHERE {RULE_SQL} IS NULL""",
)
def rows_from_document(spark, d):
    good = O.valid_obs_documents(_series_documents(spark, d))
    return O.rows_from_document(good).select(
        "source_file", "segment_id", "time", F.col("properties")["fcd_coverage"].alias("fcd_coverage")
    )


@query(
    "document_from_rows",
    f"""WITH {A.SLOTS} SELECT segment_id, CAST(time AS DATE) AS day, count(*) AS points,
      CAST(sum(fcd_coverage) AS BIGINT) AS fcd_total FROM slots GROUP BY 1, 2""",
)
def document_from_rows(spark, d):
    """Rows to nested documents and read again: as many points, the same total."""
    nulls = {c: F.lit(None).cast("double") for c in ("average_speed", "typical_speed", "current_speed")}
    obs = A.slots(spark, d).withColumns({**nulls, "confidence_level": F.lit(None).cast("int")})
    entry = F.from_json(
        "entry",
        "detailedSegment struct<date: map<string, struct<properties: struct<fcd_coverage: bigint>>>>",
    )
    values = F.transform(
        F.map_values(entry["detailedSegment"]["date"]), lambda v: v["properties"]["fcd_coverage"]
    )
    return O.document_from_rows(obs).select(
        "segment_id",
        "day",
        F.size(values).cast("bigint").alias("points"),
        F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("fcd_total"),
    )


# --- P8-P11, A5-A7, A12, O1, O3, H1-H4, H8, H14 -----------------------------------------------


@query(
    "series_slice",
    f"""WITH {A.TYPE_OBS} SELECT segment_id, time, fcd_coverage, average_speed FROM obs
      WHERE segment_id IN ('click', 'view') AND time >= TIMESTAMP '2024-01-03 00:00:00'
        AND time < TIMESTAMP '2024-01-24 12:00:00'""",
)
def series_slice(spark, d):
    return series.series_slice(
        A.type_obs(spark, d),
        ["click", "view"],
        datetime(2024, 1, 3),
        datetime(2024, 1, 24, 12),
        ["fcd_coverage", "average_speed"],
    )


@query(
    "target_segments",
    f"""WITH {A.USER_OBS} SELECT segment_id, time, event_id FROM obs
      WHERE segment_id IN (SELECT 'u' || c_custkey FROM customer WHERE c_acctbal > 4000)""",
)
def target_segments(spark, d):
    wanted = A.table(spark, d, "customer").filter("c_acctbal > 4000")
    wanted = wanted.select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("segment_id"))
    return series.target_segments(A.user_obs(spark, d), wanted).select("segment_id", "time", "event_id")


DOWN_FIELDS = ["fcd_coverage", "average_speed", "current_speed"]


def _downsample_sql(bucket: str) -> str:
    return f"""WITH {A.TYPE_OBS} SELECT segment_id, {bucket} AS time,
      arg_max(fcd_coverage, (time, event_id)) AS fcd_coverage,
      arg_max(average_speed, (time, event_id)) AS average_speed,
      arg_max(current_speed, (time, event_id)) FILTER (WHERE current_speed IS NOT NULL) AS current_speed
    FROM obs GROUP BY 1, 2"""


@query("downsample_last", _downsample_sql("time_bucket(INTERVAL 5 MINUTE, time)"))
def downsample_last(spark, d):
    return series.downsample_last(A.type_obs(spark, d), DOWN_FIELDS, tie="event_id")


@query(
    "downsample_last_end_label",
    _downsample_sql("time_bucket(INTERVAL 60 MINUTE, time) + INTERVAL 60 MINUTE"),
)
def downsample_last_end_label(spark, d):
    return series.downsample_last(A.type_obs(spark, d), DOWN_FIELDS, 60, "end", tie="event_id")


@query(
    "fields_pivot",
    f"""WITH {A.TYPE_OBS} SELECT segment_id, date_trunc('minute', time) AS time,
      max(average_speed) AS average_speed, max(current_speed) AS current_speed,
      CAST(max(fcd_coverage) AS DOUBLE) AS fcd_coverage FROM obs GROUP BY 1, 2""",
)
def fields_pivot(spark, d):
    """Wide rows to points and back to columns."""
    rows = A.type_obs(spark, d).withColumn("time", F.date_trunc("minute", F.col("time")))
    return series.fields_to_columns(series.columns_to_fields(rows, DOWN_FIELDS), DOWN_FIELDS)


@query(
    "first_last_seen",
    f"""WITH {A.USER_OBS} SELECT segment_id, min(time) AS first_time,
      max(time) FILTER (WHERE time >= TIMESTAMP '{A.END}' - INTERVAL 3 DAY) AS last_time
    FROM obs GROUP BY 1""",
)
def first_last_seen(spark, d):
    return series.first_last_seen(A.user_obs(spark, d), A.ts(A.END), days=3)


@query(
    "first_last_overall",
    "SELECT min(ts) AS first_time, max(ts) AS last_time FROM events",
)
def first_last_overall(spark, d):
    return series.first_last_overall(A.user_obs(spark, d))


@query(
    "latest_point",
    f"""WITH {A.USER_OBS} SELECT segment_id, max(time) AS time,
      arg_max(fcd_coverage, (time, event_id)) AS fcd_coverage, arg_max(event_id, (time, event_id)) AS event_id
    FROM obs GROUP BY 1""",
)
def latest_point(spark, d):
    return series.latest_point(A.user_obs(spark, d), ["fcd_coverage", "event_id"], tie="event_id")


@query(
    "latest_point_overall",
    f"""WITH {A.USER_OBS} SELECT segment_id, time, fcd_coverage FROM obs
      WHERE time >= TIMESTAMP '{A.END}' - INTERVAL 30 DAY ORDER BY time DESC, event_id DESC LIMIT 1""",
)
def latest_point_overall(spark, d):
    return series.latest_point(
        A.user_obs(spark, d), ["fcd_coverage"], A.ts(A.END), 30, "event_id", per_segment=False
    )


@query(
    "count_points",
    f"""WITH {A.USER_OBS} SELECT segment_id, count(*) AS points, 'fcd' AS measurement
      FROM obs GROUP BY 1""",
)
def count_points(spark, d):
    return series.count_points(A.user_obs(spark, d), "fcd")


@query("sort_series", f"WITH {A.USER_OBS} SELECT segment_id, time, event_id FROM obs ORDER BY 1, 2")
def sort_series(spark, d):
    return O.sort_series(A.user_obs(spark, d)).select("segment_id", "time", "event_id")


@query(
    "dense_grid",
    f"""WITH {A.SLOTS}, grid AS (
      SELECT segment_id, unnest(generate_series(TIMESTAMP '{A.START}', TIMESTAMP '{A.END}',
             INTERVAL 5 MINUTE)) AS time FROM (SELECT DISTINCT segment_id FROM slots))
    SELECT segment_id, time, fcd_coverage, CAST(coalesce(fcd_coverage, 0) AS SMALLINT) AS fcd,
      dayname(time) AS day_of_week, CAST(isodow(time) - 1 AS INTEGER) AS day_index,
      CAST(hour(time) AS INTEGER) AS hour_of_day, date_trunc('hour', time) AS hour_of_date
    FROM grid LEFT JOIN slots USING (segment_id, time)""",
)
def dense_grid(spark, d):
    """Grid with zero fill and calendar columns."""
    time = F.col("time")
    grid = series.dense_grid(A.slots(spark, d), A.ts(A.START), A.ts(A.END), ["fcd_coverage"])
    return grid.select(
        "segment_id",
        "time",
        "fcd_coverage",
        S.zero_fill(F.col("fcd_coverage")).alias("fcd"),
        S.day_name(time).alias("day_of_week"),
        S.day_index(time).alias("day_index"),
        S.hour_of_day(time).alias("hour_of_day"),
        S.floor_hour(time).alias("hour_of_date"),
    )


@query(
    "eligible_segments",
    f"""WITH {A.USER_OBS} SELECT segment_id, min(time) AS first_time FROM obs GROUP BY 1
      HAVING min(time) + INTERVAL 28 DAY <= TIMESTAMP '2024-01-29 12:00:00'""",
)
def eligible_segments(spark, d):
    seen = series.first_last_seen(A.user_obs(spark, d))
    return series.eligible_segments(seen, A.ts("2024-01-29 12:00:00")).select("segment_id", "first_time")


@query(
    "period_violations",
    """SELECT min(ts) AS first_time, max(ts) AS last_time, unnest(['data_before_start', 'data_after_end'])
      AS rule FROM events""",
)
def period_violations(spark, d):
    return series.period_violations(
        A.user_obs(spark, d), datetime(2024, 1, 2), datetime(2024, 1, 30)
    )


@query(
    "day_chunks",
    """WITH span AS (SELECT event_type AS segment_id, date_trunc('day', min(ts)) AS s,
      date_trunc('day', max(ts)) + INTERVAL 1 DAY AS e FROM events GROUP BY 1)
    SELECT segment_id, c AS chunk_start, least(c + INTERVAL 7 DAY, e) AS chunk_end
    FROM (SELECT *, unnest(generate_series(s, e, INTERVAL 7 DAY)) AS c FROM span) WHERE c < e""",
)
def day_chunks(spark, d):
    time = F.col("time")
    ranges = A.type_obs(spark, d).groupBy("segment_id").agg(
        F.date_trunc("day", F.min(time)).alias("start"),
        (F.date_trunc("day", F.max(time)) + F.expr("interval 1 day")).alias("end"),
    )
    return series.day_chunks(ranges, 7).select("segment_id", "chunk_start", "chunk_end")


# --- A3 over raw rows: keys are large, so runs are counted in chunks --------------------------

RAW_RUNS = (
    A.TYPE_OBS
    + """, n AS (
  SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY time, event_id) AS rn FROM obs),
c AS (
  SELECT *, rn - max(CASE WHEN fcd_coverage = 0 THEN 0 ELSE rn END) OVER w AS zeros,
            rn - max(CASE WHEN fcd_coverage <= 1 THEN 0 ELSE rn END) OVER w AS low
  FROM n WINDOW w AS (PARTITION BY segment_id ORDER BY rn ROWS UNBOUNDED PRECEDING))"""
)


def _raw_conditions():
    return {"zeros": F.col("fcd_coverage") == 0, "low": F.col("fcd_coverage") <= 1}


def _day():
    return F.date_trunc("day", F.col("time"))


@query(
    "longest_true_run",
    f"WITH {RAW_RUNS} SELECT segment_id, max(zeros) AS zeros, max(low) AS low FROM c GROUP BY 1",
)
def longest_true_run(spark, d):
    obs = A.type_obs(spark, d).select("segment_id", "time", "event_id", "fcd_coverage")
    return runs.longest_true_run(obs, ["segment_id"], ["time", "event_id"], _raw_conditions(), _day())


@query("chunked_streaks", f"WITH {RAW_RUNS} SELECT segment_id, event_id, zeros, low FROM c")
def chunked_streaks(spark, d):
    obs = A.type_obs(spark, d).select("segment_id", "time", "event_id", "fcd_coverage")
    counted = runs.streaks(obs, ["segment_id"], ["time", "event_id"], _raw_conditions(), _day())
    return counted.select("segment_id", "event_id", "zeros", "low")


# --- A1, A2, A4, A10, W1, H5, H6, H15, S12 -----------------------------------------------------


def _round(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "hourly_coverage",
    f"""WITH {A.HOURLY} SELECT segment_id, hour_of_date, round(fcd_mean, 6) AS fcd_mean,
      max_consecutive_zeros, max_consecutive_zeros_or_ones FROM hourly""",
)
def hourly_coverage(spark, d):
    return _round(A.hourly(spark, d), "fcd_mean")


@query(
    "hourly_in_chunks",
    f"""WITH {A.HOURLY} SELECT segment_id, hour_of_date, round(fcd_mean, 6) AS fcd_mean,
      max_consecutive_zeros, max_consecutive_zeros_or_ones FROM hourly""",
)
def hourly_in_chunks(spark, d):
    """Hours of half-open chunks put together are the hours of the whole range."""
    slots = A.slots(spark, d)
    cuts = [A.START, "2024-01-08 00:00:00", "2024-01-22 00:00:00", A.END]
    parts = [P.hourly_coverage(slots, A.ts(a), A.ts(b)) for a, b in zip(cuts, cuts[1:])]
    return _round(series.concat_parts(parts), "fcd_mean")


@query(
    "hourly_coverage_of_rows",
    f"""WITH {A.SLOTS}, n AS (
      SELECT *, date_trunc('hour', time) AS h,
        row_number() OVER (PARTITION BY segment_id, date_trunc('hour', time) ORDER BY time) AS rn,
        row_number() OVER (PARTITION BY segment_id, date_trunc('hour', time), fcd_coverage = 0 ORDER BY time) AS rz
      FROM slots),
    r AS (SELECT segment_id, h, max(n) AS best FROM (
      SELECT segment_id, h, count(*) AS n FROM n WHERE fcd_coverage = 0 GROUP BY segment_id, h, rn - rz) GROUP BY 1, 2)
    SELECT n.segment_id, n.h AS hour_of_date, round(avg(fcd_coverage), 6) AS fcd_mean,
      CAST(coalesce(max(best), 0) AS INTEGER) AS max_consecutive_zeros
    FROM n LEFT JOIN r USING (segment_id, h) GROUP BY 1, 2""",
)
def hourly_coverage_of_rows(spark, d):
    """Without filling: means and runs over the rows there are."""
    hours = P.hourly_coverage(A.slots(spark, d), fill=False).drop("max_consecutive_zeros_or_ones")
    return _round(hours, "fcd_mean")


@query(
    "mask_dead_hours",
    f"""WITH {A.MASKED} SELECT segment_id, hour_of_date, round(fcd_mean, 6) AS fcd_mean,
      max_consecutive_zeros, max_consecutive_zeros_or_ones FROM masked""",
)
def mask_dead_hours(spark, d):
    return _round(P.mask_dead_hours(A.hourly(spark, d), dead_run=A.DEAD_RUN), "fcd_mean")


PROFILE_COLUMNS = """segment_id, day_of_week, hour_of_day, fcd_mean_median, max_consecutive_zeros_q95,
  max_consecutive_zeros_or_ones_q95, number_of_hours"""


@query("hour_of_week_profile", f"WITH {A.WEEK} SELECT {PROFILE_COLUMNS} FROM week")
def hour_of_week_profile(spark, d):
    return A.week(spark, d)


@query("mask_low_availability", f"WITH {A.MASKED_WEEK} SELECT {PROFILE_COLUMNS} FROM masked_week")
def mask_low_availability(spark, d):
    return A.masked_week(spark, d)


@query(
    "profile_quality_gate",
    f"""WITH {A.PROFILE} SELECT segment_id, usable_buckets, buckets, usable_buckets >= 30 AS accepted,
      CASE WHEN usable_buckets < 30 THEN 'too_few_usable_buckets' END AS reason FROM gate""",
)
def profile_quality_gate(spark, d):
    return P.profile_quality_gate(A.masked_week(spark, d))


@query("segment_profile", f"WITH {A.PROFILE} SELECT {PROFILE_COLUMNS} FROM profile")
def segment_profile(spark, d):
    return A.profile(spark, d)


# Users' profiles with literal limits: the dead-hour rule never fires at five minutes.
USER_PROFILE = A.HOURLY.replace(A.TYPE_OBS, A.USER_OBS) + ", " + A.week_sql("hourly")


@query("build_profiles", f"WITH {USER_PROFILE} SELECT {PROFILE_COLUMNS} FROM week")
def build_profiles(spark, d):
    return P.build_profiles(
        A.user_obs(spark, d), A.ts(A.START), A.ts(A.END), min_weeks=1, tie="event_id"
    )


@query("rolling_profiles", f"WITH {USER_PROFILE} SELECT {PROFILE_COLUMNS} FROM week")
def rolling_profiles(spark, d):
    """The same profiles from hours stored by day, the past days in one pass, the newest one as it comes in."""
    path, obs = shared_dir(spark, "hours"), A.user_obs(spark, d)
    start, end = date.fromisoformat(A.START[:10]), date.fromisoformat(A.END[:10])
    newest = end - timedelta(days=1)
    P.store_hours(obs, path, start, tie="event_id", until=newest)
    P.store_hours(obs, path, newest, tie="event_id")
    return P.rolling_profiles(spark, path, start, end, min_weeks=1)


STORED = (
    A.PROFILE
    + """, stored AS (
  SELECT segment_id, day_of_week, hour_of_day, fcd_mean_median,
         CASE WHEN segment_id IN ('click', 'view') THEN TIMESTAMP '2024-01-20 00:00:00'
              ELSE TIMESTAMP '2024-01-28 00:00:00' END AS computed_at FROM profile)"""
)


def _stored_profiles(spark, d):
    computed = F.when(F.col("segment_id").isin("click", "view"), A.ts("2024-01-20")).otherwise(
        A.ts("2024-01-28")
    )
    return P.with_lifetime(A.profile(spark, d), computed)


@query(
    "drop_expired",
    f"""WITH {STORED} SELECT segment_id, count(*) AS buckets,
      min(computed_at) + INTERVAL 7 DAY AS expires_at FROM stored
    WHERE computed_at + INTERVAL 7 DAY >= TIMESTAMP '{A.END}' GROUP BY 1""",
)
def drop_expired(spark, d):
    kept = P.drop_expired(_stored_profiles(spark, d), A.ts(A.END))
    return kept.groupBy("segment_id").agg(
        F.count("*").alias("buckets"), F.min("expires_at").alias("expires_at")
    )


@query(
    "expired_count",
    f"""WITH {STORED} SELECT count(DISTINCT segment_id) AS expired FROM stored
      WHERE computed_at + INTERVAL 7 DAY < TIMESTAMP '{A.END}'""",
)
def expired_count(spark, d):
    return P.expired_count(_stored_profiles(spark, d), A.ts(A.END))


@query(
    "upsert_profiles",
    f"""WITH {STORED} SELECT segment_id, day_of_week, hour_of_day,
      fcd_mean_median + CASE WHEN segment_id IN ('click', 'purchase') THEN 1 ELSE 0 END AS fcd_mean_median,
      CASE WHEN segment_id IN ('click', 'purchase') THEN TIMESTAMP '2024-01-30 00:00:00' ELSE computed_at END
        AS computed_at FROM stored""",
)
def upsert_profiles(spark, d):
    stored = _stored_profiles(spark, d)
    new = (
        stored.filter(F.col("segment_id").isin("click", "purchase"))
        .withColumn("fcd_mean_median", F.col("fcd_mean_median") + 1)
        .drop("computed_at", "expires_at")
    )
    both = P.upsert_profiles(stored, P.with_lifetime(new, A.ts("2024-01-30")))
    return both.select("segment_id", "day_of_week", "hour_of_day", "fcd_mean_median", "computed_at")


@query(
    "delete_profiles",
    f"""WITH {STORED} SELECT segment_id, day_of_week, hour_of_day FROM stored
      WHERE segment_id NOT IN (SELECT event_type FROM events WHERE value > 490)""",
)
def delete_profiles(spark, d):
    gone = A.type_obs(spark, d).filter("average_speed > 490").select("segment_id").distinct()
    return P.delete_profiles(_stored_profiles(spark, d), gone).select(
        "segment_id", "day_of_week", "hour_of_day"
    )


def _bucketed_profiles(spark, d):
    """A profile table of its own name each time, so that queries do not disturb each other."""
    path = shared_dir(spark, "bucketed")
    return P.store_profiles(A.profile(spark, d), "profiles_" + path.rsplit("-", 1)[1], path)


@query(
    "read_profile",
    f"""WITH {A.PROFILE} SELECT segment_id, day_of_week, hour_of_day, fcd_mean_median FROM profile
      WHERE segment_id IN (SELECT min(event_type) FROM events UNION ALL SELECT max(event_type) FROM events)""",
)
def read_profile(spark, d):
    """Two segments' profiles from the bucketed store."""
    ids = A.type_obs(spark, d).agg(F.min("segment_id"), F.max("segment_id")).first()
    stored = P.read_profile(_bucketed_profiles(spark, d), list(ids))
    return stored.select("segment_id", "day_of_week", "hour_of_day", "fcd_mean_median")


@query("profile_ids", f"WITH {STORED} SELECT DISTINCT segment_id FROM stored ORDER BY 1")
def profile_ids(spark, d):
    return P.profile_ids(_stored_profiles(spark, d))


# --- W2-W7, J8, J9, T6, D6 ----------------------------------------------------------------------

COUNTED = (
    A.PROFILE
    + """, numbered_live AS (
  SELECT segment_id, time, fcd_coverage AS fcd,
         row_number() OVER (PARTITION BY segment_id ORDER BY time) AS rn FROM slots),
counted AS (
  SELECT segment_id, time, fcd, rn,
         CAST(rn - max(CASE WHEN fcd = 0 THEN 0 ELSE rn END) OVER w AS INTEGER) AS consecutive_zeros,
         CAST(rn - max(CASE WHEN fcd <= 1 THEN 0 ELSE rn END) OVER w AS INTEGER) AS consecutive_low
  FROM numbered_live WINDOW w AS (PARTITION BY segment_id ORDER BY rn ROWS UNBOUNDED PRECEDING)),
matched AS (
  SELECT c.*, dayname(c.time) AS day_of_week, CAST(hour(c.time) AS INTEGER) AS hour_of_day,
         p.fcd_mean_median, p.max_consecutive_zeros_q95, p.max_consecutive_zeros_or_ones_q95
  FROM counted c LEFT JOIN profile p ON p.segment_id = c.segment_id
   AND p.day_of_week = dayname(c.time) AND p.hour_of_day = hour(c.time)),
lagged AS (
  SELECT *, coalesce(fcd_mean_median < 3, false) AS by_zeros,
         lag(consecutive_zeros) OVER w AS pz, lag(consecutive_low) OVER w AS pl,
         lag(max_consecutive_zeros_q95) OVER w AS q0, lag(max_consecutive_zeros_or_ones_q95) OVER w AS q1
  FROM matched WINDOW w AS (PARTITION BY segment_id ORDER BY rn)),
limits AS (
  SELECT *, CASE WHEN by_zeros THEN consecutive_zeros ELSE consecutive_low END AS run,
         coalesce(CASE WHEN by_zeros THEN pz ELSE pl END, 0) AS previous_run,
         coalesce(greatest(CASE WHEN by_zeros THEN q0 ELSE q1 END,
                           CASE WHEN (CASE WHEN by_zeros THEN q0 ELSE q1 END) IS NOT NULL THEN 5 END), 60)
           AS threshold FROM lagged)"""
)
MATCHED_COLUMNS = """segment_id, time, fcd, consecutive_zeros, consecutive_low, day_of_week, hour_of_day,
  fcd_mean_median, max_consecutive_zeros_q95, max_consecutive_zeros_or_ones_q95"""


@query(
    "zero_run_counters",
    f"WITH {COUNTED} SELECT segment_id, time, fcd, consecutive_zeros, consecutive_low FROM counted",
)
def zero_run_counters(spark, d):
    return V.zero_run_counters(A.live(spark, d))


def _matched(spark, d):
    return V.zero_run_counters(V.match_profile(A.live(spark, d), A.profile(spark, d)))


@query("match_profile", f"WITH {COUNTED} SELECT {MATCHED_COLUMNS} FROM matched")
def match_profile(spark, d):
    return _matched(spark, d)


@query("match_profile_bucketed", f"WITH {COUNTED} SELECT {MATCHED_COLUMNS} FROM matched")
def match_profile_bucketed(spark, d):
    """The profiles are read in buckets and not shuffled for the join."""
    return V.zero_run_counters(V.match_profile(A.live(spark, d), _bucketed_profiles(spark, d)))


@query(
    "lag_thresholds",
    f"""WITH {COUNTED} SELECT segment_id, time, run, CAST(previous_run AS INTEGER) AS previous_run,
      CAST(threshold AS DOUBLE) AS threshold FROM limits""",
)
def lag_thresholds(spark, d):
    rows = V.lag_thresholds(V.attach_previous(_matched(spark, d), None))
    return rows.select("segment_id", "time", "run", "previous_run", "threshold")


WALK = (
    COUNTED.replace(A.TYPE_OBS, "RECURSIVE_MARK" + A.TYPE_OBS).replace("RECURSIVE_MARK", "RECURSIVE ")
    + """, gated AS (
  SELECT *, 0.5 * greatest(coalesce(q1, 5), 5) AS span,
         rn > 1 AND fcd < 6 AND coalesce(fcd_mean_median - fcd <= 8, false) AS gate FROM limits),
walk AS (
  SELECT segment_id, rn, 0.5::DOUBLE AS mean, 0.025::DOUBLE AS k FROM gated WHERE rn = 1
  UNION ALL
  SELECT segment_id, rn, CASE WHEN gate
           THEN base * exp(-next_k * greatest(0, (span - consecutive_low) / span)) ELSE base END, next_k
  FROM (SELECT g.*,
    CASE WHEN g.threshold > 54 AND g.run > g.threshold THEN w.mean
         WHEN g.run = 0 AND g.previous_run < g.threshold
           THEN (g.threshold * w.mean + g.fcd * (g.previous_run / (2 * g.threshold))) / (g.threshold + g.fcd)
         WHEN g.run <> 0
           THEN (g.threshold * w.mean + greatest(1, (g.run / (2 * g.threshold)) ** 2)
                 * greatest(w.mean, least(1, g.run / (2 * g.threshold))))
                / (g.threshold + greatest(1, (g.run / (2 * g.threshold)) ** 2))
         WHEN g.fcd_mean_median - g.fcd > 8 THEN (5 * w.mean + 10) / 15
         WHEN g.fcd > 6 THEN 5 * w.mean / (5 + g.fcd) ELSE w.mean END AS base,
    CASE WHEN NOT g.gate THEN w.k WHEN g.fcd = 0 THEN 0.025
         WHEN g.consecutive_low = 0 AND g.pl <= g.span THEN least(10, 2 * w.k) ELSE w.k END AS next_k
    FROM walk w JOIN gated g ON g.segment_id = w.segment_id AND g.rn = w.rn + 1)),
status AS (
  SELECT g.*, w.mean AS running_mean, w.k,
         CASE WHEN w.mean < 0.15 THEN 'open' WHEN w.mean > 0.75 THEN 'closed' ELSE 'undetermined' END
           AS segment_closure_status
  FROM gated g JOIN walk w USING (segment_id, rn))"""
)


@query(
    "closure_status",
    f"""WITH {WALK} SELECT {MATCHED_COLUMNS}, round(running_mean, 6) AS running_mean,
      segment_closure_status FROM status""",
)
def closure_status(spark, d):
    return _round(V.validate(A.live(spark, d), A.profile(spark, d)), "running_mean")


@query(
    "closure_status_in_parts",
    f"""WITH {WALK} SELECT {MATCHED_COLUMNS}, round(running_mean, 6) AS running_mean,
      segment_closure_status FROM status""",
)
def closure_status_in_parts(spark, d):
    """The recurrence of each segment cut into days that different tasks work on."""
    day = F.unix_date(F.to_date("time"))
    return _round(V.validate(A.live(spark, d), A.profile(spark, d), chunk=day), "running_mean")


@query("momentum", f"WITH {WALK} SELECT segment_id, time, round(k, 6) AS k FROM status")
def momentum(spark, d):
    rows = V.closure_running_mean(_matched(spark, d))
    return _round(rows.select("segment_id", "time", "k"), "k")


CURRENT_STATUS = f"""WITH {WALK} SELECT segment_id, max(time) AS time,
  round(arg_max(running_mean, rn), 6) AS running_mean,
  arg_max(segment_closure_status, rn) AS segment_closure_status FROM status GROUP BY 1"""


@query("current_status", CURRENT_STATUS)
def current_status(spark, d):
    return _round(V.current_status(V.validate(A.live(spark, d), A.profile(spark, d))), "running_mean")


@query(
    "attach_previous",
    f"""WITH {COUNTED}, last AS (
      SELECT segment_id, arg_max(consecutive_low, rn) AS previous_low FROM matched
      WHERE time < TIMESTAMP '2024-01-22 00:00:00' GROUP BY 1)
    SELECT segment_id, time, previous_low, 'continues' AS part FROM matched LEFT JOIN last USING (segment_id)
    WHERE time >= TIMESTAMP '2024-01-22 00:00:00'
      OR segment_id NOT IN (SELECT segment_id FROM last)
    UNION ALL SELECT segment_id, time, NULL, 'replayed' FROM matched WHERE time < TIMESTAMP '2024-01-22 00:00:00'""",
)
def attach_previous(spark, d):
    rows = _matched(spark, d)
    stored = rows.filter(F.col("time") < A.ts("2024-01-22")).withColumn("running_mean", F.lit(0.5))
    """Rows after the stored state continue from it, those up to it are listed for repair."""
    continued = V.attach_previous(rows, stored).select(
        "segment_id", "time", F.col("_stored.consecutive_low").alias("previous_low"), F.lit("continues").alias("part")
    )
    old = V.replayed_rows(rows, stored).select(
        "segment_id", "time", F.lit(None).cast("int").alias("previous_low"), F.lit("replayed").alias("part")
    )
    return continued.unionByName(old)


@query(
    "coverage_rejects",
    "SELECT CAST(event_id AS VARCHAR) AS row_key, 'fcd_out_of_range' AS reason FROM events "
    "WHERE event_id % 23 - 5 NOT BETWEEN 0 AND 10",
)
def coverage_rejects(spark, d):
    rows = A.user_obs(spark, d).withColumn("fcd", (F.col("event_id") % 23 - 5).cast("int"))
    return V.coverage_rejects(rows).select(F.col("event_id").cast("string").alias("row_key"), "reason")


@query(
    "validation_recent",
    f"""WITH {A.SLOTS} SELECT count(*) AS recent_rows, count(*) > 0 AS recent FROM slots
      WHERE time >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR""",
)
def validation_recent(spark, d):
    return Q.validation_recent(A.slots(spark, d), A.ts("2024-01-30 12:00:00"))


@query(
    "rejects",
    f"""WITH {DOCS} SELECT 'read' AS stage, file_name AS row_key, reason FROM docs WHERE reason IS NOT NULL
    UNION ALL SELECT 'coverage', CAST(event_id AS VARCHAR), 'fcd_out_of_range' FROM events
      WHERE event_id % 23 - 5 NOT BETWEEN 0 AND 10
    UNION ALL SELECT 'document', CAST(event_id AS VARCHAR), {RULE_SQL} FROM events WHERE {RULE_SQL} IS NOT NULL""",
)
def rejects(spark, d):
    _, bad = snapshots.split_good(snapshots.parse_snapshot_text(_documents(spark, d)))
    rows = A.user_obs(spark, d).withColumn("fcd", (F.col("event_id") % 23 - 5).cast("int"))
    return Q.rejects(
        {
            "read": bad.withColumn("row_key", F.col("file_name")),
            "coverage": V.coverage_rejects(rows).withColumn("row_key", F.col("event_id")),
            "document": O.document_violations(_series_documents(spark, d)).select(
                F.col("source_file").alias("row_key"), F.col("rule").alias("reason")
            ),
        }
    )


# --- D1, D2, D5, U4 ------------------------------------------------------------------------------


@query(
    "series_freshness",
    f"""WITH {A.USER_OBS}, last AS (
      SELECT segment_id, max(time) AS last_time,
             date_diff('microsecond', max(time), TIMESTAMP '{A.END}') / 6e7 AS age FROM obs GROUP BY 1)
    SELECT segment_id, CASE WHEN age <= 2880 THEN last_time END AS last_time,
      CASE WHEN age <= 360 THEN 'real_time' WHEN age <= 2880 THEN 'backfill' ELSE 'no_data' END AS mode,
      CASE WHEN age <= 2880 THEN round(age, 6) END AS age_minutes FROM last""",
)
def series_freshness(spark, d):
    fresh = Q.series_freshness(A.user_obs(spark, d), A.ts(A.END), 360, 2, ["segment_id"])
    return _round(fresh, "age_minutes")


@query(
    "series_freshness_of_table",
    f"""SELECT max(ts) AS last_time, 'backfill' AS mode,
      round(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-02 00:00:00') / 6e7, 6) AS age_minutes
    FROM events""",
)
def series_freshness_of_table(spark, d):
    return _round(Q.series_freshness(A.user_obs(spark, d), A.ts("2024-02-02"), 30), "age_minutes")


@query(
    "freshness_from_newest_days",
    f"""SELECT segment_id, CASE WHEN age <= 10080 THEN last_time END AS last_time,
      CASE WHEN age <= 30 THEN 'real_time' WHEN age <= 10080 THEN 'backfill' ELSE 'no_data' END AS mode,
      CASE WHEN age <= 10080 THEN round(age, 6) END AS age_minutes
    FROM (SELECT 'u' || user_id AS segment_id, max(ts) AS last_time,
      date_diff('microsecond', max(ts), TIMESTAMP '{A.END}') / 6e7 AS age FROM events GROUP BY 1)""",
)
def freshness_from_newest_days(spark, d):
    """Freshness of every segment of a stored series; days are read backwards until all have an answer."""
    path, obs = shared_dir(spark, "series"), A.user_obs(spark, d).select("segment_id", "time", "average_speed")
    tables.write_series(obs, path, ["average_speed"])
    return _round(Q.freshness_of_table(spark, path, obs, A.ts(A.END), 30), "age_minutes")


@query(
    "age_grade",
    f"""SELECT event_id, CASE WHEN age < 90 THEN 'healthy' WHEN age < 180 THEN 'degraded' ELSE 'unhealthy' END
      AS grade FROM (SELECT event_id, date_diff('microsecond', ts, TIMESTAMP '{A.END}') / 6e7 AS age FROM events)""",
)
def age_grade(spark, d):
    age = S.minutes_between(A.ts(A.END), F.col("time"))
    return A.user_obs(spark, d).select("event_id", S.age_grade(age).alias("grade"))


@query(
    "min_rows",
    """SELECT table_name, n AS rows, CAST(minimum AS BIGINT) AS minimum, n >= minimum AS enough FROM (
      SELECT 'events' AS table_name, count(*) AS n, 1 AS minimum FROM events
      UNION ALL SELECT 'orders', count(*), 1000000000 FROM orders
      UNION ALL SELECT 'lineitem', count(*), 0 FROM lineitem)""",
)
def min_rows(spark, d):
    names = ["events", "orders", "lineitem"]
    return Q.min_rows({n: A.table(spark, d, n) for n in names}, {"events": 1, "orders": 10**9})


@query(
    "same_rows",
    f"""WITH {A.TYPE_OBS}, a AS (SELECT DISTINCT event_id, segment_id, round(average_speed, 3) AS v FROM obs),
    b AS (SELECT DISTINCT event_id, segment_id,
      round(average_speed + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0.0000001 END, 3) AS v FROM obs)
    SELECT *, 'a' AS only_in FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
    UNION ALL SELECT *, 'b' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def same_rows(spark, d):
    a = A.type_obs(spark, d).select("event_id", "segment_id", F.col("average_speed").alias("v"))
    shift = F.when(F.col("event_id") % 50 == 0, F.lit(1.0)).otherwise(F.lit(0.0000001))
    return Q.same_rows(a, a.withColumn("v", F.col("v") + shift), ["event_id", "segment_id"])


@query(
    "same_rows_of_tables",
    f"""WITH {A.SLOTS}, changed AS (
      SELECT segment_id, time, fcd_coverage + CASE WHEN time >= TIMESTAMP '2024-01-10 03:00:00'
        AND time < TIMESTAMP '2024-01-10 05:00:00' THEN 1 ELSE 0 END AS fcd_coverage FROM slots)
    SELECT *, 'a' AS only_in FROM (SELECT * FROM slots EXCEPT ALL SELECT * FROM changed)
    UNION ALL SELECT *, 'b' FROM (SELECT * FROM changed EXCEPT ALL SELECT * FROM slots)""",
)
def same_rows_of_tables(spark, d):
    """Two stored series that differ on one day; only its parts are read for the comparison."""
    slots = A.slots(spark, d).select("segment_id", "time", "fcd_coverage")
    shifted = F.col("time").between(A.ts("2024-01-10 03:00:00"), A.ts("2024-01-10 04:59:59"))
    changed = slots.withColumn("fcd_coverage", F.col("fcd_coverage") + F.when(shifted, 1).otherwise(0))
    one, two = shared_dir(spark, "series"), shared_dir(spark, "series")
    tables.write_series(slots, one, ["fcd_coverage"])
    tables.write_series(changed, two, ["fcd_coverage"])
    return Q.same_rows_of_tables(spark, one, two)


@query(
    "compare_counts",
    f"""WITH {A.TYPE_OBS}, a AS (SELECT event_id, segment_id, round(average_speed, 3) AS v FROM obs),
    b AS (SELECT event_id, segment_id,
      round(average_speed + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0.0000001 END, 3) AS v FROM obs),
    n AS (SELECT (SELECT count(*) FROM a) AS rows_a, (SELECT count(*) FROM b) AS rows_b,
      (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_a,
      (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS only_b)
    SELECT *, only_a = 0 AND only_b = 0 AS equal FROM n""",
)
def compare_counts(spark, d):
    a = A.type_obs(spark, d).select("event_id", "segment_id", F.col("average_speed").alias("v"))
    shift = F.when(F.col("event_id") % 50 == 0, F.lit(1.0)).otherwise(F.lit(0.0000001))
    return Q.compare_counts(a, a.withColumn("v", F.col("v") + shift), ["event_id", "segment_id"])


# --- S6, S7, S15, S16: written and read back ---------------------------------------------------


@query(
    "write_fcd_obs",
    f"""WITH {A.TYPE_OBS} SELECT segment_id, time_bucket(INTERVAL 60 MINUTE, time) AS time,
      arg_max(fcd_coverage, (time, event_id)) AS fcd_coverage FROM obs GROUP BY 1, 2""",
)
def write_fcd_obs(spark, d):
    """Two upserts into the keyed series table: the second, later half of each hour wins."""
    path = shared_dir(spark, "series")
    obs = A.type_obs(spark, d)
    half = F.minute("time") < 30
    for part in (obs.filter(half), obs.filter(~half)):
        rows = series.downsample_last(part, ["fcd_coverage"], 60, tie="event_id")
        whole = rows.withColumns({c: F.lit(None).cast("double") for c in ("average_speed", "typical_speed", "current_speed")})
        whole = whole.withColumns({"confidence_level": F.lit(None).cast("int"), "source_file": F.lit("f"), "position": F.lit(0)})
        tables.write_fcd_obs(whole, path)
    return tables.read_series(spark, path).select("segment_id", "time", "fcd_coverage")


@query(
    "write_validation",
    f"""WITH {WALK} SELECT segment_id, time, round(running_mean, 6) AS running_mean, segment_closure_status
      FROM status""",
)
def write_validation(spark, d):
    path = shared_dir(spark, "validation")
    tables.write_validation(V.validate(A.live(spark, d), A.profile(spark, d)), path)
    rows = tables.read_series(spark, path)
    return _round(rows, "running_mean").select(
        "segment_id", "time", "running_mean", "segment_closure_status"
    )


@query(
    "series_to_csv",
    f"""WITH {A.SLOTS} SELECT segment_id, strftime(time, '%Y-%m-%dT%H:%M:%S.000Z') AS time,
      CAST(fcd_coverage AS VARCHAR) AS fcd_coverage FROM slots
    WHERE segment_id IN ('click', 'error') AND time >= TIMESTAMP '2024-01-02 00:00:00'""",
)
def series_to_csv(spark, d):
    path = shared_dir(spark, "csv")
    rows = exports.series_to_csv_rows(
        A.type_obs(spark, d), ["click", "error"], ["fcd_coverage"], datetime(2024, 1, 2), None, 5, "event_id"
    )
    exports.write_csv(rows, path)
    return spark.read.option("sep", ";").option("header", True).csv(path)
