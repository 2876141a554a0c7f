"""Disturbances, geometry and lineage over orders, nations, suppliers and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadflow.checks import adapters as A
from roadflow.checks.registry import query
from roadflow.functions import geometry as G
from roadflow.functions import scalars as S
from roadflow.operators import disturbances as D
from roadflow.operators import lineage as L
from roadflow.operators import observations as O
from roadflow.operators import quality as Q
from roadflow.operators import series, spatial
from roadflow.plans import jobs
from roadflow.session import shared_dir
from roadflow.sources import disturbance_files as DF
from roadflow.sources import exports, tables

AS_OF = A.ORDERS_AS_OF
TODAY = f"TIMESTAMP '{AS_OF}'"

# --- P7, P13, A8, H9, H10, J10, J13 ------------------------------------------------------------


def _classified(spark, d):
    return D.classify_disturbances(A.reports(spark, d), A.ts(A.VALIDATION_DATE), A.ts(AS_OF))


@query(
    "classify_disturbances",
    f"""WITH {A.CLASSIFIED} SELECT disturbance_id, s AS start_date, e AS end_date, verdict
      FROM classified""",
)
def classify_disturbances(spark, d):
    return _classified(spark, d).select("disturbance_id", "start_date", "end_date", "verdict")


@query(
    "valid_disturbances",
    f"""WITH {A.CLASSIFIED} SELECT disturbance_id, segment_id, verdict FROM classified
      WHERE verdict IN ('future', 'current')""",
)
def valid_disturbances(spark, d):
    return D.valid_disturbances(_classified(spark, d)).select("disturbance_id", "segment_id", "verdict")


@query(
    "validation_totals",
    f"""WITH {A.CLASSIFIED} SELECT
      count(*) FILTER (WHERE verdict NOT IN ('future', 'current')) AS invalid,
      count(*) FILTER (WHERE verdict = 'current') AS valid_now,
      count(*) FILTER (WHERE verdict = 'future') AS valid_in_future,
      count(*) FILTER (WHERE verdict IN ('future', 'current')) AS kept FROM classified""",
)
def validation_totals(spark, d):
    return D.validation_totals(_classified(spark, d))


ENVELOPE = (
    A.REPORT_SQL
    + f""", envelope AS (
  SELECT segment_id,
    CASE WHEN bs IS DISTINCT FROM false THEN {TODAY} ELSE s END AS disturbance_start,
    CASE WHEN be IS DISTINCT FROM false THEN {TODAY} ELSE e END AS disturbance_end
  FROM (SELECT 'c' || c_custkey AS segment_id FROM customer) LEFT JOIN (
    SELECT segment_id, min(s)::TIMESTAMP AS s, max(e)::TIMESTAMP AS e, bool_or(s IS NULL) AS bs,
           bool_or(s IS NULL OR e IS NULL) AS be
    FROM (SELECT segment_id, {A.START_DATE_SQL} AS s, {A.END_DATE_SQL} AS e FROM reports) GROUP BY 1)
  USING (segment_id))"""
)


def _envelope(spark, d):
    customers = A.table(spark, d, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("segment_id")
    )
    return D.disturbance_envelope(A.reports(spark, d), A.ts(AS_OF), customers)


@query("disturbance_envelope", f"WITH {ENVELOPE} SELECT * FROM envelope")
def disturbance_envelope(spark, d):
    return _envelope(spark, d)


WINDOWS = (
    ENVELOPE
    + f""", windows AS (
  SELECT *, profiling_end - INTERVAL 28 DAY AS profiling_start,
    CASE WHEN profiling_end::DATE < {TODAY}::DATE
         THEN greatest(profiling_end + INTERVAL 1 DAY, {TODAY} - INTERVAL 28 DAY)
         ELSE {TODAY} - INTERVAL 5 MINUTE END AS validation_start
  FROM (SELECT *, CASE WHEN disturbance_start - INTERVAL 48 HOUR < date_trunc('day', {TODAY}) - INTERVAL 48 HOUR
      THEN disturbance_start - INTERVAL 48 HOUR ELSE date_trunc('day', {TODAY}) END::TIMESTAMP AS profiling_end
    FROM envelope))"""
)


@query("profiling_windows", f"WITH {WINDOWS} SELECT * FROM windows")
def profiling_windows(spark, d):
    return D.profiling_windows(_envelope(spark, d), A.ts(AS_OF))


@query(
    "due_for_validation",
    f"WITH {WINDOWS} SELECT segment_id FROM windows WHERE profiling_end::DATE <= DATE '1997-06-30'",
)
def due_for_validation(spark, d):
    windows = D.profiling_windows(_envelope(spark, d), A.ts(AS_OF))
    return series.due_for_validation(windows, A.ts("1997-06-30 08:00:00")).select("segment_id")


@query(
    "plan_segments",
    f"""WITH {A.CLASSIFIED}, a AS (SELECT DISTINCT segment_id FROM classified WHERE verdict = 'current'),
      n AS (SELECT DISTINCT segment_id FROM classified WHERE verdict = 'future')
    SELECT coalesce(a.segment_id, n.segment_id) AS segment_id,
      CASE WHEN n.segment_id IS NULL THEN 'deactivate' WHEN a.segment_id IS NULL THEN 'create'
           ELSE 'update' END AS action
    FROM a FULL JOIN n ON a.segment_id = n.segment_id""",
)
def plan_segments(spark, d):
    c = _classified(spark, d)
    active = c.filter("verdict = 'current'")
    current = c.filter("verdict = 'future'").select("segment_id").distinct()
    return D.plan_segments(active, current).select("segment_id", "action")


@query(
    "refresh_plan",
    f"""WITH {ENVELOPE}, renewed AS (
      SELECT segment_id, disturbance_start + INTERVAL 1 DAY * (k % 3 // 2) AS ns,
             disturbance_end + INTERVAL 1 DAY * (k % 3 % 2) AS ne, disturbance_start, disturbance_end
      FROM (SELECT *, CAST(substr(segment_id, 2) AS BIGINT) AS k FROM envelope))
    SELECT segment_id, CASE WHEN ns::DATE <> disturbance_start::DATE THEN 'reprofile'
      WHEN ne::DATE <> disturbance_end::DATE THEN 'extend' ELSE 'keep' END AS action FROM renewed""",
)
def refresh_plan(spark, d):
    old = _envelope(spark, d)
    k = F.substring("segment_id", 2, 18).cast("bigint") % 3
    day = lambda n: F.make_interval(days=n.cast("int"))
    new = old.withColumn("disturbance_start", F.col("disturbance_start") + day(F.floor(k / 2)))
    new = new.withColumn("disturbance_end", F.col("disturbance_end") + day(k % 2))
    return D.refresh_plan(old, new).select("segment_id", "action")


# --- S4, S5, P6, U1 -----------------------------------------------------------------------------


def _features(spark, d):
    """One GeoJSON document per order; the order status names the layer, some are broken."""
    r = A.table(spark, d, "orders")
    k = F.col("o_orderkey")
    kind = F.when(k % 7 == 0, F.lit("MultiPolygon")).when(k % 7 == 1, F.lit("Point")).otherwise(F.lit("Polygon"))
    ring = "[[24.9,60.1],[24.91,60.1],[24.91,60.11],[24.9,60.1]]"
    coordinates = (
        F.when(k % 7 == 0, F.lit(f"[[{ring}],[{ring}]]"))
        .when(k % 7 == 1, F.lit("[24.9,60.1]"))
        .otherwise(F.lit(f"[{ring}]"))
    )
    geometry = F.when(k % 11 == 0, F.lit("null")).otherwise(
        F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coordinates, F.lit("}"))
    )
    text = F.concat(
        F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","id":"f'), k,
        F.lit('","properties":{"id":'), k, F.lit(',"hakemus":"'), F.col("o_orderpriority"),
        F.lit('","tyo_alkaa":"'), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit('"},"geometry":'), geometry, F.lit("}]}"),
    )
    document = F.when(k % 13 == 0, F.lit('{"features": [')).when(k % 17 == 0, F.lit('{"features": []}')).otherwise(text)
    return r.select(F.concat(F.lit("layer_"), "o_orderstatus").alias("layer"), document.alias("document"))


FEATURES = """features AS (
  SELECT 'layer_' || o_orderstatus AS layer, CAST(o_orderkey AS VARCHAR) AS disturbance_id,
         o_orderpriority AS type, strftime(o_orderdate, '%Y-%m-%d') AS start_text,
         CASE WHEN o_orderkey % 7 = 0 THEN 2 WHEN o_orderkey % 7 = 1 THEN NULL ELSE 1 END AS polygons,
         CASE WHEN o_orderkey % 11 = 0 THEN 'no_geometry' WHEN o_orderkey % 7 = 1 THEN 'bad_geometry' END AS reason
  FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0)"""


def _reports_from_layers(spark, d):
    documents = _features(spark, d)
    # One layer at a time, united again, as separately landed layers are.
    parts = [documents.filter(F.col("layer") == f"layer_{s}") for s in ("F", "O", "P")]
    layers = DF.union_layers(DF.union_layers(parts[0], parts[1]), parts[2])
    return DF.features_to_disturbances(DF.parse_layer_text(layers))


@query(
    "valid_features",
    f"""WITH {FEATURES} SELECT layer, disturbance_id, type, start_text, CAST(polygons AS INTEGER) AS polygons
      FROM features WHERE reason IS NULL""",
)
def valid_features(spark, d):
    good = DF.valid_features(_reports_from_layers(spark, d))
    return good.select("layer", "disturbance_id", "type", "start_text", F.size("polygons").alias("polygons"))


@query(
    "feature_rejects",
    f"WITH {FEATURES} SELECT disturbance_id, reason FROM features WHERE reason IS NOT NULL",
)
def feature_rejects(spark, d):
    bad = _reports_from_layers(spark, d).filter("reason is not null")
    return bad.select("disturbance_id", "reason")


@query(
    "network_rejects",
    f"""WITH {FEATURES}, {A.CLASSIFIED}
    SELECT 'feature' AS stage, disturbance_id AS row_key, reason FROM features WHERE reason IS NOT NULL
    UNION ALL SELECT 'report', disturbance_id, verdict FROM classified WHERE verdict NOT IN ('future', 'current')""",
)
def network_rejects(spark, d):
    """What the feature reader and the date rules turn away, in one list."""
    features = _reports_from_layers(spark, d).filter("reason is not null")
    parts = {"feature": features, "report": D.report_rejects(_classified(spark, d))}
    return Q.rejects({k: v.withColumn("row_key", F.col("disturbance_id")) for k, v in parts.items()})


@query(
    "read_disturbances",
    f"""WITH {FEATURES} SELECT layer, count(*) AS reports, CAST(sum(polygons) AS BIGINT) AS polygons
      FROM features WHERE reason IS NULL GROUP BY 1""",
)
def read_disturbances(spark, d):
    """Layers written as files of JSON lines and read back per layer."""
    folder = shared_dir(spark, "layers")
    _features(spark, d).select("layer", F.col("document").alias("value")).write.partitionBy("layer").text(folder)
    names = [f"layer_{s}" for s in ("F", "O", "P")]
    reports = DF.read_disturbances(spark, {n: f"{folder}/layer={n}" for n in names}, one_per_file=False)
    return DF.valid_features(reports).groupBy("layer").agg(
        F.count("*").alias("reports"), F.sum(F.size("polygons")).alias("polygons")
    )


@query(
    "latest_good_snapshot",
    """WITH f AS (SELECT event_type AS layer, date_trunc('hour', ts) AS fetched_at,
        value > 5 AS good, event_id FROM events),
      y AS (SELECT * FROM f WHERE good AND fetched_at <= TIMESTAMP '2024-01-30 12:00:00'
        AND fetched_at > TIMESTAMP '2024-01-29 12:00:00')
    SELECT layer, fetched_at, event_id FROM y
    WHERE (layer, fetched_at) IN (SELECT (layer, max(fetched_at)) FROM y GROUP BY layer)""",
)
def latest_good_snapshot(spark, d):
    fetches = A.type_obs(spark, d).select(
        F.col("event_type").alias("layer"),
        F.date_trunc("hour", F.col("time")).alias("fetched_at"),
        (F.col("average_speed") > 5).alias("good"),
        "event_id",
    )
    return DF.latest_good_snapshot(fetches, A.ts("2024-01-30 12:00:00")).select(
        "layer", "fetched_at", "event_id"
    )


# --- P12, H11, S8, D3, S13, S14 -----------------------------------------------------------------


@query(
    "segment_map",
    f"""WITH {A.LINE_SQL} SELECT segment_id, {A.HASH_SQL} AS geometry_hash,
      round(list_min(list_transform(coords, lambda p: p.lon)), 7) AS min_x,
      round(list_max(list_transform(coords, lambda p: p.lon)), 7) AS max_x,
      round(list_min(list_transform(coords, lambda p: p.lat)), 7) AS min_y,
      round(list_max(list_transform(coords, lambda p: p.lat)), 7) AS max_y FROM lines""",
)
def segment_map(spark, d):
    rows = O.segment_map(A.lines(spark, d), A.ts(A.START))
    box = [F.round(f"bbox.{c}", 7).alias(c) for c in ("min_x", "max_x", "min_y", "max_y")]
    return rows.select("segment_id", "geometry_hash", *box)


@query(
    "geometry_bbox",
    """SELECT o_orderkey, 24.9 AS min_x, CASE o_orderkey % 4 WHEN 0 THEN 24.9 ELSE 24.9 + (o_orderkey % 4) END AS max_x,
      60.1::DOUBLE - o_orderkey % 4 AS min_y, 60.1::DOUBLE AS max_y FROM orders""".replace("24.9", "24.5::DOUBLE"),
)
def geometry_bbox(spark, d):
    """Boxes of points, lines, multi-lines and polygons given as GeoJSON."""
    k = F.col("o_orderkey") % 4
    x = (k + F.lit(24.5)).cast("string")
    kind = F.element_at(F.array(*map(F.lit, ("Point", "LineString", "MultiLineString", "Polygon"))), (k + 1).cast("int"))
    pair = F.concat(F.lit("[24.5,60.1],["), x, F.lit(","), (F.lit(60.1) - k).cast("string"), F.lit("]"))
    text = (
        F.when(k == 0, F.lit("[24.5,60.1]"))
        .when(k == 1, F.concat(F.lit("["), pair, F.lit("]")))
        .otherwise(F.concat(F.lit("[["), pair, F.lit(",[24.5,60.1]],[[24.6,60.1],[24.7,60.1]]]")))
    )
    box = S.bbox(S.geojson_points(kind, text))
    return A.table(spark, d, "orders").select(
        "o_orderkey", *[box[c].alias(c) for c in ("min_x", "max_x", "min_y", "max_y")]
    )


@query(
    "save_segment_map",
    f"WITH {A.LINE_SQL}, {A.FRESH_SQL} SELECT segment_id, {A.HASH_SQL} AS geometry_hash FROM fresh",
)
def save_segment_map(spark, d):
    """The map saved, then replaced by a result that is computed from the saved one."""
    path = shared_dir(spark, "map")
    tables.save_table(O.segment_map(A.lines(spark, d), A.ts(A.START)), path)
    kept = tables.load_table(spark, path).select("segment_id")
    tables.save_table(
        O.segment_map(A.fresh_map(spark, d).join(kept, "segment_id"), A.ts(A.END)), path
    )
    return tables.load_table(spark, path).select("segment_id", "geometry_hash")


@query(
    "map_integrity",
    f"""WITH {A.LINE_SQL}, {A.LOG_SQL} SELECT count(*) AS segments,
      count(*) FILTER (WHERE s_acctbal < 0) AS without_geometry,
      CASE WHEN count(*) FILTER (WHERE s_acctbal < 0) > 0 THEN 'missing_geometry' ELSE 'ok' END AS verdict,
      (SELECT count(*) FROM log) AS history_entries FROM lines""",
)
def map_integrity(spark, d):
    segments = A.lines(spark, d).withColumn("coords", F.when(F.col("s_acctbal") >= 0, F.col("coords")))
    return Q.map_integrity(segments, A.changelog(spark, d))


@query(
    "export_map_json",
    f"""WITH {A.LINE_SQL} SELECT segment_id, 'LineString' AS kind, 3::INTEGER AS points,
      round(coords[1].lat, 7) AS first_lat FROM lines""",
)
def export_map_json(spark, d):
    """Map-form lines written as text, read back and taken apart."""
    path = shared_dir(spark, "map-json")
    exports.write_lines(exports.map_entries(A.lines(spark, d)), path)
    entry = "segmentId map<string, struct<geometry: struct<type: string, coordinates: array<array<double>>>>>"
    rows = spark.read.text(path).select(F.explode(F.from_json("value", entry)["segmentId"]))
    g = F.col("value.geometry")
    return rows.select(
        F.col("key").alias("segment_id"),
        g["type"].alias("kind"),
        F.size(g["coordinates"]).alias("points"),
        F.round(g["coordinates"][0][1], 7).alias("first_lat"),
    )


@query(
    "export_geojson",
    f"""WITH {A.LINE_SQL} SELECT segment_id, 'Feature' AS type, round(coords[3].lon, 7) AS last_lon,
      false AS has_crs FROM lines""",
)
def export_geojson(spark, d):
    feature = """type string, crs string, properties struct<segment_id: string>,
        geometry struct<coordinates: array<array<double>>>"""
    rows = exports.segment_features(A.lines(spark, d)).select(F.from_json("value", feature).alias("f"))
    return rows.select(
        F.col("f.properties.segment_id").alias("segment_id"),
        F.col("f.type").alias("type"),
        F.round(F.col("f.geometry.coordinates")[2][0], 7).alias("last_lon"),
        F.col("f.crs").isNotNull().alias("has_crs"),
    )


@query(
    "export_feature_collection",
    f"""WITH {A.LINE_SQL}, k AS (SELECT segment_id, min(segment_id) OVER () AS a, max(segment_id) OVER () AS z FROM lines)
    SELECT segment_id, segment_id = a AS opens, segment_id = z AS closes FROM k""",
)
def export_feature_collection(spark, d):
    """One document in many part files: exactly one line opens it and one closes it."""
    lines = exports.feature_collection(exports.segment_features(A.lines(spark, d)), ["segment_id"])
    value = F.col("value")
    return lines.select(
        F.regexp_extract("value", r'"segment_id":"([^"]*)"', 1).alias("segment_id"),
        value.startswith('{"type":"FeatureCollection"').alias("opens"),
        value.endswith("]}").alias("closes"),
    )


# --- H12, J1-J4, A13, H17, S11, D4, J11, A11 ---------------------------------------------------


def _metric_sql(lon: str, lat: str) -> tuple[str, str]:
    """Easting and northing as SQL, from the conformal latitude."""
    n, radius, alpha = G._krueger()
    e = 2 * n**0.5 / (1 + n)
    sin = f"sin(radians({lat}))"
    t = f"sinh(atanh({sin}) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * {sin}))"
    lam = f"radians({lon} - 25)"
    xi = f"atan2({t}, cos({lam}))"
    eta = f"atanh(sin({lam}) / sqrt(1 + ({t}) ** 2))"
    north, east = [xi], [eta]
    for j, a in enumerate(alpha, 1):
        north.append(f"{a!r}::DOUBLE * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})")
        east.append(f"{a!r}::DOUBLE * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})")
    r = f"{radius!r}::DOUBLE"
    return f"25500000 + {r} * ({' + '.join(east)})", f"{r} * ({' + '.join(north)})"


X_SQL, Y_SQL = _metric_sql("p.lon", "p.lat")
PLANE = f"""verts AS (
  SELECT kind, id, i, {X_SQL} AS x, {Y_SQL} AS y FROM (
    SELECT kind, id, unnest(generate_series(1, len(coords))) AS i, unnest(coords) AS p FROM shapes)),
edge AS (
  SELECT a.kind, a.id, a.i, a.x, a.y, b.x - a.x AS dx, b.y - a.y AS dy,
         sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2) AS len
  FROM verts a JOIN verts b ON a.kind = b.kind AND a.id = b.id AND b.i = a.i + 1
  WHERE a.x <> b.x OR a.y <> b.y),
joint AS (
  SELECT * FROM (
    SELECT kind, id, lead(x) OVER w AS x, lead(y) OVER w AS y, dx / len AS ux, dy / len AS uy,
           lead(dx / len) OVER w AS vx, lead(dy / len) OVER w AS vy
    FROM edge WINDOW w AS (PARTITION BY kind, id ORDER BY i)) WHERE x IS NOT NULL)"""


def _clip(a: str, d: str, lo: str, hi: str) -> tuple[str, str]:
    start = f"""CASE WHEN {d} <> 0 THEN greatest(0, least(({lo} - {a}) / {d}, ({hi} - {a}) / {d}))
      WHEN {a} BETWEEN {lo} AND {hi} THEN 0 ELSE 2 END"""
    end = f"""CASE WHEN {d} <> 0 THEN least(1, greatest(({lo} - {a}) / {d}, ({hi} - {a}) / {d}))
      WHEN {a} BETWEEN {lo} AND {hi} THEN 1 ELSE -1 END"""
    return start, end


def _rect_sql(half: float) -> str:
    """Columns lo, hi: part of edge ``e`` in the rectangle of edge ``r``."""
    along, along_d = "((e.x - r.x) * r.dx + (e.y - r.y) * r.dy) / r.len", "(e.dx * r.dx + e.dy * r.dy) / r.len"
    across, across_d = "((e.y - r.y) * r.dx - (e.x - r.x) * r.dy) / r.len", "(e.dy * r.dx - e.dx * r.dy) / r.len"
    s1, e1 = _clip(f"({along})", f"({along_d})", "0", "r.len")
    s2, e2 = _clip(f"({across})", f"({across_d})", f"-{half}", f"{half}")
    return f"greatest({s1}, {s2}) AS lo, least({e1}, {e2}) AS hi"


def _wedge_sql(half: float) -> str:
    """Columns lo, hi: part of edge ``e`` in the outer sector of the turn ``c``."""
    b = "((e.x - c.x) * e.dx + (e.y - c.y) * e.dy)"
    q = f"({b} ** 2 - e.len ** 2 * ((e.x - c.x) ** 2 + (e.y - c.y) ** 2 - {half} ** 2))"
    along = lambda u: (f"((e.x - c.x) * c.{u}x + (e.y - c.y) * c.{u}y)", f"(e.dx * c.{u}x + e.dy * c.{u}y)")
    s1, e1 = _clip(*along("u"), "0", "1e300")
    s2, e2 = _clip(*along("v"), "-1e300", "0")
    lo = f"CASE WHEN {q} >= 0 THEN greatest(0, (-{b} - sqrt(greatest({q}, 0))) / e.len ** 2) ELSE 2 END"
    hi = f"CASE WHEN {q} >= 0 THEN least(1, (-{b} + sqrt(greatest({q}, 0))) / e.len ** 2) ELSE -1 END"
    return f"greatest({lo}, {s1}, {s2}) AS lo, least({hi}, {e1}, {e2}) AS hi"


@query(
    "to_metric",
    f"""WITH {A.LINE_SQL} SELECT segment_id, i, round({X_SQL}, 4) AS x, round({Y_SQL}, 4) AS y FROM (
      SELECT segment_id, CAST(unnest(generate_series(0, 2)) AS INTEGER) AS i, unnest(coords) AS p FROM lines)""",
)
def to_metric(spark, d):
    points = A.lines(spark, d).select("segment_id", F.posexplode(G.project(F.col("coords"))).alias("i", "p"))
    return points.select("segment_id", "i", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"))


def _scores_sql(shapes: str) -> str:
    """All pairs, all edges: brute force over kinds ``new`` and ``old``."""
    return f"""shapes AS ({shapes}), {PLANE},
  spans AS (
    SELECT e.kind AS kind, e.id AS a, r.id AS b, e.i, e.len, {_rect_sql(5.0)}
    FROM edge e JOIN edge r ON e.kind <> r.kind
    UNION ALL
    SELECT e.kind, e.id, c.id, e.i, e.len, {_wedge_sql(5.0)} FROM edge e JOIN joint c ON e.kind <> c.kind),
  merged AS (
    SELECT kind, a, b, len, greatest(0, hi - greatest(lo, coalesce(max(hi) OVER (
      PARTITION BY kind, a, b, i ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS part
    FROM spans WHERE lo < hi),
  shares AS (
    SELECT m.kind, a, b, sum(part * len) / any_value(total) AS share FROM merged m
    JOIN (SELECT kind, id, sum(len) AS total FROM edge GROUP BY 1, 2) t ON t.kind = m.kind AND t.id = m.a
    GROUP BY 1, 2, 3),
  scores AS (
    SELECT n.a AS new_id, n.b AS old_id, least(n.share, o.share) AS score
    FROM shares n JOIN shares o ON n.kind = 'new' AND o.kind = 'old' AND n.a = o.b AND n.b = o.a
    WHERE least(n.share, o.share) >= 0.7 - 1e-9)"""


@query(
    "match_replacements",
    f"""WITH {A.LINE_SQL}, {A.FRESH_SQL}, {A.ARCHIVE_SQL},
      {_scores_sql("SELECT 'new' AS kind, segment_id AS id, coords FROM fresh UNION ALL SELECT 'old', segment_id, coords FROM archive")}
    SELECT new_id, old_id, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY new_id ORDER BY round(score, 9) DESC, old_id) AS rn
      FROM scores) WHERE rn = 1""",
)
def match_replacements(spark, d):
    matches = spatial.match_replacements(A.fresh_map(spark, d), A.archive(spark, d))
    return matches.withColumn("score", F.round("score", 6))


GAPS = f"""{A.LINE_SQL}, {A.LOG_SQL}, {A.ARCHIVE_SQL},
  {_scores_sql("SELECT 'new' AS kind, segment_id AS id, coords FROM log UNION ALL SELECT 'old', segment_id, coords FROM archive")},
  gaps AS (SELECT * FROM (
    SELECT s.new_id, l.date_added, s.old_id, a.date_archived, s.score,
      row_number() OVER (PARTITION BY new_id ORDER BY round(score, 9) DESC, old_id) AS rn
    FROM scores s JOIN log l ON l.segment_id = s.new_id JOIN archive a ON a.segment_id = s.old_id
    WHERE a.date_archived <= l.date_added) WHERE rn = 1)"""
GAP_SECONDS = "date_diff('second', date_archived, date_added)"


def _gaps(spark, d):
    return spatial.replacement_gap_candidates(A.changelog(spark, d), A.archive(spark, d))


@query(
    "replacement_gap_candidates",
    f"WITH {GAPS} SELECT new_id, date_added, old_id, date_archived, round(score, 6) AS score FROM gaps",
)
def replacement_gap_candidates(spark, d):
    return _gaps(spark, d).withColumn("score", F.round("score", 6))


@query(
    "replacement_gap_histogram",
    f"""WITH {GAPS}, c AS (SELECT CASE WHEN g <= 60 THEN 'same cycle (<=1m)' WHEN g <= 3600 THEN '<1h'
        WHEN g <= 21600 THEN '1-6h' WHEN g <= 86400 THEN '6-24h' WHEN g <= 604800 THEN '1-7d' ELSE '>7d' END
        AS gap_class FROM (SELECT {GAP_SECONDS} AS g FROM gaps))
    SELECT gap_class, count(*) AS matches, round(count(*) / sum(count(*)) OVER (), 6) AS share
    FROM c GROUP BY 1""",
)
def replacement_gap_histogram(spark, d):
    return spatial.replacement_gap_histogram(_gaps(spark, d)).withColumn("share", F.round("share", 6))


@query(
    "gap_summary",
    f"""WITH {GAPS} SELECT count(*) AS matched, count(*) FILTER (WHERE {GAP_SECONDS} > 60) AS cross_cycle,
      round(count(*) FILTER (WHERE {GAP_SECONDS} > 60) / nullif(count(*), 0), 6) AS cross_share FROM gaps""",
)
def gap_summary(spark, d):
    return spatial.gap_summary(_gaps(spark, d)).withColumn("cross_share", F.round("cross_share", 6))


AREA_RING = """[{'lon': x0, 'lat': y0}, {'lon': x1, 'lat': y0}, {'lon': x1, 'lat': y1},
  {'lon': x0, 'lat': y1}, {'lon': x0, 'lat': y0}]"""
HITS = f"""{A.LINE_SQL}, {A.AREA_SQL},
  shapes AS (SELECT 'line' AS kind, segment_id AS id, coords FROM lines
             UNION ALL SELECT 'area', disturbance_id, {AREA_RING} FROM areas), {PLANE},
  touch AS (
    SELECT r.id AS segment_id, e.id AS disturbance_id, {_rect_sql(20.0)}
    FROM edge e JOIN edge r ON e.kind = 'area' AND r.kind = 'line'
    UNION ALL
    SELECT c.id, e.id, {_wedge_sql(20.0)} FROM edge e JOIN joint c ON e.kind = 'area' AND c.kind = 'line'),
  middle AS (SELECT id, x + dx / 2 AS x, y + dy / 2 AS y FROM edge WHERE kind = 'line'),
  inside AS (
    SELECT m.id AS segment_id, e.id AS disturbance_id FROM middle m JOIN edge e ON e.kind = 'area'
    WHERE (e.y > m.y) <> (e.y + e.dy > m.y) AND m.x < e.x + e.dx * (m.y - e.y) / e.dy
    GROUP BY m.id, m.x, m.y, e.id HAVING count(*) % 2 = 1),
  hits AS (SELECT segment_id, disturbance_id FROM touch WHERE lo <= hi
           UNION SELECT segment_id, disturbance_id FROM inside)"""


@query("segments_hit_by", f"WITH {HITS} SELECT segment_id, disturbance_id FROM hits")
def segments_hit_by(spark, d):
    return spatial.segments_hit_by(A.lines(spark, d), A.areas(spark, d)).select(
        "segment_id", "disturbance_id"
    )


@query(
    "widen_segments",
    f"""WITH {A.LINE_SQL}, shapes AS (SELECT 'line' AS kind, segment_id AS id, coords FROM lines), {PLANE}
    SELECT id AS segment_id, count(*) AS rectangles, 1::BIGINT AS discs, round(sum(len), 4) AS length,
      round(min(least(x, x + dx)) - 20, 4) AS min_x, round(max(greatest(y, y + dy)) + 20, 4) AS max_y
    FROM edge GROUP BY 1""",
)
def widen_segments(spark, d):
    wide = spatial.widen_segments(A.lines(spark, d))
    return wide.select(
        "segment_id",
        F.size("edges").cast("bigint").alias("rectangles"),
        F.size("joints").cast("bigint").alias("discs"),
        F.round(G.line_length(F.col("edges")), 4).alias("length"),
        F.round("box.x0", 4).alias("min_x"),
        F.round("box.y1", 4).alias("max_y"),
    )


@query(
    "restore_geometry",
    f"WITH {A.LINE_SQL} SELECT segment_id, {A.HASH_SQL} AS geometry_hash FROM lines",
)
def restore_geometry(spark, d):
    back = spatial.restore_geometry(spatial.widen_segments(A.lines(spark, d)))
    return back.select("segment_id", S.geometry_hash(F.col("coords")).alias("geometry_hash"))


def _area_reports(spark, d):
    """Areas as reports; nations without an even number lack an application id."""
    k = F.col("n_nationkey")
    return A.areas(spark, d).select(
        "disturbance_id",
        "polygons",
        F.col("n_name").alias("type"),
        F.when(k % 2 == 0, F.concat(F.lit("KP"), k)).alias("application_id"),
        F.date_format(F.date_add(F.lit("1997-11-20").cast("date"), k * 3), "yyyy-MM-dd").alias("start_text"),
        F.date_format(F.date_add(F.lit("1998-01-05").cast("date"), k), "yyyy-MM-dd").alias("end_text"),
        F.when(k % 3 == 0, F.col("n_name")).alias("address"),
        F.lit(None).cast("string").alias("district"),
    )


AREA_REPORTS = """SELECT disturbance_id, n_name AS type,
  CASE WHEN n_nationkey % 2 = 0 THEN 'KP' || n_nationkey END AS application_id,
  strftime(DATE '1997-11-20' + n_nationkey * 3, '%Y-%m-%d') AS start_text,
  strftime(DATE '1998-01-05' + n_nationkey, '%Y-%m-%d') AS end_text,
  CASE WHEN n_nationkey % 3 = 0 THEN n_name END AS address FROM areas"""


@query(
    "collisions",
    f"""WITH {HITS}, r AS ({AREA_REPORTS})
    SELECT segment_id, disturbance_id, type, application_id, start_text AS star_date, end_text AS end_date,
      address FROM hits JOIN r USING (disturbance_id)""",
)
def collisions(spark, d):
    reports = _area_reports(spark, d)
    flat = D.collisions(spatial.segments_hit_by(A.lines(spark, d), reports), reports)
    p = "properties"
    return flat.select(
        "segment_id",
        "disturbance_id",
        F.col(f"{p}.traffic_disturbance_type").alias("type"),
        F.col(f"{p}.application_id").alias("application_id"),
        F.col(f"{p}.star_date").alias("star_date"),
        F.col(f"{p}.end_date").alias("end_date"),
        F.col(f"{p}.address").alias("address"),
    )


@query(
    "affected_segments",
    f"""WITH {HITS}, r AS ({AREA_REPORTS})
    SELECT segment_id, disturbance_id FROM hits JOIN r USING (disturbance_id)
    WHERE end_text >= '{AS_OF[:10]}' AND start_text >= '{A.VALIDATION_DATE[:10]}' AND start_text <= end_text""",
)
def affected_segments(spark, d):
    hit = jobs.affected_segments(
        _area_reports(spark, d), A.lines(spark, d), A.ts(A.VALIDATION_DATE), A.ts(AS_OF)
    )
    return hit.select("segment_id", "disturbance_id")


NESTED_SQL = f"""WITH {A.REPORT_SQL} SELECT segment_id, count(*) AS collisions,
  count(DISTINCT disturbance_id) AS disturbances, min(start_text) AS first_start FROM reports GROUP BY 1"""


def _flat_collisions(spark, d):
    flat = A.reports(spark, d).withColumns(
        {
            "polygons": F.lit(None).cast("array<array<array<struct<lon:double,lat:double>>>>"),
            "coords": F.array(F.struct(F.lit(24.9).alias("lon"), F.lit(60.1).alias("lat"))),
        }
    )
    return flat.withColumn("properties", D.collision_properties(flat.columns))


@query("disturbances_by_segment", NESTED_SQL)
def disturbances_by_segment(spark, d):
    """Nested lists, counted back."""
    one = F.explode("detailed_collisions").alias("c")
    return (
        D.disturbances_by_segment(_flat_collisions(spark, d))
        .select("segment_id", one)
        .groupBy("segment_id")
        .agg(
            F.count("*").alias("collisions"),
            F.count_distinct("c.disturbance_id").alias("disturbances"),
            F.min("c.properties.star_date").alias("first_start"),
        )
    )


@query(
    "save_collisions",
    f"WITH {A.REPORT_SQL} SELECT segment_id, disturbance_id, start_text FROM reports",
)
def save_collisions(spark, d):
    """Stored flat, a row per pair, and read back."""
    path = shared_dir(spark, "collisions")
    tables.save_table(_flat_collisions(spark, d), path)
    return tables.load_table(spark, path).select("segment_id", "disturbance_id", "start_text")


@query(
    "export_collisions",
    f"""WITH {A.REPORT_SQL} SELECT segment_id, count(*) AS collisions,
      min(start_text) AS first_start FROM reports GROUP BY 1""",
)
def export_collisions(spark, d):
    """GeoJSON features of nested collisions, read back."""
    feature = """properties struct<segment_id: string, detailedCollisions:
        array<struct<properties: struct<star_date: string>>>>"""
    nested = D.disturbances_by_segment(_flat_collisions(spark, d))
    rows = exports.collision_features(nested).select(F.from_json("value", feature).alias("f"))
    one = F.explode("f.properties.detailedCollisions").alias("c")
    return rows.select(F.col("f.properties.segment_id").alias("segment_id"), one).groupBy("segment_id").agg(
        F.count("*").alias("collisions"), F.min("c.properties.star_date").alias("first_start")
    )


def _kept(df, name):
    """``df`` written to the shared folder and read again."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


DOCUMENT_SQL = f"""WITH {A.REPORT_SQL} SELECT DISTINCT segment_id, disturbance_id, start_text FROM reports"""


@query("export_collision_document", DOCUMENT_SQL)
def export_collision_document(spark, d):
    """The whole map form with collisions, its lines read back one by one."""
    flat = _flat_collisions(spark, d).dropDuplicates(["segment_id", "disturbance_id"])
    # Both the rows and what the lines say are used several times: each is worked out once.
    flat = _kept(flat, "flat-collisions")
    item = r'\{"properties":(\{.*?\}),"geometry"'
    lines = exports.collision_document(flat.withColumn("polygons", F.array(F.array("coords"))))
    name = F.regexp_extract("value", r'^(?:\{"segmentId":\{)?"([^"]+)":\{"geometry"', 1)
    one = F.from_json(F.regexp_extract("value", item, 1), "traffic_disturbance_id string, star_date string")
    opened = _kept(lines.select(name.alias("opens"), one.alias("c")), "document-lines")
    pairs = flat.select("segment_id", "disturbance_id").groupBy("segment_id").agg(F.min("disturbance_id").alias("first"))
    # Every segment opens once, at its first disturbance.
    starts = opened.filter("opens <> ''").select(F.col("opens").alias("segment_id"), F.col("c.traffic_disturbance_id").alias("first"))
    good = pairs.join(starts, ["segment_id", "first"]).select("segment_id")
    rows = opened.select(F.col("c.traffic_disturbance_id").alias("disturbance_id"), F.col("c.star_date").alias("start_text"))
    keyed = flat.select("segment_id", "disturbance_id").join(rows, "disturbance_id")
    return keyed.join(good, "segment_id", "left_semi").select("segment_id", "disturbance_id", "start_text").distinct()


@query(
    "empty_documents",
    """SELECT '{"type":"FeatureCollection","features":[]}' AS value FROM (SELECT count(*) AS n FROM customer WHERE c_custkey < 0) WHERE n = 0
      UNION ALL SELECT '{"segmentId":{}}' FROM (SELECT count(*) AS n FROM customer WHERE c_custkey < 0) WHERE n = 0""",
)
def empty_documents(spark, d):
    """Documents of a selection that holds no segment."""
    none = A.lines(spark, d).filter(F.col("segment_id") == "")
    return exports.feature_collection(exports.segment_features(none), ["segment_id"]).unionByName(exports.map_document(none))


@query(
    "gap_totals",
    f"""WITH {GAPS}, t AS (SELECT count(*) AS scanned, count(*) FILTER (WHERE n_history > 0) AS done FROM log),
      g AS (SELECT count(*) AS matched, count(*) FILTER (WHERE date_diff('second', date_archived, gaps.date_added) > 60) AS cross_cycle
        FROM gaps JOIN log ON segment_id = new_id WHERE n_history = 0)
    SELECT matched, cross_cycle, scanned, done AS already_inherited, scanned - done - matched AS orphan,
      round(cross_cycle / nullif(scanned - done, 0), 6) AS cross_share FROM t, g""",
)
def gap_totals(spark, d):
    """Segments with a history count as having inherited it."""
    log = A.changelog(spark, d).withColumn("geo_inherited_from", F.when(F.size("history") > 0, "earlier"))
    totals = spatial.gap_totals(log, spatial.replacement_gap_candidates(log, A.archive(spark, d)))
    return totals.withColumn("cross_share", F.round("cross_share", 6))


@query(
    "collisions_quality",
    f"""WITH {A.REPORT_SQL} SELECT count(DISTINCT segment_id) AS segments, 'stale' AS verdict,
      121::DOUBLE AS age_minutes FROM reports""",
)
def collisions_quality(spark, d):
    return Q.collisions_quality(
        A.reports(spark, d), A.ts("1998-01-15 08:29:00"), A.ts(AS_OF)
    )


# --- J5-J7, J12, W4, W8, U3, L1-L3 ---------------------------------------------------------------

CYCLE = f"TIMESTAMP '{A.CYCLE_DATE}'"
NETWORK = f"{A.LINE_SQL}, {A.FRESH_SQL}, {A.LOG_SQL}, {A.ARCHIVE_SQL}"
DIFF = f"""{NETWORK}, fresh_hash AS (SELECT segment_id, {A.HASH_SQL} AS h FROM fresh),
  diff AS (
  SELECT coalesce(f.segment_id, l.segment_id) AS segment_id,
    CASE WHEN f.segment_id IS NULL THEN 'removed' WHEN l.segment_id IS NULL THEN 'added'
         WHEN f.h <> l.current_hash THEN 'modified' ELSE 'unchanged' END AS change,
    coalesce(f.h, l.current_hash) AS current_hash,
    coalesce(l.date_added, {CYCLE}) AS date_added,
    coalesce(l.n_history, 0) + CASE WHEN f.h <> l.current_hash THEN 1 ELSE 0 END AS n_history,
    CASE WHEN f.segment_id IS NULL THEN {CYCLE} END AS date_archived
  FROM fresh_hash f FULL JOIN log l ON f.segment_id = l.segment_id)"""


def _diff(spark, d):
    return L.diff_segments(A.fresh_map(spark, d), A.changelog(spark, d), A.ts(A.CYCLE_DATE))


@query(
    "diff_segments",
    f"""WITH {DIFF} SELECT segment_id, change, current_hash, date_added,
      CAST(n_history AS INTEGER) AS n_history, date_archived FROM diff""",
)
def diff_segments(spark, d):
    return _diff(spark, d).select(
        "segment_id",
        "change",
        "current_hash",
        "date_added",
        F.size("history").alias("n_history"),
        "date_archived",
    )


@query("removed_ids", f"WITH {NETWORK} SELECT segment_id FROM log EXCEPT SELECT segment_id FROM fresh")
def removed_ids(spark, d):
    return L.set_difference(A.changelog(spark, d), A.fresh_map(spark, d))


@query("added_ids", f"WITH {NETWORK} SELECT segment_id FROM fresh EXCEPT SELECT segment_id FROM log")
def added_ids(spark, d):
    return L.added_ids(_diff(spark, d))


@query(
    "save_archive",
    f"""WITH {DIFF} SELECT segment_id, date_archived FROM archive
      UNION ALL SELECT segment_id, date_archived FROM diff WHERE change = 'removed'""",
)
def save_archive(spark, d):
    path = shared_dir(spark, "archive")
    tables.save_table(A.archive(spark, d), path)
    stored = tables.load_table(spark, path)
    tables.save_table(L.next_archive(_diff(spark, d), stored), path)
    return tables.load_table(spark, path).select("segment_id", "date_archived")


# Half of the earlier archive has heirs already.
def _log_with_heirs(spark, d):
    heir = F.when(F.col("n") % 2 == 0, F.concat(F.lit("old-"), "segment_id"))
    n = F.substring("segment_id", 2, 18).cast("bigint")
    done = F.when(F.col("n") % 4 == 0, A.ts(A.LOG_DATE))
    return (
        A.changelog(spark, d)
        .withColumn("n", n)
        .withColumn("geo_inherited_from", heir)
        .withColumn("timeseries_migrated_at", done)
        .drop("n")
    )


@query(
    "replacement_candidates",
    f"""WITH {DIFF}, used AS (SELECT 'old-' || segment_id AS id FROM log WHERE CAST(substr(segment_id, 2) AS BIGINT) % 2 = 0)
    SELECT segment_id, date_archived FROM diff WHERE change = 'removed'
    UNION ALL SELECT segment_id, date_archived FROM archive
      WHERE date_archived >= {CYCLE} - INTERVAL 72 HOUR AND segment_id NOT IN (SELECT id FROM used)""",
)
def replacement_candidates(spark, d):
    diff = L.diff_segments(A.fresh_map(spark, d), _log_with_heirs(spark, d), A.ts(A.CYCLE_DATE))
    archived = L.next_archive(diff, A.archive(spark, d))
    found = L.replacement_candidates(
        archived, _log_with_heirs(spark, d), L.removed_ids(diff), A.ts(A.CYCLE_DATE), 72
    )
    return found.select("segment_id", "date_archived")


@query(
    "pending_migrations",
    f"""WITH {NETWORK} SELECT 'old-' || segment_id AS old_id, segment_id AS new_id FROM log
      WHERE CAST(substr(segment_id, 2) AS BIGINT) % 4 = 2""",
)
def pending_migrations(spark, d):
    return L.pending_migrations(_log_with_heirs(spark, d))


@query(
    "inherit_history",
    f"""WITH {NETWORK} SELECT l.segment_id, a.segment_id AS geo_inherited_from,
      CAST(l.n_history + coalesce(a.n_history + 1, 0) AS INTEGER) AS n_history,
      CASE WHEN a.segment_id IS NULL AND l.n_history = 0 THEN NULL
           WHEN a.segment_id IS NULL THEN TIMESTAMP '2023-06-01 00:00:00'
           WHEN a.n_history > 0 THEN TIMESTAMP '2023-06-01 00:00:00' ELSE a.date_archived END AS oldest
    FROM log l LEFT JOIN archive a ON a.segment_id = 'old-' || l.segment_id
      AND CAST(substr(l.segment_id, 2) AS BIGINT) % 2 = 1""",
)
def inherit_history(spark, d):
    log = A.changelog(spark, d)
    odd = F.substring("segment_id", 2, 18).cast("bigint") % 2 == 1
    matches = log.filter(odd).select(
        F.col("segment_id").alias("new_id"), F.concat(F.lit("old-"), "segment_id").alias("old_id")
    )
    return L.inherit_history(log, A.archive(spark, d), matches).select(
        "segment_id",
        "geo_inherited_from",
        F.size("history").alias("n_history"),
        F.get("history", F.lit(0))["date_archived"].alias("oldest"),
    )


@query(
    "segment_cycle",
    f"""WITH {DIFF},
      candidates AS (SELECT segment_id FROM diff WHERE change = 'removed' UNION ALL
        SELECT segment_id FROM archive WHERE date_archived >= {CYCLE} - INTERVAL 72 HOUR),
      {_scores_sql('''SELECT 'new' AS kind, segment_id AS id, coords FROM fresh
          WHERE segment_id IN (SELECT segment_id FROM diff WHERE change = 'added')
        UNION ALL SELECT 'old', segment_id, coords FROM (SELECT segment_id, coords FROM log UNION ALL
          SELECT segment_id, coords FROM archive) WHERE segment_id IN (SELECT segment_id FROM candidates)''')},
      best AS (SELECT new_id, old_id FROM (SELECT *, row_number() OVER (
        PARTITION BY new_id ORDER BY round(score, 9) DESC, old_id) AS rn FROM scores) WHERE rn = 1)
    SELECT d.segment_id, b.old_id AS geo_inherited_from,
      CAST(d.n_history + coalesce(coalesce(l.n_history, a.n_history) + 1, 0) AS INTEGER) AS n_history
    FROM diff d LEFT JOIN best b ON b.new_id = d.segment_id LEFT JOIN log l ON l.segment_id = b.old_id
      LEFT JOIN archive a ON a.segment_id = b.old_id WHERE d.change <> 'removed'""",
)
def segment_cycle(spark, d):
    log, _, _ = L.segment_cycle(
        A.fresh_map(spark, d), A.changelog(spark, d), A.archive(spark, d), A.ts(A.CYCLE_DATE), 72
    )
    return log.select("segment_id", "geo_inherited_from", F.size("history").alias("n_history"))


VERSIONS = f"""versions AS (
  SELECT segment_id, time AS recorded_at, event_id, CAST(fcd_coverage AS VARCHAR) AS geometry_hash,
         row_number() OVER (PARTITION BY segment_id ORDER BY time DESC, event_id DESC) AS rn FROM obs)"""


def _versions(spark, d, obs):
    point = F.struct(F.col("average_speed").alias("lon"), F.lit(60.1).alias("lat"))
    return obs.select(
        "segment_id",
        F.col("time").alias("recorded_at"),
        "event_id",
        F.col("fcd_coverage").cast("string").alias("geometry_hash"),
        F.array(point).alias("coords"),
    )


@query(
    "keep_newest_versions",
    f"WITH {A.TYPE_OBS}, {VERSIONS} SELECT segment_id, event_id FROM versions WHERE rn <= 50",
)
def keep_newest_versions(spark, d):
    versions = _versions(spark, d, A.type_obs(spark, d))
    return L.keep_newest_versions(versions, tie="event_id").select("segment_id", "event_id")


@query(
    "changelog_view",
    f"""WITH {A.USER_OBS}, {VERSIONS} SELECT segment_id,
      max(geometry_hash) FILTER (WHERE rn = 1) AS current_hash,
      max(recorded_at) FILTER (WHERE rn = 1) AS date_added,
      CAST(count(*) - 1 AS INTEGER) AS n_history,
      max(geometry_hash) FILTER (WHERE rn = 2) AS previous_hash
    FROM versions WHERE rn <= 50 GROUP BY 1""",
)
def changelog_view(spark, d):
    versions = _versions(spark, d, A.user_obs(spark, d))
    view = L.changelog_view(L.keep_newest_versions(versions, tie="event_id"), tie="event_id")
    return view.select(
        "segment_id",
        "current_hash",
        "date_added",
        F.size("history").alias("n_history"),
        F.get("history", F.lit(0))["geometry_hash"].alias("previous_hash"),
    )


@query(
    "save_changelog",
    f"WITH {A.USER_OBS}, {VERSIONS} SELECT segment_id, event_id FROM versions WHERE rn <= 50",
)
def save_changelog(spark, d):
    path = shared_dir(spark, "changelog")
    versions = _versions(spark, d, A.user_obs(spark, d))
    tables.save_table(L.keep_newest_versions(versions, tie="event_id"), path)
    return tables.load_table(spark, path).select("segment_id", "event_id")


# Every odd user's series moves to the next even user's id; hours make both hold some keys.
RETAG = (
    A.USER_OBS
    + """, renames AS (SELECT DISTINCT segment_id AS old_id, 'u' || (user_id + 1) AS new_id
  FROM obs WHERE user_id % 2 = 1),
points AS (SELECT DISTINCT ON (segment_id, h) segment_id, date_trunc('hour', time) AS h, fcd_coverage
  FROM obs ORDER BY segment_id, h, time DESC, event_id DESC),
moved AS (SELECT coalesce(new_id, segment_id) AS segment_id, h AS time, fcd_coverage,
  new_id IS NOT NULL AS was_moved FROM points LEFT JOIN renames ON old_id = segment_id),
retagged AS (SELECT segment_id, time, arg_max(fcd_coverage, was_moved::INTEGER) AS fcd_coverage
  FROM moved GROUP BY 1, 2)"""
)


def _retag_input(spark, d):
    obs = A.user_obs(spark, d)
    points = series.downsample_last(obs, ["fcd_coverage"], 60, tie="event_id")
    odd = obs.filter(F.col("user_id") % 2 == 1)
    renames = odd.select(
        F.col("segment_id").alias("old_id"),
        F.concat(F.lit("u"), (F.col("user_id") + 1).cast("string")).alias("new_id"),
    ).distinct()
    return points, renames


@query("retag_series", f"WITH {RETAG} SELECT segment_id, time, fcd_coverage FROM retagged")
def retag_series(spark, d):
    points, renames = _retag_input(spark, d)
    return L.retag_series(points, renames)


REPORT = (
    RETAG
    + """, report AS (SELECT 'fcd' AS measurement, old_id, new_id,
  (SELECT count(*) FROM points p WHERE p.segment_id = old_id) AS original_count,
  (SELECT count(*) FROM retagged r WHERE r.segment_id = new_id) AS retagged_count, true AS deleted FROM renames)"""
)


@query("retag_report", f"WITH {REPORT} SELECT * FROM report")
def retag_report(spark, d):
    points, renames = _retag_input(spark, d)
    return L.retag_report(points, renames, "fcd")


@query(
    "move_segments",
    f"WITH {RETAG} SELECT segment_id, count(*) AS points, CAST(sum(fcd_coverage) AS BIGINT) AS coverage "
    "FROM retagged GROUP BY 1",
)
def move_segments(spark, d):
    """Renames on a stored series: copied, counted, then deleted in the touched parts."""
    path = shared_dir(spark, "series")
    points, renames = _retag_input(spark, d)
    tables.write_series(points, path, ["fcd_coverage"])
    tables.move_segments(spark, path, renames, ["fcd_coverage"], "fcd")
    return tables.read_series(spark, path).groupBy("segment_id").agg(
        F.count("*").alias("points"), F.sum("fcd_coverage").alias("coverage")
    )


@query(
    "apply_migrations",
    f"""WITH {NETWORK} SELECT segment_id, CASE CAST(substr(segment_id, 2) AS BIGINT) % 4
      WHEN 0 THEN TIMESTAMP '{A.LOG_DATE}' WHEN 2 THEN {CYCLE} END AS timeseries_migrated_at FROM log""",
)
def apply_migrations(spark, d):
    log = _log_with_heirs(spark, d)
    points, _ = _retag_input(spark, d)
    report = L.retag_report(points, L.pending_migrations(log), "fcd")
    return L.stamp_migrated(log, report, A.ts(A.CYCLE_DATE)).select("segment_id", "timeseries_migrated_at")
