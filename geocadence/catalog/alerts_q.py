"""Alert queries: A1, C1-C5, J1-J3, P16, P25."""

from __future__ import annotations

from pyspark.sql import functions as F

from geocadence.catalog.registry import (
    SQL_AREA_DAYS, SQL_REGISTRY, SQL_SLIP_POINTS, Tables, area_days, big, query, registry, slip_points, text,
)
from geocadence.functions.text import parse_range, rgba_text, split_list, threshold_text
from geocadence.functions.times import hours
from geocadence.operators import alerts as A

# Colours of the catalogue: level, id, r, g, b, opacity. Red has no colour here, to show the empty text.
_COLORS = [("white", 0, 255, 255, 255, "0.5"), ("green", 1, 0, 128, 0, "0.5"), ("yellow", 2, 255, 255, 0, "1.0"),
           ("orange", 3, 255, 165, 0, "1.0"), ("red", 4, None, None, None, None)]
_COLORS_SQL = """colors(level, id, rgb) AS (VALUES ('white', 0, '255,255,255,0.5'), ('green', 1, '0,128,0,0.5'),
  ('yellow', 2, '255,255,0,1.0'), ('orange', 3, '255,165,0,1.0'), ('red', 4, ''))"""


def _colors(t: Tables):
    return t.spark.createDataFrame(_COLORS, "level string, id int, r int, g int, b int, opacity string")


_COUNTS = f"""{SQL_SLIP_POINTS}, {SQL_REGISTRY},
counts AS (SELECT time, alert_area_code, COUNT(*) AS soil_slips FROM slip_points GROUP BY 1, 2),
lab AS (SELECT c.*, r.name AS alert_area_label FROM counts c LEFT JOIN registry r ON r.alert_area = c.alert_area_code),
cls AS (SELECT lab.*, COALESCE((SELECT level FROM levels l WHERE l.name = lab.alert_area_label AND lo <= soil_slips AND (hi IS NULL OR soil_slips <= hi)
  ORDER BY ord LIMIT 1), 'unknown') AS alert_color FROM lab)"""


@query("a1_slip_counts", f"""
WITH {_COUNTS}, {_COLORS_SQL}
SELECT CAST(time AS VARCHAR) AS time, alert_area_code, alert_area_label, soil_slips, alert_color,
  CASE WHEN alert_color = 'unknown' THEN 'unknown' ELSE alert_color || '_range' END AS alert_range, CAST(id AS BIGINT) AS id, rgb AS alert_rgb,
  year(time) AS year, month(time) AS month, day(time) AS day
FROM cls LEFT JOIN colors ON colors.level = cls.alert_color""")
def a1(t: Tables):
    r = registry(t)
    out = A.count_slips(slip_points(t), r.select("name", "alert_area"), A.level_table(r), _colors(t))
    return out.select(text("time").alias("time"), "alert_area_code", "alert_area_label", "soil_slips", "alert_color", "alert_range",
                      big("id").alias("id"), "alert_rgb", *[big(c).alias(c) for c in ("year", "month", "day")])


@query("c1_alert_levels_area", f"""
WITH {_COUNTS} SELECT alert_area_label, alert_color, COUNT(*) AS days, CAST(MIN(soil_slips) AS BIGINT) AS lo, CAST(MAX(soil_slips) AS BIGINT) AS hi
FROM cls GROUP BY 1, 2""")
def c1(t: Tables):
    r = registry(t)
    counts = slip_points(t).groupBy("time", "alert_area_code").agg(F.count(F.lit(1)).alias("soil_slips"))
    out = A.classify_by_area(A.attach_label(counts, r), A.level_table(r), "soil_slips")
    return out.groupBy("alert_area_label", "alert_color").agg(
        F.count(F.lit(1)).alias("days"), F.min("soil_slips").alias("lo"), F.max("soil_slips").alias("hi"))


@query("c2_alert_levels_default", f"""
WITH {SQL_AREA_DAYS}, d AS (SELECT area, time, n % 23 - 2 AS c FROM area_days),
k AS (SELECT area, CAST(time AS VARCHAR) AS time, c, CAST(CASE WHEN c = 0 THEN 0 WHEN c BETWEEN 1 AND 2 THEN 1 WHEN c BETWEEN 3 AND 5 THEN 2
  WHEN c BETWEEN 6 AND 13 THEN 3 WHEN c >= 14 THEN 4 END AS BIGINT) AS slip_alert_id FROM d)
SELECT *, CASE slip_alert_id WHEN 0 THEN 'white' WHEN 1 THEN 'green' WHEN 2 THEN 'yellow' WHEN 3 THEN 'orange' WHEN 4 THEN 'red' END AS slip_alert_color,
 CASE slip_alert_id WHEN 0 THEN '255,255,255,0.1' WHEN 1 THEN '0,128,0,0.1' WHEN 2 THEN '255,255,0,0.1' WHEN 3 THEN '255,165,0,0.1' WHEN 4 THEN '255,0,0,0.1'
 ELSE '0,0,0,0.1' END AS slip_alert_rgba FROM k""")
def c2(t: Tables):
    d = area_days(t).select("area", text("time").alias("time"), (F.pmod("n", F.lit(23)) - 2).alias("c"))
    return A.classify_default(d, "c").withColumn("slip_alert_id", big("slip_alert_id"))


@query("c3_level_from_prediction", f"""
WITH {SQL_AREA_DAYS}, d AS (SELECT area, time, n % 17 AS c FROM area_days)
SELECT area, CAST(time AS VARCHAR) AS time, CAST(CASE WHEN c > 13 THEN 4 WHEN c > 5 THEN 3 WHEN c > 2 THEN 2 WHEN c >= 1 THEN 1 ELSE 0 END AS BIGINT) AS level FROM d""")
def c3(t: Tables):
    d = area_days(t).select("area", text("time").alias("time"), F.pmod("n", F.lit(17)).alias("c"))
    return A.classify_default(d, "c", "p").select("area", "time", big("p_id").alias("level"))


@query("c4_threshold_text", f"""
WITH {SQL_SLIP_POINTS}, {SQL_REGISTRY}, used AS (SELECT 'alert_area_' || lower(alert_area_code) AS name, COUNT(*) AS slips FROM slip_points GROUP BY 1)
SELECT l.name, level, CASE WHEN hi IS NULL THEN 'n >= ' || lo WHEN lo = hi THEN 'n = ' || lo ELSE lo || ' <= n <= ' || hi END AS label, slips FROM levels l JOIN used USING (name)""")
def c4(t: Tables):
    used = slip_points(t).groupBy(F.concat(F.lit("alert_area_"), F.lower("alert_area_code")).alias("name")).agg(F.count(F.lit(1)).alias("slips"))
    return A.level_table(registry(t)).select("name", "level", threshold_text(F.col("lo"), F.col("hi")).alias("label")).join(used, "name")


@query("c5_freshness_gate", """
WITH o AS (SELECT event_type AS g, MIN(ts) + INTERVAL 200 HOUR AS oldest FROM events GROUP BY 1),
f AS (SELECT event_id, ts AS mtime, CASE WHEN event_id % 10 = 0 THEN NULL ELSE oldest END AS oldest, TIMESTAMP '2024-01-25 12:00:00' AS run FROM events JOIN o ON g = event_type),
a AS (SELECT *, oldest IS NOT NULL AND mtime <= oldest AS by_old, CASE WHEN oldest IS NOT NULL AND mtime <= oldest THEN epoch_us(oldest) - epoch_us(mtime) ELSE epoch_us(run) - epoch_us(mtime) END AS us FROM f)
SELECT event_id, CASE WHEN by_old THEN 'oldest_sf_time' WHEN us < 0 THEN 'run_time_future' ELSE 'run_time' END AS anchor,
  us BETWEEN 0 AND CAST(72 AS BIGINT) * 3600000000 AS keep FROM a""")
def c5(t: Tables):
    oldest = t.events.groupBy("event_type").agg((F.min("ts") + hours(200)).alias("o"))
    files = t.events.join(oldest, "event_type").select(
        "event_id", F.col("ts").alias("mtime"), F.when(F.pmod("event_id", F.lit(10)) != 0, F.col("o")).alias("oldest"),
        F.lit("2024-01-25 12:00:00").cast("timestamp_ntz").alias("run_time"))
    return A.freshness_gate(files, 72).select("event_id", "anchor", "keep")


def _polygons(t: Tables):
    """Three overlapping shapes over the plane of the first two embedding entries."""
    rings = [("P1", "POLYGON((-0.31 -0.29, 0.07 -0.33, 0.11 0.05, -0.17 0.21, -0.31 -0.29))"),
             ("P2", "POLYGON((-0.07 -0.13, 0.33 -0.11, 0.29 0.31, 0.13 0.03, -0.07 -0.13))"),
             ("P3", "POLYGON((0.21 0.11, 0.41 0.13, 0.31 0.39, 0.21 0.11))")]
    from geocadence.sources.tables import parse_polygons
    return parse_polygons(t.spark.createDataFrame(rings, "ALLERTA string, wkt string"), "ALLERTA")


_EDGES_SQL = """edges(code, x1, y1, x2, y2) AS (VALUES
 ('P1', -0.31, -0.29, 0.07, -0.33), ('P1', 0.07, -0.33, 0.11, 0.05), ('P1', 0.11, 0.05, -0.17, 0.21), ('P1', -0.17, 0.21, -0.31, -0.29),
 ('P2', -0.07, -0.13, 0.33, -0.11), ('P2', 0.33, -0.11, 0.29, 0.31), ('P2', 0.29, 0.31, 0.13, 0.03), ('P2', 0.13, 0.03, -0.07, -0.13),
 ('P3', 0.21, 0.11, 0.41, 0.13), ('P3', 0.41, 0.13, 0.31, 0.39), ('P3', 0.31, 0.39, 0.21, 0.11))"""


@query("j1_point_polygon", f"""
WITH {_EDGES_SQL}, p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
h AS (SELECT vec_id, code, SUM(CASE WHEN (CAST(y1 AS DOUBLE) > y) <> (CAST(y2 AS DOUBLE) > y) AND x < CAST(x1 AS DOUBLE) + (y - CAST(y1 AS DOUBLE)) / (CAST(y2 AS DOUBLE) - CAST(y1 AS DOUBLE)) * (CAST(x2 AS DOUBLE) - CAST(x1 AS DOUBLE)) THEN 1 ELSE 0 END) AS n
  FROM p, edges GROUP BY 1, 2)
SELECT p.vec_id, code AS alert_area_code_polygon FROM p LEFT JOIN (SELECT * FROM h WHERE n % 2 = 1) h USING (vec_id)""")
def j1(t: Tables):
    pts = t.embeddings.select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("lon"), F.get("embedding", F.lit(1)).cast("double").alias("lat"))
    return A.locate_points(pts, _polygons(t), bin_deg=0.1).select("vec_id", "alert_area_code_polygon")


@query("a1_slip_counts_polygon", f"""
WITH {_EDGES_SQL}, p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, label FROM embeddings),
h AS (SELECT vec_id, code, SUM(CASE WHEN (CAST(y1 AS DOUBLE) > y) <> (CAST(y2 AS DOUBLE) > y) AND x < CAST(x1 AS DOUBLE) + (y - CAST(y1 AS DOUBLE)) / (CAST(y2 AS DOUBLE) - CAST(y1 AS DOUBLE)) * (CAST(x2 AS DOUBLE) - CAST(x1 AS DOUBLE)) THEN 1 ELSE 0 END) AS n
  FROM p, edges GROUP BY 1, 2)
SELECT CAST(DATE '2024-01-01' + CAST(label AS INTEGER) AS VARCHAR) AS time, code AS alert_area_code, COUNT(*) AS soil_slips
FROM p JOIN (SELECT * FROM h WHERE n % 2 = 1) h USING (vec_id) GROUP BY 1, 2""")
def a1_polygon(t: Tables):
    pts = t.embeddings.select(
        "vec_id", F.get("embedding", F.lit(0)).cast("double").alias("lon"), F.get("embedding", F.lit(1)).cast("double").alias("lat"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("label")).alias("time"), F.lit("XX").alias("alert_area_code"))
    r = registry(t)
    found = A.locate_points(pts, _polygons(t), bin_deg=0.1)
    out = A.count_slips(found, r.select("name", "alert_area"), A.level_table(r), code_source="polygon")
    return out.select(text("time").alias("time"), "alert_area_code", "soil_slips")


@query("j2_registry_groups", f"""
WITH {SQL_SLIP_POINTS}, {SQL_REGISTRY}, g AS (SELECT 'alert_area_' || lower(alert_area_code) AS name, COUNT(DISTINCT custkey) AS customers FROM slip_points GROUP BY 1)
SELECT name, alert_area, customers FROM registry JOIN g USING (name)""")
def j2(t: Tables):
    groups = slip_points(t).groupBy(
        F.concat(F.lit("alert_area_"), F.lower("alert_area_code")).alias("name")).agg(F.count_distinct("custkey").alias("customers"))
    return A.join_groups(registry(t).select("name", "alert_area"), groups)


@query("j3_code_label", f"""
WITH {SQL_SLIP_POINTS}, {SQL_REGISTRY}, c AS (SELECT id, CASE WHEN id % 7 = 0 THEN 'ZZ' ELSE alert_area_code END AS code FROM slip_points)
SELECT id, code AS alert_area_code, name AS alert_area_label FROM c LEFT JOIN registry ON alert_area = code""")
def j3(t: Tables):
    p = slip_points(t).select("id", F.when(F.pmod("id", F.lit(7)) == 0, "ZZ").otherwise(F.col("alert_area_code")).alias("alert_area_code"))
    return A.attach_label(p, registry(t)).select("id", "alert_area_code", "alert_area_label")


@query("p16_range_text", f"""
WITH {SQL_SLIP_POINTS}, {SQL_REGISTRY}, u AS (SELECT alert_area_code AS alert_area, COUNT(*) AS slips FROM slip_points GROUP BY 1)
SELECT name, level, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi, 'basin_' || k || '|basin_' || (k + 5) || '|basin_' || (k + 10) AS basins, slips
FROM levels JOIN registry USING (name) JOIN u USING (alert_area)""")
def p16(t: Tables):
    r = registry(t)
    used = slip_points(t).groupBy(F.col("alert_area_code").alias("alert_area")).agg(F.count(F.lit(1)).alias("slips"))
    basins = r.join(used, "alert_area").select("name", F.concat_ws("|", split_list(F.col("catchment"))).alias("basins"), "slips")
    return A.level_table(r).join(basins, "name").select("name", "level", big("lo").alias("lo"), big("hi").alias("hi"), "basins", "slips")


@query("p16_range_text_catalogue", """
SELECT p_partkey, p_size AS lo, CASE p_partkey % 3 WHEN 0 THEN p_size + 3 WHEN 1 THEN p_size + 4 END AS hi FROM part""")
def p16_part(t: Tables):
    s, m = F.col("p_size"), F.pmod("p_partkey", F.lit(3))
    txt = F.when(m == 0, F.concat(s.cast("string"), F.lit("-"), (s + 3).cast("string"))) \
        .when(m == 1, F.concat(s.cast("string"), F.lit("–"), (s + 4).cast("string"))).otherwise(F.concat(s.cast("string"), F.lit("+")))
    return t.part.select("p_partkey", parse_range(txt).alias("r")).select("p_partkey", "r.lo", "r.hi")


@query("p25_rgba_text", """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '0,0,0,0.1' ELSE (p_size % 256) || ',' || (p_partkey % 256) || ',0,0.1' END AS rgba FROM part""")
def p25(t: Tables):
    r = F.when(F.pmod("p_partkey", F.lit(5)) != 0, F.pmod("p_size", F.lit(256)))
    return t.part.select("p_partkey", rgba_text(r, F.pmod("p_partkey", F.lit(256)), F.lit(0), F.lit("0.1"), "0,0,0,0.1").alias("rgba"))
