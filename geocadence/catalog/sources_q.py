"""Source and sink queries: S1-S15. Files go to the shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from geocadence.operators.alerts import locate_points
from geocadence.operators.grid import rasterize
from geocadence.catalog.registry import (
    AREAS, SQL_AREA_DAYS, SQL_AREA_HOURS, SQL_CELL_HOURS, SQL_REGISTRY, SQL_SLIP_POINTS, Tables, area_days, area_hours, big, cell_hours, cents, query, r6,
    registry, slip_points, text,
)
from geocadence.functions.projection import projection
from geocadence.functions.text import dated_folder, fill_template, time_from_path
from geocadence.functions.times import hour_floor, hours, ntz_lit
from geocadence.session import scratch
from geocadence.sources import grids as GR
from geocadence.sources import runs as RU
from geocadence.sources import tables as TB
from geocadence.sources.splits import packed_cells, write_packed


@query("s1_csv_field_map", f"""
WITH {SQL_SLIP_POINTS} SELECT CAST(id AS VARCHAR) AS id, strftime(time, '%d/%m/%Y') AS time, custkey / 4.0 AS longitude, 'Città ' || alert_area_code AS amm_level_2, alert_area_code FROM slip_points""")
def s1(t: Tables):
    path = scratch(t.spark, "s1")
    dmy = F.concat(F.lpad(F.dayofmonth("time").cast("string"), 2, "0"), F.lit("/"), F.lpad(F.month("time").cast("string"), 2, "0"), F.lit("/"), F.year("time").cast("string"))
    slip_points(t).select(
        F.col("id").cast("string").alias("id_frana"), dmy.alias("data"), (F.col("custkey") / 4.0).alias("lon"), F.lit("x").alias("provincia"),
        F.concat(F.lit("Città "), F.col("alert_area_code")).alias("comune"), F.col("alert_area_code").alias("ALLERTA"),
    ).write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    schema = "id_frana string, data string, lon double, lat double, comune string, ALLERTA string"  # the file has one more and lacks one
    return TB.read_delimited(t.spark, path, schema, {
        "id": "id_frana", "time": "data", "longitude": "lon", "latitude": "lat", "amm_level_1": None, "amm_level_2": "comune", "alert_area_code": "ALLERTA"})


@query("s2_prefixed_rows", f"""
WITH {SQL_AREA_DAYS} SELECT CAST(time AS VARCHAR) AS time, area AS domain, value AS rain_peak_3H, n AS "rain_accumulated_12H:max", 'obs' AS rain_mode FROM area_days""")
def s2(t: Tables):
    path = scratch(t.spark, "s2")
    area_days(t).select(text("time").alias("time"), F.col("area").alias("domain"), F.col("value").alias("peak_3H"), F.col("n").alias("acc"), F.lit("u").alias("junk")) \
        .write.csv(path, sep=";", header=True)
    out = TB.read_indicator_rows(
        t.spark, path, "time string, domain string, peak_3H double, acc bigint, junk string",
        {"time": "time", "domain": "domain", ":": "peak_3H", "{:}_accumulated_12H:max": "acc", "junk": None},
        prefix="rain", allowed=("rain", "sm"), extra={"rain_mode": "obs", "rain_peak_3H": 0.0}, required=("time", "domain"))
    return out


@query("s3_keyed_lookup", f"""
WITH {SQL_SLIP_POINTS}, {SQL_REGISTRY} SELECT id, name FROM slip_points JOIN registry ON alert_area = alert_area_code""")
def s3(t: Tables):
    path = scratch(t.spark, "s3")
    registry(t).select("name", "alert_area").write.csv(path, header=True)
    lookup = TB.read_lookup(t.spark, path, "name string, alert_area string", "alert_area")
    p = slip_points(t)
    return p.join(lookup, p["alert_area_code"] == lookup["alert_area"]).select("id", "name")


@query("s4_csv_sink", f"""
WITH {SQL_AREA_DAYS} SELECT area, CAST(time AS VARCHAR) AS time, format('{{:.2f}}', value) AS value, CAST(n AS VARCHAR) AS n FROM area_days""")
def s4(t: Tables):
    path = scratch(t.spark, "s4")
    TB.write_csv(area_days(t), path, ["area"])
    return t.spark.read.schema("time string, value string, n string, area string").csv(path, sep=";", header=True)


@query("s4_csv_transposed", f"""
WITH {SQL_AREA_DAYS} SELECT area, CAST(time AS VARCHAR) AS time, 'value' AS name, format('{{:.3f}}', value) AS value FROM area_days
UNION ALL SELECT area, CAST(time AS VARCHAR), 'n', CAST(n AS VARCHAR) FROM area_days""")
def s4_transposed(t: Tables):
    return TB.transposed(area_days(t), ["area", "time"], decimals=3).withColumn("time", text("time"))


def _cells(t: Tables):
    return cell_hours(t).select("area", F.col("time"), F.lit(0).alias("row"), F.col("cell").alias("col"), "value")


_MASK = [(0, 0, 1), (0, 1, 0), (0, 2, 1)]


def _mask(t: Tables):
    return t.spark.createDataFrame(_MASK, "row int, col int, mask int")


@query("s5_grid_scan", f"""
WITH {SQL_CELL_HOURS} SELECT area, CAST(time AS VARCHAR) AS time, cell AS col, value FROM cell_hours WHERE cell IN (0, 2) AND time BETWEEN TIMESTAMP '2024-01-04 05:00:00' AND TIMESTAMP '2024-01-09 17:00:00'""")
def s5(t: Tables):
    path = scratch(t.spark, "s5")
    GR.write_cells(_cells(t), path)
    out = GR.scan_cells(t.spark, path, ntz_lit("2024-01-04 05:00:00"), ntz_lit("2024-01-09 17:00:00"), _mask(t), ("area", "time", "row", "col", "value"))
    return out.select("area", text("time").alias("time"), "col", "value")


@query("s5b_missing_policy", f"""
WITH {SQL_AREA_HOURS}, g AS (SELECT area, CAST(time AS DATE) AS day, COUNT(*) AS present FROM area_hours GROUP BY 1, 2)
SELECT area, CAST(day AS VARCHAR) AS day, CAST(24 AS BIGINT) AS expected, present, 24 - present AS missing FROM g WHERE present > 1""")
def s5b(t: Tables):
    h = area_hours(t).withColumn("day", F.col("time").cast("date"))
    spine = h.select("area", "day").distinct().withColumn("_s", F.col("day").cast("timestamp_ntz")).select(
        "area", "day", F.explode(F.sequence("_s", F.col("_s") + hours(23), hours(1))).alias("time"))
    return GR.step_policy(spine, h, ["area", "day"], "skip").withColumn("day", text("day"))


def _user_cells(t: Tables):
    """Hourly sums on a grid of 64 x 64 cells: the cell of an event is that of its user."""
    c = F.pmod("user_id", F.lit(4096)).cast("int")
    e = t.events.select(hour_floor(F.col("ts")).alias("time"), F.floor(c / 64).cast("int").alias("row"), F.pmod(c, F.lit(64)).alias("col"), cents().alias("c"))
    return e.groupBy("time", "row", "col").agg((F.sum("c") / 100.0).alias("value"))


SQL_USER_CELLS = """u AS (
  SELECT date_trunc('hour', ts) AS time, CAST(user_id % 4096 AS BIGINT) // 64 AS row, CAST(user_id % 64 AS BIGINT) AS col,
         SUM(CAST(round(value * 100) AS BIGINT)) / 100.0 AS value FROM events GROUP BY 1, 2, 3)"""


@query("s5_tile_scan", f"""
WITH {SQL_USER_CELLS} SELECT CAST(time AS VARCHAR) AS time, row, col, value FROM u
WHERE row < 20 AND col < 20 AND time BETWEEN TIMESTAMP '2024-01-04 05:00:00' AND TIMESTAMP '2024-01-09 17:00:00'""")
def s5_tiles(t: Tables):
    path = scratch(t.spark, "s5t")
    GR.write_cells(_user_cells(t), path, rows_per_file=2000)
    mask = t.spark.range(4096).select(F.floor(F.col("id") / 64).cast("int").alias("row"), F.pmod("id", F.lit(64)).cast("int").alias("col"))
    mask = mask.withColumn("mask", ((F.col("row") < 20) & (F.col("col") < 20)).cast("int"))
    out = GR.scan_cells(t.spark, path, ntz_lit("2024-01-04 05:00:00"), ntz_lit("2024-01-09 17:00:00"), mask)
    return out.select(text("time").alias("time"), big("row").alias("row"), big("col").alias("col"), "value")


@query("s5b_step_log", """
SELECT DISTINCT CAST(date_trunc('hour', ts) AS VARCHAR) AS time FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03 07:00:00' AND TIMESTAMP '2024-01-28 18:59:59.999999'""")
def s5b_log(t: Tables):
    path = scratch(t.spark, "s5l")
    GR.write_cells(_user_cells(t), path)
    return GR.written_steps(t.spark, path, ntz_lit("2024-01-03 07:00:00"), ntz_lit("2024-01-28 18:00:00")).select(text("time").alias("time"))


@query("s6_multi_path_scan", f"""
WITH {SQL_CELL_HOURS} SELECT area, CAST(time AS VARCHAR) AS time, cell AS col, value FROM cell_hours WHERE time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 23:00:00'""")
def s6(t: Tables):
    paths = []
    for area in AREAS:
        paths.append(scratch(t.spark, f"s6-{area}"))
        part = _cells(t).filter(F.col("area") == area)
        GR.write_cells(part if area == "click" else part.withColumn("extra", F.lit(1)), paths[-1])
    out = GR.scan_cells(t.spark, paths, ntz_lit("2024-01-10 00:00:00"), ntz_lit("2024-01-12 23:00:00"), None, ("area", "time", "row", "col", "value"))
    return out.select("area", text("time").alias("time"), "col", "value")


def _daily_grids(t: Tables):
    """One 6 x 5 grid per event type and day: user_id % 30 names the cell, the value is the number of events."""
    c = F.pmod("user_id", F.lit(30)).cast("int")
    n = t.events.groupBy(F.col("event_type").alias("area"), F.col("ts").cast("date").alias("day"), c.alias("c")).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("area", "day").agg(F.map_from_entries(F.collect_list(F.struct("c", "n"))).alias("m"))


SQL_DAILY = """n AS (SELECT event_type AS area, CAST(ts AS DATE) AS day, CAST(user_id % 30 AS INTEGER) AS c, COUNT(*) AS n FROM events GROUP BY 1, 2, 3),
k AS (SELECT area, day, c FROM (SELECT DISTINCT area, day FROM n), range(0, 30) g(c)),
v AS (SELECT area, day, c, n FROM k LEFT JOIN n USING (area, day, c))"""


@query("s7_ascii_grid", f"""
WITH {SQL_DAILY} SELECT area, CAST(day AS VARCHAR) AS day, c // 5 AS row, c % 5 AS col, round(8 + 0.25 + (c % 5) * 0.5 + 1e-9, 6) AS lon, round(44 + 0.25 + (5 - c // 5) * 0.5 + 1e-9, 6) AS lat, CAST(n AS DOUBLE) AS value FROM v""")
def s7(t: Tables):
    path = scratch(t.spark, "s7")
    row = lambda r: F.concat_ws(" ", *[F.coalesce(F.col("m")[r * 5 + c], F.lit(-9999)).cast("string") for c in range(5)])
    header = "ncols        5\nnrows        6\nxllcorner    8.0\nyllcorner    44.0\ncellsize     0.5\nNODATA_value -9999\n"
    grids = _daily_grids(t).select("area", "day", F.concat(F.lit(header), F.concat_ws("\n", *[row(r) for r in range(6)]), F.lit("\n")).alias("text"))
    # one line per file: the grid text is stored as a single record and read back whole
    grids.repartition("area", "day").write.partitionBy("area", "day").option("maxRecordsPerFile", 1).text(path)
    out = GR.split_ascii_cells(t.spark, path, "*.txt")
    name = F.col("path")
    return out.select(
        F.regexp_extract(name, "area=([^/]+)", 1).alias("area"), F.regexp_extract(name, "day=([^/]+)", 1).alias("day"),
        big("row").alias("row"), big("col").alias("col"), r6("lon").alias("lon"), r6("lat").alias("lat"), "value")


@query("s8_binary_grid", f"""
WITH {SQL_DAILY} SELECT area || '/' || day AS path, CAST(0 AS BIGINT) AS step, c % 6 AS row, c // 6 AS col, COALESCE(n, 0) / 10.0 AS value FROM v""")
def s8(t: Tables):
    # little-endian int32 in column order, written by hex digits
    le = lambda x: F.concat(*[F.substring(F.lpad(F.hex(x), 8, "0"), 7 - 2 * b, 2) for b in range(4)])
    packed = F.unhex(F.concat(*[le(F.coalesce(F.col("m")[c], F.lit(0))) for c in range(30)]))
    path = scratch(t.spark, "s8")
    write_packed(_daily_grids(t).select(F.concat("area", F.lit("/"), text("day")).alias("path"), packed.alias("content")), path)
    out = packed_cells(t.spark, path, 6, 5)
    return out.select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("path"), *[big(c).alias(c) for c in ("step", "row", "col")], "value")


@query("s9_station_points", """
SELECT c_name AS name, round(c_custkey / 100.0 + 1e-9, 6) AS longitude, CAST(TIMESTAMP '2024-01-02 03:00:00' AS VARCHAR) AS time, c_acctbal AS data
FROM customer WHERE c_custkey % 3 = 1 AND c_acctbal BETWEEN 0 AND 5000""")
def s9(t: Tables):
    comma = lambda c: F.regexp_replace(c.cast("string"), "[.]", ",")
    k = F.col("c_custkey")
    raw = t.customer.select(
        k.cast("string").alias("code"), F.col("c_name").alias("name"), comma(k / 10).alias("longitude"), comma(k / 5).alias("latitude"),
        F.concat(F.lit("20240102"), F.lpad((F.pmod(k, F.lit(3)) + 2).cast("string"), 2, "0"), F.lit("00")).alias("time"), comma(F.col("c_acctbal")).alias("data"))
    out = TB.parse_stations(raw, at=ntz_lit("2024-01-02 03:00:00"), lo=0.0, hi=5000.0)
    return out.select("name", r6("longitude").alias("longitude"), text("time").alias("time"), "data")


@query("s10_polygon_text", """
SELECT 'C' || c_custkey AS alert_area_code, r AS ring, v AS vertex,
  CAST(CASE WHEN r = 1 THEN c_custkey + CASE WHEN v IN (0, 2) THEN 0.125 ELSE 0.25 END WHEN r = 2 THEN c_custkey - CASE WHEN v = 1 THEN 2 ELSE 1 END
    WHEN v IN (0, 3) THEN c_custkey ELSE c_custkey + 0.5 END AS DOUBLE) AS x,
  CAST(CASE WHEN r = 1 THEN c_nationkey + CASE WHEN v = 2 THEN 0.25 ELSE 0.125 END WHEN r = 2 THEN c_nationkey + CASE WHEN v = 2 THEN 0.875 ELSE 0 END
    WHEN v < 2 THEN c_nationkey ELSE c_nationkey + 0.75 END AS DOUBLE) AS y
FROM customer, range(0, 3) p(r), range(0, 4) g(v) WHERE (r = 0 OR v < 3) AND (r = 0 OR (r = 1 AND c_custkey % 2 = 0) OR (r = 2 AND c_custkey % 3 = 0))""")
def s10(t: Tables):
    rings = F.posexplode("rings").alias("ring", "_r")
    rows = TB.parse_polygons(_area_texts(t), "ALLERTA").select("alert_area_code", rings).select("alert_area_code", "ring", F.posexplode("_r").alias("vertex", "v"), F.col("_r"))
    kind = F.when((F.col("ring") == 0) | (F.size("_r") == 4), 0).when(F.col("v.x") < F.substring("alert_area_code", 2, 20).cast("double"), 2).otherwise(1)
    return rows.select("alert_area_code", big(kind).alias("ring"), big("vertex").alias("vertex"), "v.x", "v.y")


# fixed values: the systems the polygons of a customer may come in
_SYSTEMS = {"degrees": 4326, "web": 3857, "utm32": 32632, "utm33": 25833}


@query("s10_reprojected", """
SELECT 'C' || c_custkey AS alert_area_code, s AS system, v AS vertex,
  round(CASE WHEN s = 'utm33' THEN 12 ELSE 6 END + (c_custkey % 500) / 100.0::DOUBLE + CASE WHEN v IN (1, 2) THEN 0.37 ELSE 0 END + 1e-9, 6) AS lon,
  round(36 + c_nationkey / 2.0::DOUBLE + CASE WHEN v > 1 THEN 0.23 ELSE 0 END + 1e-9, 6) AS lat
FROM customer, (VALUES ('degrees'), ('web'), ('utm32'), ('utm33')) x(s), range(0, 4) g(v)""")
def s10_reprojected(t: Tables):
    """A rectangle per customer written as text in each system, and read as degrees."""
    out = None
    for name, epsg in _SYSTEMS.items():
        system = projection(epsg)
        x0 = F.lit(12.0 if name == "utm33" else 6.0) + F.pmod("c_custkey", F.lit(500)) / 100.0
        y0 = F.lit(36.0) + F.col("c_nationkey") / 2.0
        corners = [(x0 + dx, y0 + dy) for dx, dy in ((0.0, 0.0), (0.37, 0.0), (0.37, 0.23), (0.0, 0.23))]
        points = [F.concat_ws(" ", *[c.cast("string") for c in (system.forward(*p) if system else p)]) for p in corners]
        raw = t.customer.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("code"),
                                F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *points, points[0]), F.lit("))")).alias("wkt"))
        rows = TB.parse_polygons(raw, "code", epsg=epsg).select("alert_area_code", F.lit(name).alias("system"), F.posexplode(F.col("rings")[0]).alias("vertex", "p"))
        rows = rows.select("alert_area_code", "system", big("vertex").alias("vertex"), r6("p.x").alias("lon"), r6("p.y").alias("lat"))
        out = rows if out is None else out.unionByName(rows)
    return out


# position of a point in the areas of ``_area_texts``: dx, dy from the customer's corner
SQL_IN_AREA = """((dx > 0 AND dx < 0.5 AND dy > 0 AND dy < 0.75 AND NOT (k % 2 = 0 AND dx > 0.125 AND dy > 0.125 AND dx + dy < 0.375))
  OR (k % 3 = 0 AND dx < -1 AND dy > 0 AND dy < 0.875 * (dx + 2)))"""


@query("j1_holes_parts", f"""
WITH p AS (SELECT o_orderkey, o_custkey + (o_orderkey % 48 - 32) / 16.0::DOUBLE + 0.01::DOUBLE AS x, c_nationkey + (o_orderkey % 9) / 8.0::DOUBLE + 0.013::DOUBLE AS y
  FROM orders JOIN customer ON c_custkey = o_custkey),
m AS (SELECT o_orderkey, c_custkey AS k, x - c_custkey AS dx, y - c_nationkey AS dy FROM p JOIN customer ON c_custkey BETWEEN floor(x) AND floor(x) + 2),
h AS (SELECT o_orderkey, 'C' || k AS code FROM m WHERE {SQL_IN_AREA})
SELECT p.o_orderkey, code AS alert_area_code_polygon FROM p LEFT JOIN h USING (o_orderkey)""")
def j1_holes_parts(t: Tables):
    key = F.col("o_orderkey")
    pts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        key, (F.col("o_custkey") + (F.pmod(key, F.lit(48)) - 32) / 16.0 + 0.01).alias("lon"), (F.col("c_nationkey") + F.pmod(key, F.lit(9)) / 8.0 + 0.013).alias("lat"))
    return locate_points(pts, TB.parse_polygons(_area_texts(t), "ALLERTA"), bin_deg=0.5).select("o_orderkey", "alert_area_code_polygon")


@query("j15_holes_parts", f"""
WITH f AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN -2 ELSE 0 END AS x0, CAST(ceil(CASE WHEN c_custkey % 3 = 0 THEN 0.875 ELSE 0.75 END / 0.07) AS INTEGER) AS n FROM customer),
g AS (SELECT k, r, c, x0 + 0.035::DOUBLE + c * 0.07::DOUBLE AS dx, 0.035::DOUBLE + (n - 1 - r) * 0.07::DOUBLE AS dy FROM f, range(0, 13) a(r), range(0, 40) b(c) WHERE r < n)
SELECT 'C' || k AS alert_area_code, CAST(r AS BIGINT) AS row, CAST(c AS BIGINT) AS col FROM g WHERE {SQL_IN_AREA}""")
def j15_holes_parts(t: Tables):
    out = rasterize(TB.parse_polygons(_area_texts(t), "ALLERTA"), 0.07)
    return out.select("alert_area_code", big("row").alias("row"), big("col").alias("col"))


def _area_texts(t: Tables):
    """A rectangle per customer; every second one has a hole, every third one a second part (of several parts: MULTIPOLYGON)."""
    x0, y0 = F.col("c_custkey").cast("double"), F.col("c_nationkey").cast("double")
    pt = lambda x, y: F.concat_ws(" ", x.cast("string"), y.cast("string"))
    ring = lambda *points: F.concat(F.lit("("), F.concat_ws(", ", *points, points[0]), F.lit(")"))
    outline = ring(pt(x0, y0), pt(x0 + 0.5, y0), pt(x0 + 0.5, y0 + 0.75), pt(x0, y0 + 0.75))
    hole = ring(pt(x0 + 0.125, y0 + 0.125), pt(x0 + 0.25, y0 + 0.125), pt(x0 + 0.125, y0 + 0.25))
    second = ring(pt(x0 - 1, y0), pt(x0 - 2, y0), pt(x0 - 1, y0 + 0.875))
    first = F.when(F.pmod("c_custkey", F.lit(2)) == 0, F.concat_ws(", ", outline, hole)).otherwise(outline)
    text = F.when(F.pmod("c_custkey", F.lit(3)) == 0, F.concat(F.lit("MULTIPOLYGON (("), first, F.lit("), ("), second, F.lit("))")))
    return t.customer.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ALLERTA"), F.coalesce(text, F.concat(F.lit("POLYGON ("), first, F.lit(")"))).alias("wkt"))


@query("s11_grid_sink", f"""
WITH {SQL_CELL_HOURS} SELECT area, CAST(CAST(time AS DATE) AS VARCHAR) AS date, CAST(time AS VARCHAR) AS time, cell AS col, value, CASE cell WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 END AS region_mask FROM cell_hours""")
def s11(t: Tables):
    path = scratch(t.spark, "s11")
    GR.write_cells(_cells(t), path, _mask(t))
    return t.spark.read.parquet(path).select("area", text("date").alias("date"), text("time").alias("time"), "col", "value", "region_mask")


@query("s12_dated_paths", f"""
WITH {SQL_AREA_HOURS} SELECT DISTINCT '/dst/' || strftime(time, '%Y/%m/%d/') || 'indicators_rain_' || strftime(time, '%Y%m%d%H%M') || '_' || area || '.csv' AS path, CAST(CAST(time AS DATE) AS VARCHAR) AS day FROM area_hours""")
def s12(t: Tables):
    stamp = dated_folder(F.col("time"), "%Y%m%d%H%M")
    path = fill_template("/dst/{run_sub_path_time}indicators_rain_{run_datetime}_{alert_area_name}.csv", {
        "run_sub_path_time": dated_folder(F.col("time")), "run_datetime": stamp, "alert_area_name": F.col("area")})
    out = area_hours(t).select(path.alias("path"))
    return out.select("path", text(time_from_path(F.col("path"), "%Y/%m/%d/").cast("date")).alias("day"))


@query("o7_dated_folders", f"""
WITH {SQL_AREA_DAYS} SELECT area, CAST(CAST(time AS TIMESTAMP) AS VARCHAR) AS folder_time, value FROM area_days""")
def o7(t: Tables):
    path = scratch(t.spark, "o7")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    d = area_days(t).withColumns({"yyyy": F.year("time").cast("string"), "mm": two(F.month("time")), "dd": two(F.dayofmonth("time"))})
    d.repartition("yyyy", "mm", "dd").write.partitionBy("yyyy", "mm", "dd").parquet(path)
    back = t.spark.read.parquet(path)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "(yyyy|mm|dd)=", "")
    return back.select("area", text(time_from_path(folder, "%Y/%m/%d/")).alias("folder_time"), "value")


@query("s13_robust_json", """
WITH d AS (SELECT event_id, event_id % 4 AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) AS v FROM events)
SELECT event_id, CASE WHEN k < 2 THEN v END AS value, k = 0 AS parsed_strict, CASE k WHEN 2 THEN 'no_json_braces_found' WHEN 3 THEN 'strict and sliced parse failed' END AS parse_error FROM d""")
def s13(t: Tables):
    k = F.pmod("event_id", F.lit(4))
    doc = F.when(k == 0, F.col("props")).when(k == 1, F.concat(F.lit("log: "), F.col("props"), F.lit(" end"))) \
        .when(k == 2, F.lit("nothing here")).otherwise(F.concat(F.lit("{bad "), F.col("props"), F.lit("}")))
    out = RU.parse_documents(t.events.select("event_id", doc.alias("text")))
    return out.select("event_id", F.try_variant_get("doc", "$.k", "bigint").alias("value"), "parsed_strict", "parse_error")


@query("s14_file_inventory", """
SELECT event_type || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS folder, CAST(1 AS BIGINT) AS files, CAST(SUM(length(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS bytes,
  bool_and(event_type <> 'view') AS listed_flat FROM events GROUP BY event_type, CAST(ts AS DATE)""")
def s14(t: Tables):
    """A text file per event type and day, an id on each line: names and lengths are known."""
    path = scratch(t.spark, "s14")
    e = t.events.select("event_type", F.col("ts").cast("date").alias("day"), F.col("event_id").cast("string").alias("value"))
    e.repartition(8, "event_type", "day").write.partitionBy("event_type", "day").text(path)
    folder = F.concat(F.regexp_extract("path", "event_type=([^/]+)", 1), F.lit("/"), F.regexp_extract("path", "day=([^/]+)", 1))
    every = RU.list_files(t.spark, path, "*.txt").groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    # without recursion only the named folders are listed
    flat = RU.list_files(t.spark, [f"{path}/event_type={a}/day=*" for a in AREAS if a != "view"], "part-*.txt", recursive=False).select(folder.alias("folder"), F.lit(True).alias("_f"))
    return every.join(flat.distinct(), "folder", "left").select("folder", "files", "bytes", F.coalesce("_f", F.lit(False)).alias("listed_flat"))


@query("s15_training_matrix", """
SELECT vec_id AS i, CAST(embedding[1] AS DOUBLE) AS x0, CAST(embedding[4] AS DOUBLE) AS x3, label / 10.0 AS c FROM embeddings""")
def s15(t: Tables):
    path = scratch(t.spark, "s15")
    t.embeddings.select("vec_id", *[F.get("embedding", F.lit(k)).cast("double").alias(f"x{k}") for k in range(4)], (F.col("label") / 10.0).alias("c")).write.csv(path, header=False)
    return TB.read_training(t.spark, path, 4).select(big("i").alias("i"), F.col("x")[0].alias("x0"), F.col("x")[3].alias("x3"), "c")
