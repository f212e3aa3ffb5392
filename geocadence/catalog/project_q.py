"""Projection and scalar queries: P1-P7, P10, P12-P15, P17, P18, P22, P23, P26, P27, F2."""

from __future__ import annotations

from pyspark.sql import functions as F

from geocadence.catalog.registry import (
    SQL_AREA_DAYS, SQL_AREA_HOURS, SQL_CELL_HOURS, SQL_SLIP_POINTS, Tables, area_days, area_hours, big, cell_hours, query, r6,
    registry, slip_points, text,
)
from geocadence.functions import cells as C
from geocadence.functions import text as X
from geocadence.operators import grid as G
from geocadence.operators import inventory as I
from geocadence.operators import project as P
from geocadence.operators.scenario import fill_by_kinds, fill_typed


@query("p1_field_map", f"""
WITH {SQL_SLIP_POINTS} SELECT id, CAST(time AS VARCHAR) AS time, alert_area_code AS area FROM slip_points""")
def p1(t: Tables):
    src = slip_points(t).select(F.col("id").alias("id_frana"), text("time").alias("data"), F.col("alert_area_code").alias("ALLERTA"), "custkey")
    return P.select_fields(src, {"id": "id_frana", "time": "data", "area": "ALLERTA", "province": "provincia", "owner": None})


@query("p1b_duplicate_targets", "SELECT l_orderkey AS key, l_partkey AS key_1, l_suppkey AS key_2, l_linenumber AS line, l_quantity FROM lineitem")
def p1b(t: Tables):
    src = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax")
    return P.rename_with_suffix(src, {"l_orderkey": "key", "l_partkey": "key", "l_suppkey": "key", "l_linenumber": "line", "l_tax": None})


@query("p2_time_filter", f"""
WITH {SQL_AREA_HOURS} SELECT area, CAST(time AS VARCHAR) AS time, value, n FROM area_hours
WHERE time BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00' AND area IN ('click', 'view') AND n = 3""")
def p2(t: Tables):
    out = P.filter_time(area_hours(t), "2024-01-05 06:00:00", "2024-01-20 18:00:00", {"area": ["click", "view"], "n": 3})
    return out.withColumn("time", text("time"))


@query("p3_drop_range", "SELECT event_id, value FROM events WHERE value >= 5 AND value <= 60.5")
def p3(t: Tables):
    return P.drop_out_of_range(t.events.select("event_id", "value"), "value", 5.0, 60.5)


@query("p4_clip_values", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity % 7 = 0 THEN NULL WHEN l_quantity < 10 THEN 10 WHEN l_quantity > 40 THEN 40 ELSE l_quantity END AS v FROM lineitem""")
def p4(t: Tables):
    v = F.when(F.pmod("l_quantity", F.lit(7)) != 0, F.col("l_quantity"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", C.clip(v, 10.0, 40.0).alias("v"))


@query("p5_range_to_null", "SELECT event_id, CASE WHEN value BETWEEN 5 AND 60.5 THEN value END AS v FROM events")
def p5(t: Tables):
    return t.events.select("event_id", C.within_or_null(F.col("value"), 5.0, 60.5).alias("v"))


@query("p6_scale_nodata", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity / 10 = 2.5 THEN NULL ELSE round(l_quantity / 10 + 1e-9, 6) END AS v FROM lineitem""")
def p6(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", r6(C.unscale(F.col("l_quantity"), 10.0, 2.5)).alias("v"))


@query("p7_mask_cells", f"""
WITH {SQL_CELL_HOURS}, m AS (SELECT user_id % 4 AS cell, COUNT(*) % 2 AS mask FROM events WHERE user_id % 4 <> 3 GROUP BY 1)
SELECT area, cell, CAST(time AS VARCHAR) AS time, CASE WHEN mask = 1 THEN value END AS value FROM cell_hours LEFT JOIN m USING (cell)""")
def p7(t: Tables):
    cells, mask = _masked(t)
    out = G.mask_cells(cells, mask)
    return out.select("area", F.col("col").alias("cell"), text("time").alias("time"), "value")


@query("p7_mask_cells_dropped", f"""
WITH {SQL_CELL_HOURS}, m AS (SELECT user_id % 4 AS cell, COUNT(*) % 2 AS mask FROM events WHERE user_id % 4 <> 3 GROUP BY 1)
SELECT area, cell, CAST(time AS VARCHAR) AS time, value FROM cell_hours JOIN m USING (cell) WHERE mask = 0""")
def p7_drop(t: Tables):
    cells, mask = _masked(t)
    out = G.mask_cells(cells, mask, keep=0, drop=True)
    return out.select("area", F.col("col").alias("cell"), text("time").alias("time"), "value")


def _masked(t: Tables):
    cells = cell_hours(t).withColumnRenamed("cell", "col").withColumn("row", F.lit(0))
    mask = t.events.groupBy(F.pmod("user_id", F.lit(4)).cast("int").alias("col")).agg(F.pmod(F.count(F.lit(1)), F.lit(2)).alias("mask")) \
        .filter("col <> 3").withColumn("row", F.lit(0))
    return cells, mask


def _grid_defs(t: Tables, shift: bool):
    """A grid per part; the second version differs in some fields for some parts."""
    k = F.col("p_partkey")
    d = t.part.select(
        k.cast("string").alias("grid"), F.col("p_size").alias("nrows"), (F.col("p_size") + 1).alias("ncols"),
        (F.lit(0.5) + k / 1000).alias("cellsize"), (k / 10).alias("xllcorner"), F.lit(44.0).alias("yllcorner"), k.alias("k"))
    if shift:
        d = d.withColumns({
            "ncols": F.when(F.pmod("k", F.lit(5)) == 0, F.col("ncols") + 1).otherwise(F.col("ncols")),
            "xllcorner": F.when(F.pmod("k", F.lit(3)) == 0, F.col("xllcorner") + 0.0001).when(F.pmod("k", F.lit(7)) == 0, F.col("xllcorner") + 0.01)
            .otherwise(F.col("xllcorner"))})
    return d.drop("k")


@query("p7b_mask_gate", """
SELECT CAST(p_partkey AS VARCHAR) AS grid, NOT (p_partkey % 5 = 0 OR (p_partkey % 7 = 0 AND p_partkey % 3 <> 0)) AS mask_active FROM part""")
def p7b(t: Tables):
    return G.same_grid(_grid_defs(t, False), _grid_defs(t, True))


@query("p7c_regrid_gate", "SELECT CAST(p_partkey AS VARCHAR) AS grid, p_partkey % 5 = 0 AS regrid FROM part")
def p7c(t: Tables):
    return G.needs_regrid(_grid_defs(t, False), _grid_defs(t, True))


def _loose(t: Tables):
    """Order rows with text numbers, some of them bad, and missing texts."""
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("key"), F.col("o_orderdate").cast("date").cast("string").alias("time"),
        F.when(F.pmod(k, F.lit(6)) == 0, "x12").when(F.pmod(k, F.lit(6)) == 1, None).otherwise((k % 40).cast("string")).alias("slips_obs_n"),
        F.when(F.pmod(k, F.lit(9)) == 0, None).otherwise(F.col("o_totalprice")).alias("rain_peak_3H"),
        F.when(F.pmod(k, F.lit(4)) == 0, "soon").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("rain_time_run"),
        F.when(F.pmod(k, F.lit(5)) != 0, F.col("o_orderstatus")).alias("rain_period_type"))


@query("p9_typed_fill", """
SELECT o_orderkey AS key, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00' AS time, CASE WHEN o_orderkey % 6 = 0 THEN 'x12' WHEN o_orderkey % 6 = 1 THEN 'NA' ELSE CAST(o_orderkey % 40 AS VARCHAR) END AS slips_obs_n,
  CASE WHEN o_orderkey % 9 = 0 THEN -9999 ELSE o_totalprice END AS rain_peak_3H,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00' END AS rain_time_run,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus ELSE 'NA' END AS rain_period_type FROM orders""")
def p9(t: Tables):
    return fill_typed(_loose(t)).withColumns({"time": text("time"), "rain_time_run": text("rain_time_run")})


@query("p10_schema_fill", """
SELECT o_orderkey AS key, CASE WHEN o_orderkey % 6 < 2 THEN -9999 ELSE o_orderkey % 40 END AS slips_obs_n,
  CASE WHEN o_orderkey % 9 = 0 THEN -9999 ELSE o_totalprice END AS rain_peak_3H,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00' END AS rain_time_run,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus ELSE 'NA' END AS rain_period_type, CAST(-9999 AS BIGINT) AS slips_pred_n, 'NA' AS slips_domain FROM orders""")
def p10(t: Tables):
    kinds = {"slips_obs_n": "numeric:integer", "rain_peak_3H": "numeric:float", "rain_time_run": "timestamp", "rain_period_type": "string",
             "slips_pred_n": "numeric:integer", "slips_domain": "string", "time": None}
    return fill_by_kinds(_loose(t), kinds, keep=("key",)).withColumn("rain_time_run", text("rain_time_run"))


@query("p12_flatten", f"""
WITH {SQL_AREA_HOURS} SELECT area, MAX(value) AS "rain_peak_3H:max", MIN(value) AS "rain_peak_3H:min", MAX(n) AS "rain_count:max" FROM area_hours GROUP BY area""")
def p12(t: Tables):
    m = area_hours(t).groupBy("area").agg(
        F.struct(F.max("value").alias("max"), F.min("value").alias("min")).alias("rain_peak_3H"), F.struct(F.max("n").alias("max")).alias("rain_count"))
    return P.flatten_struct(P.nest_columns(P.flatten_struct(m)))


@query("p13_labelled_fields", f"""
WITH {SQL_AREA_HOURS} SELECT area, value, 'run_1' AS run_name, strftime(time, '%Y-%m-%d') AS time_day, strftime(time, '%Y-%m-%d %H:%M') AS time_start FROM area_hours""")
def p13(t: Tables):
    return P.add_labelled(area_hours(t), {"run_name": "run_1"}, {"time_day": ("time", "date"), "time_start": ("time", "minute")}).drop("time", "n")


@query("p14_common_variables", """
SELECT event_type AS var, COUNT(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY 1""")
def p14(t: Tables):
    e = t.events.select(F.col("event_type").alias("var"), "value")
    a, _ = P.common_variables(P.keep_variables(e, ["click", "view", "error"]), P.keep_variables(e, ["view", "click", "signup"]))
    return a.groupBy("var").agg(F.count(F.lit(1)).alias("n"))


@query("p15_registry_subkeys", f"""
WITH {SQL_SLIP_POINTS}, r AS (SELECT 'alert_area_' || lower(substr(r_name, 1, 2)) AS name, substr(r_name, 1, 2) AS code FROM region),
u AS (SELECT alert_area_code AS code, COUNT(*) AS n FROM slip_points GROUP BY 1)
SELECT name AS key, code AS value, n FROM r JOIN u USING (code) UNION ALL SELECT code, name, n FROM r JOIN u USING (code)""")
def p15(t: Tables):
    r = registry(t)
    n = slip_points(t).groupBy("alert_area_code").agg(F.count(F.lit(1)).alias("n"))
    plain = P.registry_part(r, "name", "alert_area").join(n, F.col("value") == F.col("alert_area_code"))
    inverted = P.registry_part(r, "name", "alert_area", invert=True).join(n, F.col("key") == F.col("alert_area_code"))
    return plain.unionByName(inverted).drop("alert_area_code")


def _stamp(c="ts"):
    return F.regexp_replace(F.substring(F.col(c).cast("string"), 1, 16), "[-: ]", "")


@query("p17_filename_time", """
WITH f AS (SELECT event_id, ts, event_id % 4 AS k FROM events)
SELECT event_id, CASE WHEN k < 2 THEN CAST(date_trunc('minute', ts) AS VARCHAR) END AS from_token, CASE WHEN k <> 2 THEN CAST(date_trunc('minute', ts) AS VARCHAR) END AS from_digits,
  CASE WHEN k = 3 THEN CAST(date_trunc('minute', ts) AS VARCHAR) END AS from_regex, CAST(date_trunc('minute', ts) AS VARCHAR) AS from_info FROM f""")
def p17(t: Tables):
    k = F.pmod("event_id", F.lit(4))
    s = _stamp()
    name = F.when(k < 2, F.concat(F.lit("/data/indicators_rain_"), s, F.lit("_alert_area_a.csv"))) \
        .when(k == 2, F.concat(F.lit("/data/indicators_rain_2024139912_"), F.lit("a.csv"))) \
        .otherwise(F.concat(F.lit("/data/sm."), s, F.lit(".tiff")))
    info = F.concat(F.lit("/run/info_run_"), F.substring(s, 1, 8), F.lit("_"), F.substring(s, 9, 4), F.lit(".json"))
    return t.events.select(
        "event_id", text(X.time_from_token(name)).alias("from_token"), text(X.time_from_digits(name)).alias("from_digits"),
        text(X.time_from_regex(name, r"^sm\.(?P<YYYY>\d{4})(?P<MM>\d{2})(?P<DD>\d{2})(?P<HH>\d{2})(?P<mm>\d{2})")).alias("from_regex"),
        text(X.info_run_time(info)).alias("from_info"))


@query("p18_path_time", """
SELECT event_id, CAST(date_trunc('minute', ts) AS VARCHAR) AS minute_folder, CAST(date_trunc('hour', ts) AS VARCHAR) AS hour_folder, CAST(date_trunc('day', ts) AS VARCHAR) AS day_folder FROM events""")
def p18(t: Tables):
    folder = F.concat(F.lit("/data/obs/"), X.dated_folder(F.col("ts"), "%Y/%m/%d/%H%M"), F.lit("/rain.csv"))
    hourly = F.concat(F.lit("/data/obs/"), X.dated_folder(F.col("ts"), "%Y/%m/%d/%H"), F.lit("00/rain.csv"))
    return t.events.select(
        "event_id", text(X.time_from_path(folder)).alias("minute_folder"), text(X.time_from_path(hourly, "%Y/%m/%d/*00/")).alias("hour_folder"),
        text(X.time_from_path(folder, "%Y/%m/%d/")).alias("day_folder"))


@query("p22_volume_percent", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 3 THEN NULL WHEN l_tax = 0 THEN NULL
  ELSE round(least(100.0, greatest(0.0, l_quantity / (l_tax * 1000) * 100)) + 1e-9, 6) END AS sm FROM lineitem""")
def p22(t: Tables):
    vmax = F.when(F.col("l_tax") != 0, F.col("l_tax") * 1000)
    terrain = F.when(F.col("l_linenumber") == 3, -1).otherwise(10)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", r6(C.saturation_percent(F.col("l_quantity"), vmax, terrain)).alias("sm"))


@query("p23_curve_storage", """
SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 OR p_partkey % 5 = 0 THEN NULL ELSE round((1000.0 / (40 + p_size) - 10) * 25.4 + 1e-9, 6) END AS storage FROM part""")
def p23(t: Tables):
    cn = F.when(F.pmod("p_partkey", F.lit(6)) == 0, -9999).otherwise(F.col("p_size") + 40)
    river = F.when(F.pmod("p_partkey", F.lit(5)) == 0, 1).otherwise(0)
    return t.part.select("p_partkey", r6(C.storage_from_curve_number(cn, river)).alias("storage"))


@query("f2_layer_function", """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE round((1000.0 / (40 + p_size) - 10) * 25.4 + 1e-9, 6) END AS storage FROM part""")
def f2(t: Tables):
    d = t.part.withColumns({"cn": F.col("p_size") + 40, "riv": F.when(F.pmod("p_partkey", F.lit(5)) == 0, 1).otherwise(0)})
    return d.select("p_partkey", r6(C.layer_function("storage_from_curve_number", {"curve_number": "cn", "river": "riv"})).alias("storage"))


@query("p26_run_label", """
WITH f AS (SELECT event_id, ts, event_id % 5 AS k FROM events)
SELECT event_id, CASE WHEN k < 3 THEN strftime(ts, '%H:%M') END AS label, CASE WHEN k <> 4 OR event_id % 2 = 0 THEN strftime(ts, '%H:%M') END AS from_json, strftime(ts, '%H:%M') AS from_name FROM f""")
def p26(t: Tables):
    k = F.pmod("event_id", F.lit(5))
    s = F.substring(F.col("ts").cast("string"), 12, 8)
    raw = F.when(k == 0, F.regexp_replace(F.substring(s, 1, 5), ":", "")).when(k == 1, F.substring(s, 1, 5)).when(k == 2, s) \
        .when(k == 3, F.lit("25:71")).otherwise(F.lit("noon"))
    deep = F.concat(F.lit('{"a": 1, "b": [2, {"c": '), F.when(F.pmod("event_id", F.lit(2)) == 0, F.lit('{"run_time": "')).otherwise(F.lit('[{"run_time": "')), s,
                    F.when(F.pmod("event_id", F.lit(2)) == 0, F.lit('"}}]}')).otherwise(F.lit('"}]}]}')))  # at the third and at the fourth level
    doc = F.when(k == 4, deep).when(k < 2, F.concat(F.lit('{"run_time": "'), s, F.lit('"}'))) \
        .otherwise(F.concat(F.lit('{"timing": {"run_time": "'), s, F.lit('"}}')))
    name = F.concat(F.lit("/r/info_run_20240101_"), F.regexp_replace(F.substring(s, 1, 5), ":", ""), F.lit(".json"))
    return t.events.select("event_id", X.run_label(raw).alias("label"), X.run_label_from_json(doc).alias("from_json"), X.run_label_from_name(name).alias("from_name"))


@query("p27_name_tags", """
SELECT event_id FROM events WHERE event_type = 'view' AND event_id % 3 = 0""")
def p27(t: Tables):
    kind = F.when(F.pmod("event_id", F.lit(3)) == 0, "RAIN").otherwise("sm")
    files = t.events.select("event_id", F.concat(F.lit("/rain/x/"), kind, F.lit("_202401010000_"), F.col("event_type"), F.lit(".csv")).alias("path"))
    return I.files_with_tags(files, ["rain", "View"]).select("event_id")


@query("p27b_side_files", """
WITH f AS (SELECT CAST(ts AS DATE) AS day, event_id, ts, event_id % 4 AS k, strftime(ts, '%Y%m%d%H%M') AS st,
  (event_id % 97 = 0) AS exact FROM events),
n AS (SELECT day, ts, CASE k WHEN 0 THEN 'ME_' WHEN 1 THEN 'Meteo_Check_' WHEN 2 THEN 'rain_meteo_check_' ELSE 'data_' END ||
  (CASE WHEN exact THEN strftime(day, '%Y%m%d') || '1400' ELSE 'e' END) || '_' || event_id || '.json' AS name, k,
  exact FROM f)
SELECT CAST(day AS VARCHAR) AS day, arg_max('/run/' || name, {'a': CAST(exact AS INTEGER), 'b': ts, 'c': name}) FILTER (k IN (0, 1)) AS me_path,
  arg_max('/run/' || name, {'a': CAST(exact AS INTEGER), 'b': ts, 'c': name}) FILTER (k IN (1, 2)) AS mc_path FROM n GROUP BY day""")
def p27b(t: Tables):
    k = F.pmod("event_id", F.lit(4))
    day = F.col("ts").cast("date")
    stamp = F.concat(F.regexp_replace(day.cast("string"), "-", ""), F.lit("1400"))
    name = F.concat(
        F.when(k == 0, "ME_").when(k == 1, "Meteo_Check_").when(k == 2, "rain_meteo_check_").otherwise("data_"),
        F.when(F.pmod("event_id", F.lit(97)) == 0, stamp).otherwise(F.lit("e")), F.lit("_"), F.col("event_id").cast("string"), F.lit(".json"))
    files = t.events.select(day.alias("day"), F.concat(F.lit("/run/"), name).alias("path"), F.col("ts").alias("mtime"))
    own = F.concat(F.regexp_replace(F.col("day").cast("string"), "-", ""), F.lit("1400"))
    return I.side_files(files, ["day"], own).withColumn("day", text("day"))
