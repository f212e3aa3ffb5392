"""Time queries: T1-T7, W3, W4, W10-W12, P19-P21, P24."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from geocadence.catalog.registry import (
    SQL_AREA_DAYS, SQL_AREA_HOURS, Tables, area_days, area_hours, query, text,
)
from geocadence.functions import times as K
from geocadence.operators import timespine as Z


def _runs(t: Tables):
    """Run times: the first event of every area and day after an hour that moves from day to day."""
    late_enough = F.hour("ts") >= F.pmod(F.dayofmonth("ts") * 5, F.lit(24))
    return t.events.filter(late_enough).groupBy(
        F.col("event_type").alias("area"), F.col("ts").cast("date").alias("day")).agg(F.min("ts").alias("run"))


SQL_RUNS = """runs AS (SELECT event_type AS area, CAST(ts AS DATE) AS day, MIN(ts) AS run FROM events
  WHERE hour(ts) >= (day(ts) * 5) % 24 GROUP BY 1, 2)"""


@query("t1_run_window", f"""
WITH {SQL_RUNS}, w AS (SELECT *, date_trunc('hour', run) AS time_run FROM runs)
SELECT area, CAST(day AS VARCHAR) AS day, CAST(time_run AS VARCHAR) AS time_run,
  CAST(date_trunc('day', time_run - INTERVAL 23 HOUR) AS VARCHAR) AS window_start,
  CAST(date_trunc('day', time_run + INTERVAL 12 HOUR) + INTERVAL 1 DAY AS VARCHAR) AS window_end FROM w""")
def t1(t: Tables):
    w = Z.run_window(_runs(t), 24, 12)
    return w.select("area", text("day").alias("day"), *[text(c).alias(c) for c in ("time_run", "window_start", "window_end")])


@query("t1_run_steps_reversed", f"""
WITH {SQL_RUNS}, w AS (SELECT area, day, date_trunc('hour', run) AS time_run FROM runs)
SELECT area, CAST(day AS VARCHAR) AS day, i AS step, CAST(time_run + INTERVAL 2 HOUR - to_hours(CAST(i AS INTEGER)) AS VARCHAR) AS time
FROM w, range(0, 6) g(i)""")
def t1_steps(t: Tables):
    w = Z.run_window(_runs(t), 4, 2, snap_start="none", snap_end="none")
    out = Z.expand_steps(w, newest_first=True)
    return out.select("area", text("day").alias("day"), F.col("step").cast("bigint").alias("step"), text("time").alias("time"))


@query("t1_fixed_window", f"""
WITH {SQL_RUNS}, f AS (SELECT area, day, run, run + INTERVAL 5 HOUR AS e FROM runs),
g AS (SELECT area, day, CASE WHEN date_trunc('hour', run) = run THEN run ELSE date_trunc('hour', run) + INTERVAL 1 HOUR END AS s, date_trunc('hour', e) AS e FROM f)
SELECT area, CAST(day AS VARCHAR) AS day, CAST(greatest(s, e) AS VARCHAR) AS time_run, CAST(s AS VARCHAR) AS window_start, CAST(greatest(s, e) AS VARCHAR) AS window_end FROM g""")
def t1_fixed(t: Tables):
    r = _runs(t).withColumns({"fixed_start": F.col("run"), "fixed_end": F.col("run") + K.hours(5)})
    w = Z.run_window(r, 1, 0, snap_start="none", snap_end="none")
    return w.select("area", text("day").alias("day"), *[text(c).alias(c) for c in ("time_run", "window_start", "window_end")])


@query("t2_label_ranges", f"""
WITH {SQL_RUNS}, r AS (SELECT area, day, date_trunc('hour', run) AS run FROM runs)
SELECT area, CAST(day AS VARCHAR) AS day, 'Observed' AS label, CAST(run - to_hours(CAST(i AS INTEGER)) AS VARCHAR) AS time FROM r, range(0, 3) g(i)
UNION ALL
SELECT area, CAST(day AS VARCHAR), 'Forecast', CAST(run + to_hours(CAST(i AS INTEGER)) AS VARCHAR) FROM r, range(0, 2) g(i)""")
def t2(t: Tables):
    r = _runs(t).withColumn("run", K.hour_floor(F.col("run")))
    obs = Z.label_range(r, "Observed", 3).withColumn("label", F.lit("Observed"))
    frc = Z.label_range(r, "Forecast", 2).withColumn("label", F.lit("Forecast"))
    none = Z.label_range(r, "Forecast", 0).withColumn("label", F.lit("none"))
    return obs.unionByName(frc).unionByName(none).select("area", text("day").alias("day"), "label", text("time").alias("time"))


_BLOCKS = """
w AS (SELECT area, day, date_trunc('hour', run) AS time_run, {start} AS s0, {end} AS e0 FROM runs),
x AS (SELECT *, date_trunc('day', time_run) AS a FROM w),
y AS (SELECT area, day, time_run, a, {s} AS s, {e} AS e FROM x),
p AS (
  SELECT area, day, time_run, 'Observed' AS side, i, a - to_hours(CAST(i * {ob} - 1 AS INTEGER)) AS b, a - to_hours(CAST((i - 1) * {ob} AS INTEGER)) AS z, s, e FROM y, range(1, 9) g(i)
  UNION ALL
  SELECT area, day, time_run, 'Forecast', i, a + to_hours(CAST(1 + (i - 1) * {fc} AS INTEGER)), a + to_hours(CAST(i * {fc} AS INTEGER)), s, e FROM y, range(1, 9) g(i)),
c AS (SELECT area, day, time_run, side, i, greatest(b, s) AS b, least(z, e) AS z FROM p WHERE greatest(b, s) <= least(z, e)),
l AS (SELECT *, CASE WHEN b < time_run AND time_run < z THEN 'Observed_Forecast' ELSE side END AS ty, date_diff('hour', b, z) + 1 AS len FROM c)
SELECT area, CAST(day AS VARCHAR) AS day, ty AS period_type, side || '_' || lpad(CAST(i AS VARCHAR), 4, '0') || '_Period' AS period_tag, i AS period_id,
  CAST(b AS VARCHAR) AS time_start, CAST(z AS VARCHAR) AS time_end, CAST(CAST(b AS DATE) AS VARCHAR) AS time_key, CAST(time_run AS VARCHAR) AS time_pivot
FROM l {where}"""


def _period_rows(p):
    return p.select("area", text("day").alias("day"), "period_type", "period_tag", F.col("period_id").cast("bigint").alias("period_id"),
                    *[text(c).alias(c) for c in ("time_start", "time_end", "time_key", "time_pivot")])


_DROP = "WHERE NOT (ty = 'Observed' AND len < {ob}) AND NOT (ty = 'Forecast' AND len < {fc})"
_START, _END = "date_trunc('day', date_trunc('hour', run) - INTERVAL 35 HOUR)", "date_trunc('hour', run) + INTERVAL 30 HOUR"


@query("w3_period_blocks", f"WITH {SQL_RUNS}," + _BLOCKS.format(
    start=_START, end=_END, s="s0", e="e0", ob=24, fc=24, where=_DROP.format(ob=24, fc=24)))
def w3(t: Tables):
    return _period_rows(Z.period_blocks(Z.run_window(_runs(t), 36, 30, snap_end="none"), 24, 24))


@query("w3_partial_blocks_kept", f"WITH {SQL_RUNS}," + _BLOCKS.format(
    start=_START, end=_END, s="s0", e="e0", ob=12, fc=24, where=""))
def w3_partial(t: Tables):
    return _period_rows(Z.period_blocks(Z.run_window(_runs(t), 36, 30, snap_end="none"), 12, 24, drop_partial=False))


@query("w3_unique_observed", f"WITH {SQL_RUNS}," + _BLOCKS.format(
    start=_START, end=_END, s="a - INTERVAL 1 HOUR", e="greatest(e0, a)", ob=2, fc=24, where=_DROP.format(ob=2, fc=24)))
def w3_unique(t: Tables):
    return _period_rows(Z.period_blocks(Z.run_window(_runs(t), 36, 30, snap_end="none"), 2, 24, obs_partition="unique"))


@query("w4_mixed_labels", f"WITH {SQL_RUNS}," + _BLOCKS.format(
    start=_START, end=_END, s="s0", e="e0", ob=24, fc=24, where="WHERE ty = 'Observed_Forecast'"))
def w4(t: Tables):
    p = Z.period_blocks(Z.run_window(_runs(t), 36, 30, snap_end="none"), 24, 24)
    return _period_rows(p.filter("period_type = 'Observed_Forecast'"))


@query("w10_window_set", """
WITH c AS (SELECT p_size % 5 AS k FROM part),
s AS (SELECT 'left' AS side, (3 * (k + 1)) AS h FROM c UNION SELECT 'left', 24 FROM c UNION SELECT 'right', 6 FROM c UNION SELECT 'right', 24 FROM c
  UNION SELECT 'right', 3 * (k + 1) FROM c UNION SELECT 'left', 6 FROM c)
SELECT side, string_agg(CAST(h AS VARCHAR) || 'H', ',' ORDER BY h) AS windows FROM s GROUP BY side""")
def w10(t: Tables):
    out = Z.window_set(_config(t))
    return out.select("side", F.concat_ws(",", "windows").alias("windows"))


def _config(t: Tables):
    """Per part: left 3(k+1)H and 24H, right 6H and 24H, with k = p_size % 5."""
    own = F.concat((3 * (F.pmod("p_size", F.lit(5)) + 1)).cast("string"), F.lit("H"))
    return t.part.select(
        F.col("p_name").alias("area"), F.array(F.lit("Left"), F.lit("right")).alias("types"),
        F.array(F.array(own, F.lit("24H")), F.array(F.lit("6H"), F.lit("24H"))).alias("periods"))


@query("w11_search_period", """
SELECT 'left' AS side, '24H' AS longest, (SELECT CAST(3 * (MIN(p_size % 5) + 1) AS VARCHAR) || 'H' FROM part) AS shortest
UNION ALL SELECT 'right', '24H', '6H'""")
def w11(t: Tables):
    c = _config(t)
    hi = Z.search_period(c, "separate", "max").withColumnRenamed("search_period", "longest")
    return hi.join(Z.search_period(c, "separate", "min").withColumnRenamed("search_period", "shortest"), "side")


@query("w11_search_partition", """
SELECT side, mode AS search_partition FROM (SELECT DISTINCT 'left' AS side, 'unique' AS mode FROM part
UNION SELECT 'right', 'multiple' FROM part)""")
def w11_partition(t: Tables):
    c = t.part.select(F.array(F.lit("left"), F.lit("right")).alias("types"),
                        F.array(F.array(F.lit("unique")), F.array(F.lit("multiple"))).alias("periods"))
    return Z.search_partition(c)


@query("w12_search_range", f"""
WITH {SQL_RUNS}
SELECT area, CAST(date_trunc('hour', run) - INTERVAL 3 HOUR + to_hours(CAST(i AS INTEGER)) AS VARCHAR) AS time FROM runs, range(0, 6) g(i)""")
def w12(t: Tables):
    r = _runs(t).withColumn("run", K.hour_floor(F.col("run")))
    return Z.search_range(r, "3H", "120M").select("area", text("time").alias("time"))


@query("t3_fill_missing_days", f"""
WITH {SQL_AREA_DAYS}, d AS (SELECT area, time, value, CAST(n AS BIGINT) AS n, 'x' AS label, CAST(time AS VARCHAR) AS rain_time_run,
  CAST(time AS VARCHAR) || ' 01:00' AS rain_time_start, CAST(time AS VARCHAR) || ' 23:00' AS rain_time_end FROM area_days WHERE isodow(time) < 6),
b AS (SELECT area, MAX(time) AS hi FROM d GROUP BY area),
s AS (SELECT area, CAST(unnest(generate_series(TIMESTAMP '2023-12-28', CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS time FROM b)
SELECT s.area, CAST(s.time AS VARCHAR) AS time, COALESCE(value, -9999) AS value, COALESCE(n, -9999) AS n, COALESCE(label, 'NoData') AS label,
  COALESCE(rain_time_run, CAST(s.time AS VARCHAR)) AS rain_time_run, COALESCE(rain_time_start, CAST(s.time AS VARCHAR) || ' 01:00') AS rain_time_start,
  COALESCE(rain_time_end, CAST(CAST(s.time + INTERVAL 1 DAY AS DATE) AS VARCHAR) || ' 00:00') AS rain_time_end
FROM s LEFT JOIN d USING (area, time)""")
def t3(t: Tables):
    iso = F.col("time").cast("string")
    d = area_days(t).filter(F.weekday("time") < 5).select(
        "area", "time", "value", "n", F.lit("x").alias("label"), iso.alias("rain_time_run"),
        F.concat(iso, F.lit(" 01:00")).alias("rain_time_start"), F.concat(iso, F.lit(" 23:00")).alias("rain_time_end"))
    return Z.fill_missing_days(d, ["area"], start=F.lit("2023-12-28"))


@query("t4_expand_to_range", f"""
WITH {SQL_AREA_HOURS}, b AS (SELECT area, MAX(time) AS hi FROM area_hours GROUP BY area),
s AS (SELECT area, unnest(generate_series(TIMESTAMP '2024-01-02 00:00:00', hi, INTERVAL 1 HOUR)) AS time FROM b)
SELECT s.area, CAST(s.time AS VARCHAR) AS time, COALESCE(value, -9999) AS value, COALESCE(n, -9999) AS n FROM s LEFT JOIN area_hours USING (area, time)""")
def t4(t: Tables):
    out = Z.expand_to_range(area_hours(t), ["area"], K.ntz_lit("2024-01-02 00:00:00"), None, "h", fill={"value": -9999.0, "n": -9999})
    return out.withColumn("time", text("time"))


@query("t5_analysis_period", f"""
WITH {SQL_AREA_DAYS}
SELECT area, CAST(time AS VARCHAR) AS time, value FROM area_days WHERE time BETWEEN DATE '2024-01-07' AND DATE '2024-01-16'""")
def t5(t: Tables):
    bounds = Z.analysis_period(time_period=10, time_reference=datetime(2024, 1, 15, 14, 0))
    return Z.within_period(area_days(t), bounds).select("area", text("time").alias("time"), "value")


@query("t6_time_info", f"""
WITH {SQL_AREA_HOURS}, g AS (SELECT area, date_diff('hour', lag(time) OVER (PARTITION BY area ORDER BY time), time) AS d FROM area_hours),
c AS (SELECT area, d, COUNT(*) AS n FROM g WHERE d IS NOT NULL GROUP BY 1, 2),
m AS (SELECT area, d AS step_hours FROM c QUALIFY row_number() OVER (PARTITION BY area ORDER BY n DESC, d) = 1)
SELECT area, CAST(MIN(time) AS VARCHAR) AS time_start, CAST(MAX(time) AS VARCHAR) AS time_end, MAX(step_hours) AS step_hours
FROM area_hours JOIN m USING (area) GROUP BY area""")
def t6(t: Tables):
    out = Z.time_info(area_hours(t), ["area"])
    return out.withColumns({"time_start": text("time_start"), "time_end": text("time_end")})


@query("t7_require_time", """
SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS time FROM events""")
def t7(t: Tables):
    e = t.events.select("event_id", F.substring(F.col("ts").cast("string"), 1, 19).alias("time"))
    return Z.require_time(e).withColumn("time", text("time"))


@query("p19_calendar_parts", """
SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS time, year(o_orderdate) AS year, month(o_orderdate) AS month,
  day(o_orderdate) AS day, dayofyear(o_orderdate) AS day_of_the_year FROM orders""")
def p19(t: Tables):
    d = t.orders.select(F.col("o_orderdate").cast("date").alias("time")).distinct()
    return d.select(text("time").alias("time"), *[v.cast("bigint").alias(k) for k, v in K.calendar_parts(F.col("time")).items()])


@query("p20_dmy_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders""")
def p20(t: Tables):
    raw = F.when(F.pmod("o_orderkey", F.lit(11)) == 0, F.lit("31/02/20x4")).otherwise(
        F.concat(F.lpad(F.dayofmonth("o_orderdate").cast("string"), 2, "0"), F.lit("/"),
                 F.lpad(F.month("o_orderdate").cast("string"), 2, "0"), F.lit("/"), F.year("o_orderdate").cast("string")))
    return t.orders.select("o_orderkey", K.parse_dmy(raw).alias("iso"))


@query("p21_period_text", """
SELECT p_partkey, CAST(p_size * CASE p_partkey % 4 WHEN 0 THEN 60 WHEN 1 THEN 3600 WHEN 2 THEN 86400 ELSE 0 END AS BIGINT) AS seconds,
  CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE p_size * 24 END AS BIGINT) AS hours FROM part""")
def p21(t: Tables):
    unit = F.element_at(F.array(F.lit("M"), F.lit("h"), F.lit("D"), F.lit("W")), F.pmod("p_partkey", F.lit(4)).cast("int") + 1)
    size = F.col("p_size").cast("string")
    side = F.when(F.pmod("p_partkey", F.lit(2)) == 0, F.concat(size, F.lit("H"))).otherwise(F.concat(size, F.lit("d")))
    return t.part.select("p_partkey", K.period_seconds(F.concat(size, unit)).alias("seconds"), K.window_hours(side).alias("hours"))


@query("p24_zone_convert", """
SELECT event_id, strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M') AS local FROM events""")
def p24(t: Tables):
    return t.events.select("event_id", K.compact_minute(K.shift_zone(F.col("ts"), "UTC", "Europe/Rome")).alias("local"))
