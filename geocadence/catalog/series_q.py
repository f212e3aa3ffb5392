"""Series queries: A2-A4, W1, W2, W5-W9, P11, P28."""

from __future__ import annotations

from pyspark.sql import functions as F

from geocadence.catalog.registry import (
    SQL_AREA_DAYS, SQL_AREA_HOURS, SQL_CELL_HOURS, Tables, area_days, area_hours, big, cell_hours, query, r6, text,
)
from geocadence.functions.times import hours, minute_floor
from geocadence.operators import series as S
from geocadence.operators.project import display_values, drop_invalid


@query("a2_area_mean", f"""
WITH {SQL_CELL_HOURS}
SELECT area, CAST(time AS VARCHAR) AS time, round(AVG(value) + 1e-9, 6) AS value, COUNT(*) AS cells
FROM cell_hours GROUP BY area, time""")
def a2(t: Tables):
    c = cell_hours(t)
    mean = S.area_mean(c, ["area", "time"])
    n = c.groupBy("area", "time").agg(F.count(F.lit(1)).alias("cells"))
    return mean.join(n, ["area", "time"]).select("area", text("time").alias("time"), r6("value").alias("value"), "cells")


def _frames(widths, fn, part):
    return ",\n".join(
        f"CASE WHEN COUNT(value) OVER w{n} = {n} THEN round({fn}(value) OVER w{n} + 1e-9, 6) END AS r{n}" for n in widths
    ), ",\n".join(
        f"w{n} AS (PARTITION BY {part} ORDER BY time RANGE BETWEEN INTERVAL {n - 1} HOUR PRECEDING AND CURRENT ROW)" for n in widths)


_s, _w = _frames((3, 6, 12, 24), "SUM", "area, cell")


@query("w1_rolling_cell_sum", f"""
WITH {SQL_CELL_HOURS}
SELECT area, cell, CAST(time AS VARCHAR) AS time, {_s} FROM cell_hours WINDOW {_w}""")
def w1(t: Tables):
    out = S.rolling_exact(cell_hours(t), ["area", "cell"], (3, 6, 12, 24), prefix="r")
    return out.select("area", "cell", text("time").alias("time"), *[r6(f"r_{n}").alias(f"r{n}") for n in (3, 6, 12, 24)])


@query("w1_rolling_cell_sum_left", f"""
WITH {SQL_CELL_HOURS}
SELECT area, cell, CAST(time AS VARCHAR) AS time,
  CASE WHEN COUNT(value) OVER w = 3 THEN round(SUM(value) OVER w + 1e-9, 6) END AS r3
FROM cell_hours WINDOW w AS (PARTITION BY area, cell ORDER BY time RANGE BETWEEN CURRENT ROW AND INTERVAL 2 HOUR FOLLOWING)""")
def w1_left(t: Tables):
    out = S.rolling_exact(cell_hours(t), ["area", "cell"], (3,), direction="left", prefix="r")
    return out.select("area", "cell", text("time").alias("time"), r6("r_3").alias("r3"))


_m, _mw = _frames((3, 6, 12, 24), "AVG", "area")
_a, _aw = _frames((3, 6, 12, 24), "SUM", "area")


@query("w2_rolling_area_mean", f"""
WITH {SQL_AREA_HOURS}, r AS (SELECT area, CAST(time AS VARCHAR) AS time, {_m} FROM area_hours WINDOW {_mw})
SELECT * FROM r WHERE r3 IS NOT NULL""")
def w2_mean(t: Tables):
    out = S.rolling_exact(area_hours(t), ["area"], (3, 6, 12, 24), how="mean", prefix="r")
    return out.filter("r_3 IS NOT NULL").select("area", text("time").alias("time"), *[r6(f"r_{n}").alias(f"r{n}") for n in (3, 6, 12, 24)])


@query("w2_rolling_area_sum", f"""
WITH {SQL_AREA_HOURS}, r AS (SELECT area, CAST(time AS VARCHAR) AS time, {_a} FROM area_hours WINDOW {_aw})
SELECT * FROM r WHERE r3 IS NOT NULL""")
def w2_sum(t: Tables):
    out = S.rolling_exact(area_hours(t), ["area"], (3, 6, 12, 24), prefix="r")
    return out.filter("r_3 IS NOT NULL").select("area", text("time").alias("time"), *[r6(f"r_{n}").alias(f"r{n}") for n in (3, 6, 12, 24)])


# circles of the demonstration: cells {0,1,2} and {2,3}
_CIRCLES = [(0, 0), (0, 1), (0, 2), (1, 2), (1, 3)]
_CIRCLES_SQL = "circles(point_id, cell) AS (VALUES (0, 0), (0, 1), (0, 2), (1, 2), (1, 3))"


def _circle_rows(t: Tables):
    circles = t.spark.createDataFrame(_CIRCLES, "point_id int, cell int")
    rolled = S.rolling_exact(cell_hours(t), ["area", "cell"], (3,), prefix="r").withColumn("day", F.col("time").cast("date"))
    return S.circle_maxima(rolled.join(circles, "cell"), ["area", "day", "time"], ["r_3"])


_CIRCLE_CTE = f"""WITH {SQL_CELL_HOURS}, {_CIRCLES_SQL},
r AS (SELECT area, cell, time, CASE WHEN COUNT(value) OVER w = 3 THEN SUM(value) OVER w END AS v FROM cell_hours
  WINDOW w AS (PARTITION BY area, cell ORDER BY time RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW)),
m AS (SELECT area, CAST(time AS DATE) AS day, time, point_id, MAX(v) AS v FROM r JOIN circles USING (cell) GROUP BY ALL)"""


@query("a3_circle_peaks", f"""{_CIRCLE_CTE}
SELECT area, CAST(day AS VARCHAR) AS day, round(MAX(v) + 1e-9, 6) AS peak_max, round(AVG(v) + 1e-9, 6) AS peak_avg FROM m GROUP BY area, day""")
def a3(t: Tables):
    out = S.peak_metrics(_circle_rows(t), ["area", "day"], ["r_3"], ["peak"])
    return out.select("area", text("day").alias("day"), r6("`peak:max`").alias("peak_max"), r6("`peak:avg`").alias("peak_avg"))


@query("a3_circle_peaks_strict", f"""{_CIRCLE_CTE},
k AS (SELECT area, day, time, COUNT(v) AS n, COUNT(*) AS al, MAX(v) AS mx, SUM(v) AS sm FROM m GROUP BY ALL)
SELECT area, CAST(day AS VARCHAR) AS day,
  CASE WHEN COUNT(*) FILTER (n > 0 AND n < al) = 0 THEN round(MAX(mx) + 1e-9, 6) END AS peak_max,
  CASE WHEN COUNT(*) FILTER (n > 0 AND n < al) = 0 THEN round(SUM(sm) / SUM(n) FILTER (n > 0) + 1e-9, 6) END AS peak_avg
FROM k GROUP BY area, day""")
def a3_strict(t: Tables):
    out = S.peak_metrics(_circle_rows(t), ["area", "day"], ["r_3"], ["peak"], strict=True)
    return out.select("area", text("day").alias("day"), r6("`peak:max`").alias("peak_max"), r6("`peak:avg`").alias("peak_avg"))


@query("a4_series_metrics", f"""
WITH {SQL_AREA_HOURS}
SELECT area, CAST(CAST(time - INTERVAL 1 HOUR AS DATE) AS VARCHAR) AS day, round(AVG(value) + 1e-9, 6) AS "v:avg",
  MAX(value) AS "v:max", MIN(value) AS "v:min", arg_min(value, time) AS "v:first", arg_max(value, time) AS "v:last"
FROM area_hours GROUP BY 1, 2""")
def a4(t: Tables):
    s = area_hours(t).withColumn("day", (F.col("time") - hours(1)).cast("date"))
    out = S.series_metrics(s, ["area", "day"], "value", ("avg", "max", "min", "first", "last", "mode"), name="v")
    return out.withColumn("day", text("day")).withColumn("v:avg", r6("`v:avg`"))


def _typed_days(t: Tables):
    """Daily rows with period types that depend on the counts: some rain, some soil-moisture rows are mixed."""
    d = area_days(t)
    return d.select(
        "area", "time", F.col("value").alias("rain_peak_3H"), F.col("n").alias("sm_value_first"),
        F.when(F.pmod("n", F.lit(3)) == 0, "Observed_Forecast").otherwise("Observed").alias("rain_period_type"),
        F.when(F.pmod("n", F.lit(5)) == 0, "Observed_Forecast").when(F.pmod("n", F.lit(5)) == 1, "Forecast")
        .otherwise("Observed").alias("sm_period_type"))


SQL_TYPED_DAYS = f"""{SQL_AREA_DAYS},
typed AS (SELECT area, time, value AS rain_peak_3H, n AS sm_value_first,
  CASE WHEN n % 3 = 0 THEN 'Observed_Forecast' ELSE 'Observed' END AS rain_period_type,
  CASE WHEN n % 5 = 0 THEN 'Observed_Forecast' WHEN n % 5 = 1 THEN 'Forecast' ELSE 'Observed' END AS sm_period_type
  FROM area_days),
kept AS (SELECT area, MAX(time) AS k, MIN(time) AS k0 FROM typed
  WHERE rain_period_type = 'Observed_Forecast' OR sm_period_type = 'Observed_Forecast' GROUP BY area),
marked AS (SELECT t.*, (rain_period_type = 'Observed_Forecast' OR sm_period_type = 'Observed_Forecast') AND time <> k AS drop_it,
  (rain_period_type = 'Observed_Forecast' OR sm_period_type = 'Observed_Forecast') AND time <> k0 AS drop_first
  FROM typed t LEFT JOIN kept USING (area))"""


@query("w5_keep_last_mixed", f"""
WITH {SQL_TYPED_DAYS}
SELECT area, CAST(time AS VARCHAR) AS time, CASE WHEN drop_it THEN -9999 ELSE rain_peak_3H END AS rain_peak_3H,
  CAST(CASE WHEN drop_it THEN -9999 ELSE sm_value_first END AS BIGINT) AS sm_value_first,
  CASE WHEN drop_it THEN 'NoData' ELSE rain_period_type END AS rain_period_type,
  CASE WHEN drop_it THEN 'NoData' ELSE sm_period_type END AS sm_period_type FROM marked""")
def w5(t: Tables):
    return S.keep_one_mixed(_typed_days(t), ["area"], ["rain_period_type", "sm_period_type"]).withColumn("time", text("time"))


@query("p28_marked_rows", f"""
WITH {SQL_TYPED_DAYS}
SELECT area, CAST(time AS VARCHAR) AS time, CASE WHEN sm_value_first % 7 = 0 THEN -9999 ELSE rain_peak_3H END AS rain_peak_3H,
  CAST(CASE WHEN sm_value_first % 7 = 0 THEN -9999 ELSE sm_value_first END AS BIGINT) AS sm_value_first,
  CASE WHEN sm_value_first % 7 = 0 THEN 'NoData' ELSE rain_period_type END AS rain_period_type,
  CASE WHEN sm_value_first % 7 = 0 THEN 'NoData' ELSE sm_period_type END AS sm_period_type FROM typed""")
def p28(t: Tables):
    d = _typed_days(t)
    return S.null_rows(d, F.pmod("sm_value_first", F.lit(7)) == 0, ["area", "time"]).withColumn("time", text("time"))


@query("p8_drop_invalid", f"""
WITH {SQL_TYPED_DAYS}
SELECT area, CAST(time AS VARCHAR) AS time, rain_peak_3H, CAST(sm_value_first AS BIGINT) AS sm_value_first, rain_period_type, sm_period_type
FROM marked WHERE NOT drop_it""")
def p8(t: Tables):
    marked = S.keep_one_mixed(_typed_days(t), ["area"], ["rain_period_type", "sm_period_type"])
    return drop_invalid(marked).withColumn("time", text("time"))


@query("w5_keep_first_mixed", f"""
WITH {SQL_TYPED_DAYS}
SELECT area, CAST(time AS VARCHAR) AS time, rain_peak_3H, CAST(sm_value_first AS BIGINT) AS sm_value_first FROM marked WHERE NOT drop_first""")
def w5_first(t: Tables):
    marked = S.keep_one_mixed(_typed_days(t), ["area"], ["rain_period_type", "sm_period_type"], keep="first")
    return drop_invalid(marked).select("area", text("time").alias("time"), "rain_peak_3H", "sm_value_first")


@query("w7_duplicate_times", """
SELECT event_type AS area, CAST(date_trunc('hour', ts) AS VARCHAR) AS time, COUNT(*) AS n FROM events GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def w7(t: Tables):
    from geocadence.functions.times import hour_floor
    e = t.events.select(F.col("event_type").alias("area"), hour_floor(F.col("ts")).alias("time"))
    return S.duplicate_times(e, ["area"]).withColumn("time", text("time"))


@query("w8_thin_greedy", """
WITH RECURSIVE f AS (
  SELECT event_type AS area, CAST(ts AS DATE) AS day, date_trunc('minute', ts) AS time, MIN('f_' || lpad(CAST(event_id AS VARCHAR), 9, '0')) AS path
  FROM events GROUP BY 1, 2, 3),
walk AS (
  SELECT area, day, MIN(time) AS time FROM f GROUP BY area, day
  UNION ALL
  SELECT area, day, time FROM (
    SELECT w.area, w.day, MIN(f.time) AS time FROM walk w JOIN f ON f.area = w.area AND f.day = w.day AND f.time >= w.time + INTERVAL 90 MINUTE
    GROUP BY w.area, w.day))
SELECT w.area, CAST(w.day AS VARCHAR) AS day, CAST(w.time AS VARCHAR) AS time, f.path FROM walk w JOIN f USING (area, day, time)""")
def w8(t: Tables):
    files = t.events.select(
        F.col("event_type").alias("area"), F.col("ts").cast("date").alias("day"), minute_floor(F.col("ts")).alias("time"),
        F.concat(F.lit("f_"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("path"))
    return S.thin_by_minutes(files, ["area", "day"], 90).select("area", text("day").alias("day"), text("time").alias("time"), "path")


@query("w9_first_forecast", f"""
WITH {SQL_TYPED_DAYS},
m AS (SELECT area, MIN(time) FILTER (rain_period_type IN ('Forecast', 'Observed_Forecast')) AS r,
  MIN(time) FILTER (sm_period_type IN ('Forecast', 'Observed_Forecast')) AS s FROM typed GROUP BY area)
SELECT area, CAST(r AS VARCHAR) AS rain_marker, CAST(s AS VARCHAR) AS sm_marker, r IS NOT DISTINCT FROM s AS agrees FROM m""")
def w9(t: Tables):
    out = S.first_forecast(_typed_days(t), ["area"])
    return out.withColumns({"rain_marker": text("rain_marker"), "sm_marker": text("sm_marker")})


@query("p11_display_values", f"""
WITH {SQL_AREA_DAYS}, d AS (SELECT area, time, n - 65 AS n, value FROM area_days)
SELECT area, CAST(time AS VARCHAR) AS time, CASE WHEN n >= 0 THEN n END AS n, CASE WHEN value BETWEEN 2000 AND 4000 THEN value END AS value FROM d""")
def p11(t: Tables):
    d = area_days(t).withColumn("n", F.col("n") - 65)
    return display_values(d, ["n"], {"value": (2000.0, 4000.0)}).withColumn("time", text("time"))
