"""Scenario queries: A7-A9, A11, J4-J7, J18, U1-U4, U7, W6."""

from __future__ import annotations

from pyspark.sql import functions as F

from geocadence.catalog.registry import (
    AREAS, SQL_AREA_DAYS, SQL_AREA_HOURS, SQL_SLIP_POINTS, Tables, area_days, area_hours, query, slip_points, text,
)
from geocadence.functions.times import hour_floor, hours
from geocadence.operators import scenario as S


def _run_rows(t: Tables):
    """Hourly rows of several runs: run r holds what the events with event_id % 5 = r say about an hour."""
    e = t.events.select(F.col("event_type").alias("area"), hour_floor(F.col("ts")).alias("time"),
                        F.pmod("event_id", F.lit(5)).alias("r"), F.round(F.col("value") * 100).cast("bigint").alias("c"))
    return e.groupBy("area", "time", "r").agg((F.sum("c") / 100.0).alias("value")).select(
        "area", "time", (F.lit("2024-02-01 00:00:00").cast("timestamp_ntz") + hours(F.col("r"))).alias("run_time"), "value")


SQL_RUN_ROWS = """run_rows AS (
  SELECT event_type AS area, date_trunc('hour', ts) AS time, TIMESTAMP '2024-02-01 00:00:00' + to_hours(CAST(event_id % 5 AS INTEGER)) AS run_time,
    SUM(CAST(round(value * 100) AS BIGINT)) / 100.0 AS value FROM events GROUP BY 1, 2, 3)"""


@query("j4_spine_merge", f"""
WITH {SQL_AREA_DAYS}, {SQL_AREA_HOURS}, s AS (SELECT area, CAST(unnest(generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-01', INTERVAL 1 DAY)) AS DATE) AS time FROM (SELECT DISTINCT area FROM area_days)),
rain AS (SELECT area, time, value FROM area_days WHERE isodow(time) <> 7),
sm AS (SELECT area, CAST(time AS DATE) AS time, MAX(value) AS value, COUNT(*) AS hours FROM area_hours GROUP BY 1, 2),
slips AS (SELECT area, time, n AS value, 'x' AS hours FROM area_days WHERE isodow(time) < 4)
SELECT s.area, CAST(s.time AS VARCHAR) AS time, rain.value AS value, sm.value AS sm_value, sm.hours AS hours, CAST(slips.value AS BIGINT) AS slips_value, slips.hours AS slips_hours, s.area AS domain
FROM s LEFT JOIN rain USING (area, time) LEFT JOIN sm USING (area, time) LEFT JOIN slips USING (area, time)""")
def j4(t: Tables):
    days = area_days(t)
    spine = days.select("area").distinct().select("area", F.explode(F.sequence(
        F.lit("2023-12-30").cast("date"), F.lit("2024-02-01").cast("date"))).alias("time"))
    rain = days.filter(F.weekday("time") != 6).select("area", "time", "value")
    sm = area_hours(t).groupBy("area", F.col("time").cast("date").alias("time")).agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("hours"))
    slips = days.filter(F.weekday("time") < 3).select("area", "time", F.col("n").alias("value"), F.lit("x").alias("hours"))
    out = S.merge_on_spine(spine, [("rain", rain), ("sm", sm), ("slips", slips)], ["area", "time"], required=("rain", "sm"))
    return out.withColumn("time", text("time"))


@query("j5_common_times", f"""
WITH {SQL_RUN_ROWS}, a AS (SELECT DISTINCT area, time FROM run_rows WHERE hour(run_time) % 2 = 0), b AS (SELECT DISTINCT area, time FROM run_rows WHERE hour(run_time) % 2 = 1)
SELECT 'rain' AS side, a.area, CAST(a.time AS VARCHAR) AS time FROM a JOIN b USING (area, time)
UNION ALL SELECT 'sm', b.area, CAST(b.time AS VARCHAR) FROM b JOIN a USING (area, time)""")
def j5(t: Tables):
    r = _run_rows(t)
    sides = [r.filter(F.hour("run_time") % 2 == side).select("area", "time").distinct() for side in (0, 1)]
    a, b = S.keep_common_times(*sides, ["area", "time"])
    pick = lambda d, s: d.select(F.lit(s).alias("side"), "area", text("time").alias("time"))
    return pick(a, "rain").unionByName(pick(b, "sm"))


@query("j6_newest_run_wins", f"""
WITH {SQL_RUN_ROWS}, w AS (SELECT * FROM run_rows QUALIFY row_number() OVER (PARTITION BY area, time ORDER BY run_time DESC) = 1),
x AS (SELECT area, MAX(run_time) AS mx FROM w GROUP BY area)
SELECT area, CAST(time AS VARCHAR) AS time, CAST(run_time AS VARCHAR) AS run_time, value, CASE WHEN run_time = mx THEN 'latest' ELSE 'db' END AS latest_from FROM w JOIN x USING (area)""")
def j6(t: Tables):
    out = S.newest_run_wins(_run_rows(t), ["area", "time"])
    return out.withColumns({"time": text("time"), "run_time": text("run_time")})


@query("w6_newest_row_number", f"""
WITH {SQL_RUN_ROWS} SELECT area, CAST(time AS VARCHAR) AS time, CAST(MAX(run_time) AS VARCHAR) AS run_time, arg_max(value, run_time) AS value FROM run_rows GROUP BY area, time""")
def w6(t: Tables):
    out = S.newest_run_wins(_run_rows(t), ["area", "time"], tag=None)
    return out.withColumns({"time": text("time"), "run_time": text("run_time")})


@query("j6_append_missing", f"""
WITH {SQL_RUN_ROWS}, n AS (SELECT *, hour(run_time) % 2 AS side FROM run_rows QUALIFY row_number() OVER (PARTITION BY area, time, hour(run_time) % 2 ORDER BY run_time DESC) = 1),
a AS (SELECT * FROM n WHERE side = 0), b AS (SELECT * FROM n WHERE side = 1)
SELECT area, CAST(time AS VARCHAR) AS time, value, 'latest' AS latest_from FROM a
UNION ALL SELECT area, CAST(time AS VARCHAR), value, 'db' FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.area = b.area AND a.time = b.time)""")
def j6_append(t: Tables):
    r = _run_rows(t)
    base, step = (S.newest_run_wins(r.filter(F.hour("run_time") % 2 == side), ["area", "time"], tag=None) for side in (0, 1))
    out = S.append_missing(base, step, ["area", "time"])
    return out.select("area", text("time").alias("time"), "value", "latest_from")


@query("j7_time_intersection", f"""
WITH {SQL_RUN_ROWS} SELECT area, CAST(time AS VARCHAR) AS time FROM run_rows GROUP BY area, time HAVING COUNT(DISTINCT hour(run_time)) = 5""")
def j7(t: Tables):
    r = _run_rows(t)
    out = S.common_times([r.filter(F.hour("run_time") == k) for k in range(5)], ["area", "time"])
    return out.withColumn("time", text("time")).orderBy(F.desc("time"))


def _inventories(t: Tables):
    """Runs of each source: rain, soil moisture and slips files named by events of the hour."""
    e = t.events.select(F.col("event_type").alias("area"), hour_floor(F.col("ts")).alias("run_time"), "value")
    high = F.col("value") > 17
    return e.filter(high), e.filter(~high), e


@query("j18_best_run_per_day", """
WITH e AS (SELECT event_type AS area, date_trunc('hour', ts) AS run_time, value FROM events),
r AS (SELECT DISTINCT area, run_time FROM e WHERE value > 17), s AS (SELECT DISTINCT area, run_time FROM e WHERE value <= 17)
SELECT area, CAST(CAST(run_time AS DATE) AS VARCHAR) AS day, CAST(MAX(run_time) AS VARCHAR) AS run_time FROM r JOIN s USING (area, run_time)
WHERE run_time <= TIMESTAMP '2024-01-20 13:00:00' GROUP BY area, CAST(run_time AS DATE)""")
def j18(t: Tables):
    rain, sm, slips = _inventories(t)
    out = S.best_run_per_day(rain, sm, slips, F.lit("2024-01-20 13:00:00").cast("timestamp_ntz"))
    return out.withColumns({"day": text("day"), "run_time": text("run_time")})


_COVER = f"""{SQL_RUN_ROWS}, src AS (SELECT DISTINCT area, CASE hour(run_time) WHEN 0 THEN 'rain' WHEN 1 THEN 'sm' ELSE 'slips' END AS source, time FROM run_rows),
sp AS (SELECT area, source, MIN(time) AS lo, MAX(time) AS hi FROM src GROUP BY 1, 2), w AS (SELECT area, MAX(lo) AS ws, MIN(hi) AS we FROM sp GROUP BY 1)"""


def _sources(t: Tables):
    r = _run_rows(t)
    kind = F.least(F.hour("run_time"), F.lit(2))  # the first run, the second, all later ones
    return [(n, r.filter(kind == k).select("area", "time")) for k, n in enumerate(("rain", "sm", "slips"))]


@query("a7_coverage", f"""
WITH {_COVER}, f AS (SELECT area, source, COUNT(*) AS found FROM src JOIN w USING (area) WHERE time BETWEEN ws AND we GROUP BY 1, 2)
SELECT area, source, CAST(ws AS VARCHAR) AS window_start, CAST(we AS VARCHAR) AS window_end, date_diff('hour', ws, we) + 1 AS expected, found,
  round(found / (date_diff('hour', ws, we) + 1) * 100, 2) AS percent FROM w JOIN f USING (area)""")
def a7(t: Tables):
    out = S.coverage(_sources(t), ["area"], "h")
    return out.withColumns({"window_start": text("window_start"), "window_end": text("window_end")})


@query("a7_missing_steps", f"""
WITH {_COVER}, sp2 AS (SELECT area, source, unnest(generate_series(ws, we, INTERVAL 1 HOUR)) AS time FROM w, (VALUES ('rain'), ('sm'), ('slips')) v(source))
SELECT area, source, CAST(time AS VARCHAR) AS time FROM sp2 WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.area = sp2.area AND src.source = sp2.source AND src.time = sp2.time)""")
def a7_missing(t: Tables):
    from functools import reduce
    src = _sources(t)
    cov = S.coverage(src, ["area"], "h")
    spine = cov.select("area", "source", F.explode(F.sequence("window_start", "window_end", hours(1))).alias("time"))
    data = reduce(lambda a, b: a.unionByName(b), [d.withColumn("source", F.lit(n)) for n, d in src])
    return S.missing_steps(spine, data, ["area", "source", "time"]).withColumn("time", text("time"))


@query("a8_newest_oldest_tag", f"""
WITH {SQL_RUN_ROWS} SELECT area, CAST(MAX(time) AS VARCHAR) AS newest, CAST(MIN(time) AS VARCHAR) AS oldest FROM run_rows GROUP BY area""")
def a8(t: Tables):
    r = _run_rows(t)
    new = S.summary_tag(r, ["area"], "time", "newest").withColumnRenamed("time", "newest")
    old = S.summary_tag(r, ["area"], "time", "oldest").withColumnRenamed("time", "oldest")
    return new.join(old, "area").withColumns({"newest": text("newest"), "oldest": text("oldest")})


@query("a9_single_pivot", f"""
WITH {SQL_RUN_ROWS}, p AS (SELECT area, MAX(run_time) AS run_time FROM run_rows GROUP BY area)
SELECT CAST(MIN(run_time) AS VARCHAR) AS run_time, COUNT(DISTINCT run_time) AS distinct_values FROM p""")
def a9(t: Tables):
    pivots = _run_rows(t).groupBy("area").agg(F.max("run_time").alias("run_time"))
    return S.require_single(pivots, "run_time").withColumn("run_time", text("run_time"))


@query("a11_expected_values", """
SELECT o_custkey, MIN(c_nationkey) AS c_nationkey, COUNT(DISTINCT c_nationkey) AS distinct_values FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def a11(t: Tables):
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_custkey", "c_nationkey")
    return S.require_single(d, "c_nationkey", 1, ["o_custkey"])


@query("u1_stack_tables", f"""
WITH {SQL_AREA_DAYS} SELECT area, CAST(time AS VARCHAR) AS time, value, n FROM area_days""")
def u1(t: Tables):
    d = area_days(t)
    out = None
    for area in AREAS:
        out = S.stack_tables(out, d.filter(F.substring_index("area", "_", 1) == area))
    return S.stack_tables(out, None).withColumn("time", text("time"))


@query("u3_time_sets", f"""
WITH {SQL_RUN_ROWS}, a AS (SELECT DISTINCT area, time FROM run_rows WHERE hour(run_time) % 2 = 0), b AS (SELECT DISTINCT area, time FROM run_rows WHERE hour(run_time) % 2 = 1)
SELECT 'union' AS how, area, CAST(time AS VARCHAR) AS time FROM (SELECT * FROM a UNION SELECT * FROM b)
UNION ALL SELECT 'intersection', area, CAST(time AS VARCHAR) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
UNION ALL SELECT 'difference', area, CAST(time AS VARCHAR) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def u3(t: Tables):
    from functools import reduce
    r = _run_rows(t)
    a, b = r.filter(F.hour("run_time") % 2 == 0), r.filter(F.hour("run_time") % 2 == 1)
    parts = [S.time_set(a, b, ["area", "time"], how).withColumn("how", F.lit(how)) for how in ("union", "intersection", "difference")]
    return reduce(lambda x, y: x.unionByName(y), parts).withColumn("time", text("time"))


@query("u4_ordered_counts", f"""
WITH {SQL_SLIP_POINTS} SELECT alert_area_code, year(time) AS year, month(time) AS month, day(time) AS day, COUNT(*) AS soil_slips FROM slip_points GROUP BY ALL""")
def u4(t: Tables):
    out = slip_points(t).groupBy("alert_area_code", F.year("time").cast("bigint").alias("year"), F.month("time").cast("bigint").alias("month"),
                                 F.dayofmonth("time").cast("bigint").alias("day")).agg(F.count(F.lit(1)).alias("soil_slips"))
    return out.orderBy("year", "month", "day", "alert_area_code")


@query("u7_stacked_series", f"""
WITH {SQL_AREA_HOURS} SELECT area, CAST(time AS VARCHAR) AS time, 'count' AS name, CAST(n AS DOUBLE) AS value FROM area_hours
UNION ALL SELECT area, CAST(time AS VARCHAR), 'rain', CAST(value AS DOUBLE) FROM area_hours""")
def u7(t: Tables):
    d = area_hours(t).select("area", text("time").alias("time"), F.col("value").alias("rain"), F.col("n").cast("double").alias("count"))
    return S.stack_series(d, ["area", "time"], ["rain", "count", "absent"])


