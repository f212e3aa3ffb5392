"""Streaming queries R1-R5 over the events table as a file stream; each must equal its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from geocadence.catalog.registry import Tables, big, query, r6, text
from geocadence.functions.times import hour_floor
from geocadence.session import scratch
from geocadence.streaming import jobs as J

LATE = "3 hours"


def _stream(t: Tables):
    s = J.file_stream(t.spark, t.folder, "events.parquet", t.events.schema)
    return s.withColumn("area", F.col("event_type"))


_HOURS = """h AS (SELECT event_type AS area, date_trunc('hour', ts) AS time, AVG(value) AS value, COUNT(*) AS n FROM events GROUP BY 1, 2),
wm AS (SELECT MAX(ts) - INTERVAL 3 HOUR AS m FROM events), f AS (SELECT h.* FROM h, wm WHERE time + INTERVAL 1 HOUR <= m)"""


@query("r1_hourly_means", f"WITH {_HOURS} SELECT area, CAST(time AS VARCHAR) AS time, round(value + 1e-9, 6) AS value, n FROM f")
def r1(t: Tables):
    out, cp = scratch(t.spark, "r1"), scratch(t.spark, "r1-cp")
    J.run_hourly_means(_stream(t), LATE, out, cp)
    return t.spark.read.parquet(out).select("area", text("time").alias("time"), r6("value").alias("value"), "n")


@query("r2_sliding_sums", f"""
WITH {_HOURS.replace("AVG(value)", "AVG(CASE WHEN hour(ts) % 5 <> 0 THEN value END)")}, w AS (SELECT area, time, CASE WHEN COUNT(value) OVER w = 3 THEN SUM(value) OVER w END AS value FROM h
  WINDOW w AS (PARTITION BY area ORDER BY time RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW))
SELECT area, CAST(time AS VARCHAR) AS time, round(value + 1e-9, 6) AS value FROM w, wm WHERE value IS NOT NULL AND time + INTERVAL 1 HOUR <= m""")
def r2(t: Tables):
    out, cp = scratch(t.spark, "r2"), scratch(t.spark, "r2-cp")
    t.spark.conf.set(*J.STATE_STORE)
    readings = _stream(t).withColumn("value", F.when(F.hour("ts") % 5 != 0, F.col("value")))  # some hours have none
    J.run_sliding_sums(readings, LATE, 3, out, cp)
    return t.spark.read.parquet(out).select("area", text("time").alias("time"), r6("value").alias("value"))


_WIDTHS = [3, 6, 12, 24]


@query("r2_sliding_sums_widths", f"""
WITH {_HOURS}, w AS (SELECT area, time, """ + ", ".join(f"CASE WHEN COUNT(value) OVER w{n} = {n} THEN SUM(value) OVER w{n} END AS v{n}" for n in _WIDTHS) + """ FROM h
  WINDOW """ + ", ".join(f"w{n} AS (PARTITION BY area ORDER BY time RANGE BETWEEN INTERVAL {n - 1} HOUR PRECEDING AND CURRENT ROW)" for n in _WIDTHS) + """)
SELECT area, CAST(time AS VARCHAR) AS time, """ + ", ".join(f'round(v{n} + 1e-9, 6) AS "value_{n}H"' for n in _WIDTHS) + """ FROM w, wm WHERE v3 IS NOT NULL AND time + INTERVAL 1 HOUR <= m""")
def r2_widths(t: Tables):
    out, cp = scratch(t.spark, "r2"), scratch(t.spark, "r2-cp")
    t.spark.conf.set(*J.STATE_STORE)
    J.run_sliding_sums(_stream(t), LATE, _WIDTHS, out, cp)
    return t.spark.read.parquet(out).select("area", text("time").alias("time"), *[r6(f"value_{n}H").alias(f"value_{n}H") for n in _WIDTHS])


@query("r3_newest_rows", """
SELECT event_type AS area, CAST(date_trunc('hour', ts) AS VARCHAR) AS time, arg_max(value, {'a': event_id % 5, 'b': event_id}) AS value, MAX(event_id % 5) AS run FROM events GROUP BY 1, 2""")
def r3(t: Tables):
    out, cp = scratch(t.spark, "r3"), scratch(t.spark, "r3-cp")
    rows = _stream(t).select("area", hour_floor(F.col("ts")).alias("time"), F.pmod("event_id", F.lit(5)).alias("run"), "event_id", "value")
    J.run_newest_rows(rows, ["area", "time"], ["run", "event_id"], out, cp, "time", LATE)
    got = J.read_newest_rows(t.spark, out)
    return got.select("area", text("time").alias("time"), "value", "run")


@query("r4_level_changes", f"""
WITH {_HOURS}, l AS (SELECT area, time, CASE WHEN n = 0 THEN 0 WHEN n <= 2 THEN 1 WHEN n <= 5 THEN 2 WHEN n <= 13 THEN 3 ELSE 4 END AS level FROM f),
c AS (SELECT area, time, level, lag(level) OVER (PARTITION BY area ORDER BY time) AS previous FROM l)
SELECT area, CAST(time AS VARCHAR) AS time, CAST(previous AS BIGINT) AS previous, CAST(level AS BIGINT) AS level FROM c WHERE previous IS NULL OR previous <> level""")
def r4(t: Tables):
    out, cp = scratch(t.spark, "r4"), scratch(t.spark, "r4-cp")
    t.spark.conf.set(*J.STATE_STORE)
    J.run_level_changes(_stream(t), LATE, out, cp)
    return t.spark.read.parquet(out).select("area", text("time").alias("time"), big("previous").alias("previous"), big("level").alias("level"))


@query("r5_distinct_steps", """
SELECT DISTINCT event_type AS area, CAST(date_trunc('hour', ts) AS VARCHAR) AS time FROM events""")
def r5(t: Tables):
    out, cp = scratch(t.spark, "r5"), scratch(t.spark, "r5-cp")
    steps = _stream(t).select("area", hour_floor(F.col("ts")).alias("time"))
    J.run_distinct_steps(steps, ["area", "time"], LATE, out, cp, ts="time")
    return t.spark.read.parquet(out).select("area", text("time").alias("time"))
