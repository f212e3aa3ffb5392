"""Registration of the demonstration queries, and the tables they derive from the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geocadence.functions.times import hour_floor

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(t)``; ``t`` gives the tables of one data folder."""
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def text(c) -> Column:
    """Times and dates as text, so that both engines print the same."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def r6(c) -> Column:
    """Six decimals; the tiny shift keeps a tie from falling differently in the two engines."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") + F.lit(1e-9), 6)


def big(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


# --- tables derived from events --------------------------------------------------------------------
# The five event types stand for five areas, user_id % 4 for the cells of an area. Values are summed as
# whole cents, so every engine and every order of addition gives the same numbers.
AREAS = ("click", "error", "purchase", "signup", "view")  # fixed values, in alphabetical order


def cents(c="value") -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def cell_hours(t: Tables) -> DataFrame:
    """(area, cell, time, value): hourly sum per area and cell."""
    e = t.events.select(F.col("event_type").alias("area"), F.pmod("user_id", F.lit(4)).cast("int").alias("cell"),
                        hour_floor(F.col("ts")).alias("time"), cents().alias("c"))
    return e.groupBy("area", "cell", "time").agg((F.sum("c") / 100.0).alias("value"))


def area_hours(t: Tables) -> DataFrame:
    """(area, time, value, n): hourly sum and count per area."""
    e = t.events.select(F.col("event_type").alias("area"), hour_floor(F.col("ts")).alias("time"), cents().alias("c"))
    return e.groupBy("area", "time").agg((F.sum("c") / 100.0).alias("value"), F.count(F.lit(1)).alias("n"))


def area_days(t: Tables) -> DataFrame:
    """(area, time DATE, value, n): daily sum and count per area; each 15 users add five areas, so areas grow with the table."""
    part = F.floor(F.col("user_id") / 15)
    area = F.when(part == 0, F.col("event_type")).otherwise(F.concat_ws("_", "event_type", part.cast("string")))
    e = t.events.select(area.alias("area"), F.col("ts").cast("date").alias("time"), cents().alias("c"))
    return e.groupBy("area", "time").agg((F.sum("c") / 100.0).alias("value"), F.count(F.lit(1)).alias("n"))


SQL_CELL_HOURS = """cell_hours AS (
  SELECT event_type AS area, CAST(user_id % 4 AS INTEGER) AS cell, date_trunc('hour', ts) AS time,
         SUM(CAST(round(value * 100) AS BIGINT)) / 100.0 AS value
  FROM events GROUP BY 1, 2, 3)"""
SQL_AREA_HOURS = """area_hours AS (
  SELECT event_type AS area, date_trunc('hour', ts) AS time,
         SUM(CAST(round(value * 100) AS BIGINT)) / 100.0 AS value, COUNT(*) AS n
  FROM events GROUP BY 1, 2)"""
SQL_AREA_DAYS = """area_days AS (
  SELECT event_type || CASE WHEN user_id < 15 THEN '' ELSE '_' || (user_id // 15) END AS area, CAST(ts AS DATE) AS time,
         SUM(CAST(round(value * 100) AS BIGINT)) / 100.0 AS value, COUNT(*) AS n
  FROM events GROUP BY 1, 2)"""


# --- slip catalogue and registry --------------------------------------------------------------------
# Orders stand for slips, the five regions for the alert areas.
def slip_points(t: Tables) -> DataFrame:
    """(id, time DATE, alert_area_code, custkey): one row per order, code = first two letters of its region."""
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("time"),
                F.substring("r_name", 1, 2).alias("alert_area_code"), F.col("o_custkey").alias("custkey"))
    )


SQL_SLIP_POINTS = """slip_points AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS time, substr(r_name, 1, 2) AS alert_area_code, o_custkey AS custkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def registry(t: Tables) -> DataFrame:
    """Raw registry with range texts; the ranges of an area depend on its key."""
    k = F.col("r_regionkey")
    dash = F.when(k == 2, F.lit("–")).otherwise(F.lit("-"))
    s = lambda x: x.cast("string")
    return t.region.select(
        F.concat(F.lit("alert_area_"), F.lower(F.substring("r_name", 1, 2))).alias("name"),
        F.substring("r_name", 1, 2).alias("alert_area"), k.alias("index"),
        F.concat(F.lit("basin_"), s(k), F.lit(" , basin_"), s(k + 5), F.lit(",basin_"), s(k + 10)).alias("catchment"),
        F.lit("0-0").alias("white_range"),
        F.concat(F.lit("1"), dash, s(1 + F.pmod(k, F.lit(2)))).alias("green_range"),
        F.concat(s(2 + F.pmod(k, F.lit(2))), dash, s(3 + k)).alias("yellow_range"),
        F.concat(s(4 + k), dash, s(6 + k)).alias("orange_range"),
        F.concat(s(7 + k), F.lit("+")).alias("red_range"))


SQL_REGISTRY = """registry AS (
  SELECT 'alert_area_' || lower(substr(r_name, 1, 2)) AS name, substr(r_name, 1, 2) AS alert_area, r_regionkey AS k
  FROM region),
levels AS (
  SELECT name, 0 AS ord, 'white' AS level, 0 AS lo, 0 AS hi FROM registry UNION ALL
  SELECT name, 1, 'green', 1, 1 + k % 2 FROM registry UNION ALL
  SELECT name, 2, 'yellow', 2 + k % 2, 3 + k FROM registry UNION ALL
  SELECT name, 3, 'orange', 4 + k, 6 + k FROM registry UNION ALL
  SELECT name, 4, 'red', 7 + k, NULL FROM registry)"""
