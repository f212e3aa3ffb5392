"""Points in polygons where nearly all points share a bin, and bins that lie wholly inside."""

from statistics import median

from conftest import rows
from pyspark.sql import functions as F

from geocadence.operators.alerts import locate_points, polygon_bins

RING = "struct<x:double,y:double>"
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",  # else the few cold rows, less than its least size of 1 MB, become one task
}


def _polygons(spark):
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    return spark.createDataFrame(
        [("A", square(0.0, 0.0, 3.0)), ("B", square(1.1, 1.1, 0.3)), ("C", [(5.0, 5.0), (6.0, 5.0), (5.0, 6.0)])],
        f"alert_area_code string, ring array<{RING}>")


def _points(spark, n=400_000):
    """Nine points of ten in the bin from 1 to 1.25 degrees."""
    u = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    hot = F.pmod("id", F.lit(10)) > 0
    return spark.range(0, n, 1, 32).select(
        "id", F.when(hot, 1 + u(1) / 4).otherwise(u(1) * 7).alias("lon"), F.when(hot, 1 + u(2) / 4).otherwise(u(2) * 7).alias("lat"))


def test_hot_bin_is_split(spark):
    points = _points(spark)
    lon, lat = F.col("lon"), F.col("lat")
    square = lambda a, b: (lon > a) & (lon < b) & (lat > a) & (lat < b)
    triangle = (lon > 5) & (lat > 5) & (lon + lat < 11)
    want = {"A": points.where(square(0, 3)), "B": points.where(square(1.1, 1.4)), "C": points.where(triangle)}
    want[None] = points.where(~(square(0, 3) | square(1.1, 1.4) | triangle))
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        found = locate_points(points, _polygons(spark)).withColumn("task", F.spark_partition_id())
        got = found.toPandas()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for code, df in want.items():
        here = got[got.alert_area_code_polygon.isna() if code is None else got.alert_area_code_polygon == code]
        assert sorted(here.id) == sorted(r.id for r in df.select("id").collect()), code
    assert "skew=true" in plan
    sizes = got.drop_duplicates("id").groupby("task").size().tolist()
    assert max(sizes) <= 2 * median(sizes), sizes


def test_whole_bins_hold_no_edges(spark):
    bins = polygon_bins(_polygons(spark), 0.25)
    whole = bins.where("alert_area_code = 'A' AND _whole")
    assert whole.count() == 100 and whole.where("_edges IS NOT NULL").count() == 0  # 10 x 10 of the 13 x 13 that it meets
    outside = bins.where("alert_area_code = 'C' AND _bx >= 23 AND _by >= 23")
    assert rows(outside, "_bx", "_by") == []
