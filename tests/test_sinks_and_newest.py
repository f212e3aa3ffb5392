"""A partition of a CSV sink is one file; the newest file of a key is found without sorting names."""

import glob

from pyspark.sql import functions as F

from geocadence.operators.inventory import newest_file
from geocadence.sources.tables import write_csv


def test_a_partition_is_one_file(spark, tmp_path):
    df = spark.range(0, 400, 1, 8).select((F.col("id") % 5).cast("string").alias("area"), F.col("id").cast("string").alias("time"), (F.col("id") / 4).alias("value"))
    write_csv(df, str(tmp_path / "out"), ["area"])
    assert len(glob.glob(str(tmp_path / "out" / "*" / "*.csv"))) == 5
    assert spark.read.csv(str(tmp_path / "out"), sep=";", header=True).count() == 400


def test_newest_files_by_hash_and_with_missing_times(spark):
    rows = [("a", 1, "/x/b"), ("a", 2, "/x/a"), ("a", 2, "/w/c"), (None, 5, "/n"), (None, None, "/o"), ("b", None, "/p"), ("b", None, "/q"), ("c", 1, None)]
    df = spark.createDataFrame(rows, "`group` string, mtime int, path string")
    out = newest_file(df, ["group"])
    assert {r.group: r.path for r in out.collect()} == {"a": "/w/c", None: "/n", "b": "/q", "c": None}
    first = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in first and "max(_mtime" in first
