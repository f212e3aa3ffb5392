"""Layout and log of cell tables: pruned files, known steps, logs that are not those of the files."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from geocadence.functions.times import ntz_lit
from geocadence.sources import grids as GR

BOTH = ("2024-03-01 00:00:00", "2024-03-02 23:00:00")


def _cells(spark, day, hours=24, side=128):
    start = F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    cells = spark.range(hours * side * side).select(
        (start + F.make_dt_interval(F.lit(0), F.floor(F.col("id") / (side * side)).cast("int"))).alias("time"),
        F.floor(F.pmod("id", F.lit(side * side)) / side).cast("int").alias("row"), F.pmod("id", F.lit(side)).cast("int").alias("col"))
    return cells.withColumn("value", F.col("row") * 1000.0 + F.col("col"))


def _mask(spark, r0, c0, size):
    return spark.range(size * size).select((F.lit(r0) + F.floor(F.col("id") / size)).cast("int").alias("row"),
                                           (F.lit(c0) + F.pmod("id", F.lit(size))).cast("int").alias("col"), F.lit(1).alias("mask"))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells") / "t")
    GR.write_cells(_cells(spark, "2024-03-01").unionByName(_cells(spark, "2024-03-02", hours=5)), path, rows_per_file=6144)
    return path


def test_tile_codes_follow_a_z_curve(spark):
    want = {(r, c): int("".join(a + b for a, b in zip(f"{r:016b}", f"{c:016b}")), 2) for r, c in [(0, 0), (0, 1), (1, 0), (3, 5), (4095, 1), (65535, 65535)]}
    d = spark.createDataFrame([(r * 16 + 7, c * 16 + 15, v) for (r, c), v in want.items()], "row int, col int, want long")
    assert d.filter(GR.tile_code(F.col("row"), F.col("col")) != F.col("want")).count() == 0


def test_a_tile_reads_few_files_of_a_date(spark, table):
    date = spark.read.parquet(table).filter("date = '2024-03-01'").select(F.col("_metadata.file_name")).distinct().count()
    end = ntz_lit("2024-03-01 23:00:00")
    files = GR.masked_files(spark, table, ntz_lit(BOTH[0]), end, _mask(spark, 32, 48, 16))
    assert date >= 50 and len(files) < date / 10
    got = GR.scan_cells(spark, table, ntz_lit(BOTH[0]), end, _mask(spark, 32, 48, 16))
    assert got.count() == 24 * 256 and len(got.inputFiles()) <= len(files) + 1
    assert got.filter(F.col("value") != F.col("row") * 1000.0 + F.col("col")).count() == 0


def test_files_are_bounded_and_hold_everything(spark, table):
    back = spark.read.parquet(table)
    assert back.count() == 29 * 128 * 128
    assert back.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0] <= 6144


def test_steps_come_from_the_log_alone(spark, table):
    steps = GR.written_steps(spark, table, *map(ntz_lit, BOTH))
    assert steps.count() == 29
    scans = re.findall(r"Location: \w+\s*\(\d+ paths\)?\[([^\]]*)\]", steps._jdf.queryExecution().executedPlan().treeString()) or steps.inputFiles()
    assert scans and all(GR.LOG in s for s in scans)
    assert all(f"/{GR.LOG}/" in f for f in steps.inputFiles())


def test_the_stage_reads_no_cells_for_its_policy(spark, table):
    from geocadence.plans.stages import _complete_periods
    periods = spark.createDataFrame([(datetime.datetime(2024, 3, 1, 12), "p", datetime.datetime(2024, 3, 1), datetime.datetime(2024, 3, 1, 23)),
                                     (datetime.datetime(2024, 3, 2, 12), "q", datetime.datetime(2024, 3, 2, 5), datetime.datetime(2024, 3, 2, 23))],
                                    "time_run timestamp_ntz, period_tag string, time_start timestamp_ntz, time_end timestamp_ntz")
    kept = _complete_periods(periods, GR.written_steps(spark, table, *map(ntz_lit, BOTH)), "skip")
    assert [r[0] for r in rows(kept, "period_tag")] == ["p"]
    assert all(f"/{GR.LOG}/" in f for f in kept.inputFiles())
    with pytest.raises(Exception, match="incomplete steps"):
        _complete_periods(periods, GR.written_steps(spark, table, *map(ntz_lit, BOTH)), "fail")


def test_a_rewritten_date_replaces_its_log(spark, tmp_path):
    path = str(tmp_path / "t")
    GR.write_cells(_cells(spark, "2024-03-01", side=16).unionByName(_cells(spark, "2024-03-02", side=16)), path)
    GR.write_cells(_cells(spark, "2024-03-02", hours=3, side=16), path)
    assert GR.written_steps(spark, path, *map(ntz_lit, BOTH)).count() == 27
    assert GR.scan_cells(spark, path, *map(ntz_lit, BOTH), _mask(spark, 0, 0, 4)).count() == 27 * 16


def test_a_log_of_other_files_is_not_believed(spark, tmp_path):
    path = str(tmp_path / "t")
    GR.write_cells(_cells(spark, "2024-03-01", hours=3, side=16), path)
    # rows of another writer: their file is not in the log, so the date is read instead
    more = _cells(spark, "2024-03-01", hours=4, side=32).withColumn("date", F.col("time").cast("date"))
    more.filter("hour(time) = 3").write.mode("append").partitionBy("date").parquet(path)
    assert GR.written_steps(spark, path, *map(ntz_lit, BOTH)).count() == 4
    assert GR.scan_cells(spark, path, *map(ntz_lit, BOTH), _mask(spark, 20, 20, 2)).count() == 4
    # a date without any log, and a date whose log outlived its files
    _cells(spark, "2024-03-02", hours=2, side=16).withColumn("date", F.col("time").cast("date")).write.mode("append").partitionBy("date").parquet(path)
    assert GR.written_steps(spark, path, *map(ntz_lit, BOTH)).count() == 6
    GR.write_cells(_cells(spark, "2024-03-02", hours=1, side=16), path)
    assert GR.written_steps(spark, path, *map(ntz_lit, BOTH)).count() == 5


def test_tables_without_rows_or_log(spark, tmp_path):
    plain, path = str(tmp_path / "plain"), str(tmp_path / "t")
    one = _cells(spark, "2024-03-01", hours=2, side=16)
    one.withColumn("date", F.col("time").cast("date")).write.partitionBy("date").parquet(plain)
    assert GR.written_steps(spark, plain, *map(ntz_lit, BOTH)).count() == 2
    assert GR.masked_files(spark, plain, *map(ntz_lit, BOTH), _mask(spark, 0, 0, 1)) is None
    assert GR.scan_cells(spark, plain, *map(ntz_lit, BOTH), _mask(spark, 0, 0, 1)).count() == 2
    GR.write_cells(one, path)
    GR.write_cells(one.filter("false"), path)  # nothing is touched
    assert GR.written_steps(spark, path, *map(ntz_lit, BOTH)).count() == 2
    assert GR.scan_cells(spark, path, *map(ntz_lit, BOTH), _mask(spark, 500, 500, 2)).count() == 0  # no file at all
