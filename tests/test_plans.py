"""What the physical plans must and must not hold."""

import re

import pytest

from conftest import SF
from geocadence.catalog import load_all
from geocadence.catalog.registry import QUERIES, Tables, area_hours, cell_hours
from geocadence.operators.series import rolling_exact

load_all()
STREAMS = {n for n in QUERIES if re.match(r"r\d_", n)}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_pairwise_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rolling_windows_share_one_sort(spark):
    plan = plan_of(rolling_exact(cell_hours(Tables(spark, SF)), ["area", "cell"], (3, 6, 12, 24)))
    assert len(re.findall(r"[+:]- Sort ", plan)) == 1
    assert plan.count("Exchange hashpartitioning(area") == 2  # hourly sums, then chunks


def test_rolling_is_spread_by_chunk(spark):
    hot = area_hours(Tables(spark, SF)).repartition("area")
    plan = plan_of(rolling_exact(hot, ["area"], (3,)))
    assert re.search(r"Exchange hashpartitioning\(area#\d+, _chunk#\d+", plan)


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["p3_drop_range"](spark, SF))
    assert "GreaterThanOrEqual(value,5.0)" in plan and "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_date_prunes_partitions(spark, tmp_path):
    from geocadence.functions.times import ntz_lit
    from geocadence.sources.grids import scan_cells, write_cells
    from pyspark.sql import functions as F
    cells = cell_hours(Tables(spark, SF)).select("time", F.lit(0).alias("row"), F.col("cell").alias("col"), "value")
    write_cells(cells, str(tmp_path / "cells"))
    plan = plan_of(scan_cells(spark, str(tmp_path / "cells"), ntz_lit("2024-01-04 05:00:00"), ntz_lit("2024-01-05 05:00:00")))
    assert re.search(r"PartitionFilters: \[.*date#\d+ >= 2024-01-04", plan)


def test_collapsed_score_has_no_join_and_no_shuffle(spark):
    plan = plan_of(QUERIES["m2_kernel_score_collapsed"](spark, SF))
    assert "Join" not in plan and "Exchange" not in plan


def test_fixed_map_needs_no_join(spark):
    plan = plan_of(QUERIES["j8_nearest_regrid_map"](spark, SF))
    assert "Join" not in plan and "Exchange" not in plan


def test_rain_indicators_read_the_cells_once(spark):
    plan = plan_of(QUERIES["a5_rain_indicators"](spark, SF))
    assert len(re.findall(r"FileScan parquet.*events\.parquet", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 8


@pytest.mark.parametrize("name", ["j6_newest_run_wins", "w6_newest_row_number"])
def test_newest_rows_are_hash_aggregates(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
