"""What the map of nearest cells sends to the driver, and cells that differ much in density."""

from pyspark.sql import functions as F

from conftest import SF
from geocadence.catalog.grids_q import _swath
from geocadence.catalog.registry import QUERIES, Tables
from geocadence.operators.swath import swath_map
from test_swath import C, T, _brute, _check


def _plans(spark, run):
    """Text of the final plans of all executions of ``run``."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = store.executionsList(int(before), int(store.executionsCount() - before))
    return [found.apply(i).physicalPlanDescription() for i in range(found.size())]


def _nothing_broadcast(spark, name):
    plans = _plans(spark, lambda: QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save())
    assert any("SortMergeJoin" in p for p in plans)
    assert not [p for p in plans if "BroadcastExchange" in p]


def test_weighted_cells_are_not_sent_to_the_driver(spark):
    _nothing_broadcast(spark, "j9_uneven_grid")


def test_dense_cells_add_no_rounds(spark):
    """200 cells at one place once made every target start at the finest cubes: 13 rounds of jobs."""
    cells = [(0, i, 8.0, 44.0) for i in range(200)] + [(1 + i, j, 8.3 + i * 0.01, 44.3 + j * 0.01) for i in range(10) for j in range(10)]
    targets = [(i, 8.0 + i * 0.01, 44.0 + i * 0.01) for i in range(50)] + [(99, 20.0, 10.0)]
    runs = _plans(spark, lambda: swath_map(spark.createDataFrame(targets, T), spark.createDataFrame(cells, C), ["id"], k=3).collect())
    assert len(runs) <= 8
    _check(spark, targets, cells, 3, 25000.0)


def test_places_that_are_no_numbers_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 0, 8.0, 44.0), (0, 1, 120.0, -30.0), (1, 1, -100.0, 60.0)]
    odd = [(5, i, nan, 44.0) for i in range(9)] + [(6, 0, 8.0, inf), (6, 1, None, None)]
    targets = [(1, 8.5, 44.0), (2, 100.0, -20.0), (3, nan, 0.0), (4, 8.0, -inf)]
    for k, radius in ((2, 9e6), (1, 25000.0), (1, 0.5)):
        rows = swath_map(spark.createDataFrame(targets, T), spark.createDataFrame(good + odd, C), ["id"], k=k, radius_m=radius).orderBy("id", "rank").collect()
        want = _brute(targets[:2], good, k, radius)
        assert [(r["id"], r["src_row"], r["src_col"]) for r in rows] == [(i, *w[1:]) for i in sorted(want) for w in want[i]]


def test_nearest_cells_are_not_sent_to_the_driver(spark):
    _nothing_broadcast(spark, "j8_uneven_grid")


def test_rows_of_large_tables_do_not_overflow(spark, tmp_path):
    """The square of a row number above 46340 is no int: 1.9 million customers and more."""
    spark.range(4_000_000, 4_000_003).select(F.col("id").alias("c_custkey"), F.lit(1.5).alias("c_acctbal")).write.parquet(str(tmp_path / "customer.parquet"))
    got = _swath(Tables(spark, str(tmp_path))).orderBy("col").collect()
    assert [(r["row"], r["col"]) for r in got] == [(100_000, 0), (100_000, 1), (100_000, 2)]
    assert got[0]["lat"] == 44.4 - 1e10 * 0.0005
