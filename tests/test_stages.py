"""The chain of stages on tables, from hourly cells to predicted levels."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from geocadence.catalog import alerts_q, kernel_q, plans_q
from geocadence.catalog.registry import AREAS, Tables, registry
from geocadence.operators import alerts as A
from geocadence.operators.kernel import collapse_model
from geocadence.plans import stages as P
from geocadence.sources.grids import write_cells


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    t = Tables(spark, SF)
    store = P.Store(str(tmp_path_factory.mktemp("store")))
    dense = plans_q._grid_cells(t).select("time", "row", "col", "value")
    hours = spark.range(720).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("time"))
    # every hour and cell of the month, dry where no event fell
    full = hours.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(1))))
    write_cells(full.join(dense, ["time", "row", "col"], "left").fillna({"value": 0.0}), store.path("rain_cells"))
    write_cells(full.withColumn("value", F.lit(40.0) + F.col("row")), store.path("sm_cells"))
    pts = spark.createDataFrame([(a, i, p) for i, a in enumerate(AREAS) for p in (0, 1)], "area string, i int, point_id int").select(
        "area", "point_id", plans_q.RAIN.lon(F.col("point_id")).alias("lon"), plans_q.RAIN.lat(F.col("i") * 2 + F.col("point_id")).alias("lat"))
    P.geometry_stage(spark, store, plans_q._fine(t), pts, plans_q.RAIN, plans_q.MASK, 5.0)
    runs = spark.createDataFrame([(datetime(2024, 1, d, h),) for d in range(5, 12) for h in (8, 14)], "run timestamp_ntz")
    P.rain_stage(spark, store, runs)
    P.sm_stage(spark, store, runs)
    slips = t.events.select(F.col("ts").cast("date").alias("time"), F.upper(F.substring("event_type", 1, 2)).alias("alert_area_code"))
    names = spark.createDataFrame([(a, a[:2].upper()) for a in AREAS], "name string, alert_area string")
    levels = A.level_table(registry(t).limit(1)).drop("name").join(names.select("name"), how="cross")
    P.slips_stage(store, slips, names, levels, alerts_q._colors(t))
    P.scenario_stage(spark, store, F.lit("2024-01-10 10:00:00").cast("timestamp_ntz"), F.lit("2024-01-01"))
    model = collapse_model(kernel_q.training(t), 4, 3, maxima=[100.0, 500.0, 500.0, 366.0], means=[0.4, 0.1, 0.1, 0.02])
    P.predictor_stage(spark, store, model)
    return store, runs


def test_rain_rows_per_run_and_period(spark, chain):
    store, _ = chain
    d = store.read(spark, "indicators_rain")
    assert d.count() == 5 * 14 * 2  # areas x runs x (observed, mixed)
    assert d.filter("`rain_peak_24H:max` IS NULL OR `rain_accumulated_24H:max` IS NULL").count() == 0
    one = d.filter("area = 'click' AND period_type = 'Observed' AND time_run = TIMESTAMP_NTZ '2024-01-08 14:00:00'").first()
    assert (one["time_key"], one["time_start"]) == ("2024-01-07", datetime(2024, 1, 7, 1))


def test_sm_rows(spark, chain):
    d = chain[0].read(spark, "indicators_sm").filter("area = 'error'")
    assert d.filter(F.abs(F.col("sm_value_avg") - 42.5) > 0.6).count() == 0 and d.count() == 28


def test_scenarios_use_the_newest_run_up_to_the_reference(spark, chain):
    d = chain[0].read(spark, "scenarios").filter("area = 'view'")
    got = {r["time"]: r for r in d.collect()}
    assert len(got) == 10  # 1 to 10 January
    day = {str(k): v for k, v in got.items()}
    assert day["2024-01-10"]["rain_time_run"] == datetime(2024, 1, 10, 8) and day["2024-01-10"]["rain_period_type"] == "Observed_Forecast"
    assert day["2024-01-10"]["rain_latest_from"] == "latest" and day["2024-01-08"]["rain_latest_from"] == "db"
    assert day["2024-01-08"]["rain_time_run"] == datetime(2024, 1, 9, 14) and day["2024-01-08"]["rain_period_type"] == "Observed"
    assert day["2024-01-02"]["rain_period_type"] == "NoData" and day["2024-01-02"]["sm_value_first"] == -9999


def test_predictors_are_complete_and_consistent(spark, chain):
    d = chain[0].read(spark, "predictors")
    assert d.groupBy("area").count().filter("count <> 7").count() == 0  # 4 to 10 January
    level = {0: "white", 1: "green", 2: "yellow", 3: "orange", 4: "red"}
    for r in d.collect():
        n, lv = r["soil_slips_pred_n"], r["soil_slips_pred_alert_level"]
        assert n >= 0 and r["soil_slips_pred_alert_color"] == level[lv]
        assert lv == sum(n >= lo for lo in (1, 3, 6, 14))


def test_rerun_replaces_its_partitions_only(spark, chain):
    store, runs = chain
    before = rows(store.read(spark, "indicators_sm"), "area", "time_run", "period_tag", "sm_value_avg")
    P.sm_stage(spark, store, runs.filter("run < TIMESTAMP_NTZ '2024-01-06 00:00:00'"))
    assert rows(store.read(spark, "indicators_sm"), "area", "time_run", "period_tag", "sm_value_avg") == before
    assert P.pending_runs(spark, runs, store, "indicators_sm").count() == 0
    assert P.pending_runs(spark, runs, store, "nothing_yet").count() == 14


def test_a_missing_hour_stops_the_rain_stage(spark, chain):
    store, _ = chain
    late = spark.createDataFrame([(datetime(2024, 1, 31, 14),)], "run timestamp_ntz")
    with pytest.raises(Exception, match="incomplete steps"):
        P.rain_stage(spark, store, late)


def test_updated_scenarios_are_those_made_anew(spark, chain):
    store, _ = chain
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    before = rows(store.read(spark, "scenarios"))
    P.scenario_update_stage(spark, store, at("2024-01-09 10:00:00"), F.lit("2024-01-01"))
    P.scenario_update_stage(spark, store, at("2024-01-10 10:00:00"), F.lit("2024-01-01"), since="2024-01-09")
    assert rows(store.read(spark, "scenarios")) == before
