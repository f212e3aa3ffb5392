"""Hand-computed tables for the rules that are easy to get wrong."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from geocadence.functions import cells as C
from geocadence.functions import text as X
from geocadence.functions import times as K
from geocadence.operators import alerts as A
from geocadence.operators import inventory as I
from geocadence.operators import scenario as S
from geocadence.operators import series as R
from geocadence.operators import timespine as Z


def at(text):
    return datetime.fromisoformat(text)


def blocks(spark, run, obs, frc, **kw):
    runs = spark.createDataFrame([(at(run),)], "run timestamp_ntz")
    w = Z.run_window(runs, obs, frc, snap_end="none")
    p = Z.period_blocks(w, **kw)
    return rows(p, "period_tag", "period_type", "time_start", "time_end", "time_key")


# --- W3 / W4 / T1 ---------------------------------------------------------------------------------
def test_observed_only_run_keeps_one_block(spark):
    assert blocks(spark, "2024-03-10 14:00", 24, 0) == [
        ("Observed_0001_Period", "Observed", at("2024-03-09 01:00"), at("2024-03-10 00:00"), "2024-03-09")]


def test_forecast_run_has_a_mixed_block(spark):
    assert blocks(spark, "2024-03-10 14:00", 24, 24) == [
        ("Forecast_0001_Period", "Observed_Forecast", at("2024-03-10 01:00"), at("2024-03-11 00:00"), "2024-03-10"),
        ("Observed_0001_Period", "Observed", at("2024-03-09 01:00"), at("2024-03-10 00:00"), "2024-03-09")]


def test_run_at_midnight_has_no_mixed_block(spark):
    got = blocks(spark, "2024-03-10 00:00", 24, 24)
    assert {r[1] for r in got} == {"Observed", "Forecast"}


def test_mixed_blocks_are_never_dropped(spark):
    got = blocks(spark, "2024-03-10 14:00", 24, 3)
    assert ("Forecast_0001_Period", "Observed_Forecast", at("2024-03-10 01:00"), at("2024-03-10 17:00"), "2024-03-10") in got


def test_unique_observed_block_is_the_last_hours_before_midnight(spark):
    got = blocks(spark, "2024-03-01 09:00", 24, 24, obs_hours=2, obs_partition="unique")
    assert got[1] == ("Observed_0001_Period", "Observed", at("2024-02-29 23:00"), at("2024-03-01 00:00"), "2024-02-29")


def test_unique_forecast_ends_after_n_hours(spark):
    got = blocks(spark, "2024-12-31 00:00", 24, 48, frc_partition="unique", drop_partial=False)
    assert got[0][3] == at("2024-12-31 23:00")


def test_run_window_rules(spark):
    r = spark.createDataFrame([(at("2024-01-01 10:40"),)], "run timestamp_ntz")
    one = lambda **kw: rows(Z.run_window(r, **kw), "time_run", "window_start", "window_end")[0]
    assert one(obs=3, frc=2, snap_start="none", snap_end="none") == (at("2024-01-01 10:00"), at("2024-01-01 08:00"), at("2024-01-01 12:00"))
    assert one(obs=0, frc=2, snap_start="none", snap_end="none")[1] == at("2024-01-01 11:00")
    assert one(obs=0, frc=0, snap_start="none", snap_end="none")[1:] == (at("2024-01-01 10:00"),) * 2
    assert one(obs=-4, frc=0, snap_start="next", snap_end="none")[1:] == (at("2024-01-02 00:00"),) * 2  # end raised to start


def test_analysis_period_priority():
    ref = datetime(2024, 1, 10, 12)
    assert Z.analysis_period("ref_data", "ref_data", 5, "d", ref) == "ref_data"
    assert Z.analysis_period(datetime(2024, 1, 1), datetime(2024, 1, 3), 2, "d", ref) == (datetime(2024, 1, 9), datetime(2024, 1, 10))
    assert Z.analysis_period(datetime(2024, 1, 1), datetime(2024, 1, 3), 2) == (datetime(2024, 1, 1), datetime(2024, 1, 3))
    assert Z.analysis_period(None, datetime(2024, 1, 3), 2) == (datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert Z.analysis_period(time_reference=ref) is None
    # half-even like rounding at noon: 9 Jan 12:00 goes to 10 Jan, 10 Jan 12:00 stays on 10 Jan
    assert Z.analysis_period(None, None, 1, "d", datetime(2024, 1, 9, 12))[1] in (datetime(2024, 1, 9), datetime(2024, 1, 10))


# --- T3 -------------------------------------------------------------------------------------------
def test_gap_days(spark):
    d = spark.createDataFrame(
        [("a", date(2023, 12, 30), 5, "x", "2023-12-30", "2023-12-30 01:00", "2023-12-31 00:00"),
         ("a", date(2024, 1, 1), 6, "y", "2024-01-01", "2024-01-01 01:00", "2024-01-02 00:00")],
        "area string, time date, n int, label string, rain_time_run string, rain_time_start string, time_end string")
    assert Z.fill_missing_days(d, ["area"]) is d
    got = rows(Z.fill_missing_days(d, ["area"], end=F.lit("2024-01-01")))
    assert got[1] == ("a", "2023-12-31", -9999, "NoData", "2023-12-31", "2023-12-31 01:00", "2024-01-01 00:00")
    assert len(got) == 3


# --- C1 / C2 / P16 / C4 ----------------------------------------------------------------------------
@pytest.fixture()
def levels(spark):
    reg = spark.createDataFrame([("a", "0-0", "1-2", "3–5", "6-13", "14+"), ("b", "0-1", "2-2", "5-6", "7-8", "9+")],
                                "name string, white_range string, green_range string, yellow_range string, orange_range string, red_range string")
    return A.level_table(reg)


def test_levels_follow_the_area(spark, levels):
    d = spark.createDataFrame([("a", c) for c in (0, 1, 2, 3, 5, 6, 13, 14, 15)] + [("b", c) for c in (1, 3, 4, 9)] + [("c", 1)],
                              "alert_area_label string, n int")
    got = {(r[0], r[1]): r[2] for r in rows(A.classify_by_area(d, levels, "n"), "alert_area_label", "n", "alert_color")}
    assert [got["a", c] for c in (0, 1, 2, 3, 5, 6, 13, 14, 15)] == [
        "white", "green", "green", "yellow", "yellow", "orange", "orange", "red", "red"]
    assert [got["b", c] for c in (1, 3, 4, 9)] == ["white", "unknown", "unknown", "red"] and got["c", 1] == "unknown"


def test_default_levels(spark):
    d = spark.createDataFrame([(c,) for c in (-1, 0, 2, 3, 13, 14)], "n int")
    got = rows(A.classify_default(d, "n"), "n", "slip_alert_id", "slip_alert_color", "slip_alert_rgba")
    assert (-1, None, None, "0,0,0,0.1") in got and (13, 3, "orange", "255,165,0,0.1") in got and (14, 4, "red", "255,0,0,0.1") in got


def test_threshold_texts(spark, levels):
    got = {(r[0], r[1]): r[2] for r in rows(levels.select("name", "level", X.threshold_text(F.col("lo"), F.col("hi")).alias("t")))}
    assert got["a", "white"] == "n = 0" and got["a", "yellow"] == "3 <= n <= 5" and got["b", "red"] == "n >= 9"


# --- A1 -------------------------------------------------------------------------------------------
def test_count_slips_drops_rows_without_key(spark, levels):
    p = spark.createDataFrame([(date(2024, 2, 29), "A"), (date(2024, 2, 29), "A"), (None, "A"), (date(2024, 3, 1), None)],
                              "time date, alert_area_code string")
    reg = spark.createDataFrame([("a", "A")], "name string, alert_area string")
    got = rows(A.count_slips(p, reg, levels), "time", "soil_slips", "alert_color", "year", "month", "day")
    assert got == [(date(2024, 2, 29), 2, "green", 2024, 2, 29)]
    with pytest.raises(ValueError):
        A.count_slips(p, reg, levels, code_source="other")


# --- J1 -------------------------------------------------------------------------------------------
def test_point_on_edge_is_outside_and_overlap_gives_two_rows(spark):
    sq = lambda a, b: [{"x": a, "y": a}, {"x": b, "y": a}, {"x": b, "y": b}, {"x": a, "y": b}]
    polys = spark.createDataFrame([("P", sq(0.0, 2.0)), ("Q", sq(1.0, 3.0))], "alert_area_code string, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 1.5, 1.5), (2, 0.0, 1.0), (3, 2.0, 2.0), (4, 9.0, 9.0), (5, 0.5, 0.5)], "id int, lon double, lat double")
    got = rows(A.locate_points(pts, polys, bin_deg=0.5), "id", "alert_area_code_polygon")
    assert got == [(1, "P"), (1, "Q"), (2, None), (3, "Q"), (4, None), (5, "P")]


# --- J6 / J17 / W8 / C5 ----------------------------------------------------------------------------
def test_newest_run_of_rows_without_a_run(spark):
    schema = "area string, time int, run_time timestamp_ntz, v double"
    data = [("a", 1, None, 1.0), ("b", 1, None, 2.0), ("b", 1, datetime(2024, 1, 2), None), ("b", 1, datetime(2024, 1, 1), 4.0)]
    d = spark.createDataFrame(data, schema)
    want = [("a", 1, None, 1.0, "db"), ("b", 1, datetime(2024, 1, 2), None, "latest")]  # a missing value of the newest run stays missing
    for extra in ([], [F.lit("t").alias("t")]):  # of a fixed width, and with a text beside
        out = S.newest_run_wins(d.select("*", *extra), ["area", "time"])
        assert rows(out, "area", "time", "run_time", "v", "latest_from") == want


def test_newest_run_wins_and_is_idempotent(spark):
    d = spark.createDataFrame([("a", 1, 10, 1.0), ("a", 1, 20, 2.0), ("a", 2, 10, 3.0)], "area string, time int, run_time int, v double")
    out = S.newest_run_wins(d, ["area", "time"])
    assert rows(out, "time", "v", "latest_from") == [(1, 2.0, "latest"), (2, 3.0, "db")]
    again = S.newest_run_wins(out.drop("latest_from"), ["area", "time"])
    assert rows(again) == rows(out)


def test_nearest_run_prefers_later_on_tie(spark):
    runs = spark.createDataFrame([(at("2024-01-01 08:00"),), (at("2024-01-01 10:00"),), (at("2024-01-02 09:00"),)], "run_time timestamp_ntz")
    t = spark.createDataFrame([(1, at("2024-01-01 09:00")), (2, at("2024-01-01 08:00")), (3, at("2024-01-01 23:00"))], "id int, at timestamp_ntz")
    assert rows(I.nearest_run(t, runs, 120, at="at"), "id", "run_minute") == [(1, 600), (2, 480), (3, None)]


def test_thinning_measures_from_the_last_kept(spark):
    f = spark.createDataFrame([("g", at(f"2024-01-01 {h}"), f"p{h}") for h in ("00:00", "00:40", "01:10", "01:30", "02:15")],
                              "g string, time timestamp_ntz, path string")
    assert [r[0] for r in rows(R.thin_by_minutes(f, ["g"], 60), "path")] == ["p00:00", "p01:10", "p02:15"]


def test_freshness_gate_limits(spark):
    old, run = at("2024-01-01 10:00"), at("2024-01-01 20:00")
    cases = [(1, at("2024-01-01 07:00"), old), (2, at("2024-01-01 06:59"), old), (3, at("2024-01-01 17:00"), old),
             (4, at("2024-01-01 20:01"), old), (5, at("2024-01-01 17:00"), None), (6, at("2024-01-01 16:00"), None)]
    f = spark.createDataFrame([(i, m, o, run) for i, m, o in cases], "id int, mtime timestamp_ntz, oldest timestamp_ntz, run_time timestamp_ntz")
    got = {r[0]: (r[1], r[2]) for r in rows(A.freshness_gate(f, 3), "id", "keep", "anchor")}
    assert got == {1: (True, "oldest_sf_time"), 2: (False, "oldest_sf_time"), 3: (True, "run_time"), 4: (False, "run_time_future"),
                   5: (True, "run_time"), 6: (False, "run_time")}
    assert A.freshness_gate(f, None).filter("keep").count() == 6


# --- P21 / P17 / P18 / P26 / P20 --------------------------------------------------------------------
def test_period_texts(spark):
    d = spark.createDataFrame([("3M",), ("2h",), ("1D",), ("5W",)], "s string")
    assert [r[1] for r in rows(d.select("s", K.period_seconds(F.col("s")).alias("v")))] == [86400, 7200, 180, 0]
    with pytest.raises(Exception):
        spark.createDataFrame([("0H",)], "s string").select(K.period_seconds(F.col("s"))).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([("3M",)], "s string").select(K.window_hours(F.col("s"))).collect()
    assert spark.createDataFrame([("h",)], "s string").select(K.window_hours(F.col("s"))).first()[0] == 1


def test_names_and_paths(spark):
    d = spark.createDataFrame([("/x/indicators_rain_202402291500_a.csv", "/d/2024/02/29/1500/f", "7:05")], "p string, q string, t string")
    r = d.select(X.time_from_token(F.col("p")), X.time_from_path(F.col("q")), X.time_from_path(F.col("q"), "%Y/%m/"), X.run_label(F.col("t"))).first()
    assert tuple(r) == (at("2024-02-29 15:00"), at("2024-02-29 15:00"), at("2024-02-01 00:00"), "07:05")
    assert X.fill_star("%Y/*/%d/*00") == "%Y/%m/%d/%H00"
    with pytest.raises(ValueError):
        X.time_from_path(F.col("q"), "%Y/%j")
    bad = spark.createDataFrame([("f_202402301500_x.csv",), ("f_20240229_x.csv",)], "p string")
    assert [r[0] for r in bad.select(X.time_from_digits(F.col("p"))).collect()] == [None, None]


def test_dates(spark):
    d = spark.createDataFrame([("29/02/2024",), ("30/02/2024",), ("x",), (None,)], "s string")
    assert [r[0] for r in d.select(K.parse_dmy(F.col("s"))).collect()] == ["2024-02-29", None, None, None]


# --- NULL rules -------------------------------------------------------------------------------------
def test_missing_values(spark):
    d = spark.createDataFrame([(float("nan"),), (-9999.0,), (None,), (5.0,), (500.0,)], "v double")
    v = F.col("v")
    got = d.select(C.missing_to_null(v, -9999), C.clip(C.missing_to_null(v), 0, 100), C.within_or_null(v, 0, 100), C.unscale(v, 10, -999.9)).collect()
    assert [r[0] for r in got] == [None, None, None, 5.0, 500.0]
    assert [r[1] for r in got] == [None, 0.0, None, 5.0, 100.0]
    assert got[4][2] is None and got[3][2] == 5.0 and got[1][3] is None


def test_drop_invalid(spark):
    from geocadence.operators.project import drop_invalid
    d = spark.createDataFrame([(1, 1.0, "x", None), (2, -9999.0, "x", 1), (3, 1.0, "NoData", 1), (4, None, "x", 1)],
                              "id int, rain_v double, sm_t string, slips_n int")
    assert rows(drop_invalid(d), "id") == [(1,)]
    with pytest.raises(ValueError):
        S.stack_tables(d, d.drop("sm_t"))


def test_errors_are_raised(spark):
    d = spark.createDataFrame([(1,), (2,)], "v int")
    for bad in (lambda: S.require_single(d, "v").collect(),
                lambda: Z.require_time(spark.createDataFrame([("noon",)], "time string")).collect()):
        with pytest.raises(Exception):
            bad()
    a = spark.createDataFrame([("x", at("2024-01-01"))], "area string, time timestamp_ntz")
    b = spark.createDataFrame([("x", at("2024-01-05"))], "area string, time timestamp_ntz")
    with pytest.raises(Exception):
        S.coverage([("a", a), ("b", b)], ["area"]).collect()
    with pytest.raises(ValueError):
        S.merge_on_spine(a, [("rain", b.limit(0))], ["area", "time"], required=("rain",))
