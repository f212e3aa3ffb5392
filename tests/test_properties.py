"""Laws that must hold on generated data."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from geocadence.functions.geo import Grid
from geocadence.operators import grid as G
from geocadence.operators import series as R
from geocadence.operators import timespine as Z
from geocadence.plans import indicators as PI

START = datetime(2023, 12, 20)


def hourly(spark, n=900, keys=("a", "b"), seed=1, holes=0.05):
    rng = random.Random(seed)
    data = [(k, START + timedelta(hours=h), None if rng.random() < 0.02 else round(rng.random() * 9, 2))
            for k in keys for h in range(n) if rng.random() >= holes]
    return data, spark.createDataFrame(data, "area string, time timestamp_ntz, value double")


@pytest.mark.parametrize("direction", ["right", "left"])
def test_rolling_equals_pandas_across_chunk_borders(spark, direction):
    data, df = hourly(spark)
    got = {(r["area"], r["time"]): (r["r_1"], r["r_5"], r["r_24"]) for r in R.rolling_exact(
        df, ["area"], (1, 5, 24), prefix="r", direction=direction, chunk=48).collect()}
    assert len(got) == len(data)
    pdf = pd.DataFrame(data, columns=["area", "time", "value"])
    for area, g in pdf.groupby("area"):
        s = g.set_index("time")["value"].astype(float).asfreq("h")
        if direction == "left":
            s = s[::-1]
        want = {n: s.rolling(n).sum() for n in (1, 5, 24)}
        for t in g["time"]:
            for n, v in zip((1, 5, 24), got[area, t.to_pydatetime()]):
                w = want[n][t]
                assert (v is None and np.isnan(w)) or v == pytest.approx(w)


def test_width_one_is_the_value_itself(spark):
    data, df = hourly(spark, 100)
    out = R.rolling_exact(df, ["area"], (1,), prefix="r")
    assert out.filter(~F.col("r_1").eqNullSafe(F.col("value"))).count() == 0


def test_sum_is_never_below_the_largest_member(spark):
    _, df = hourly(spark, 200)
    out = R.rolling_exact(df, ["area"], (3,), prefix="r")
    assert out.filter(F.col("r_3") < F.col("value")).count() == 0


def test_gap_filling_leaves_no_gap(spark):
    _, df = hourly(spark, 900, holes=0.97)
    days = df.select("area", F.col("time").cast("date").alias("time")).distinct()
    out = Z.fill_missing_days(days, ["area"], end=F.lit("2024-01-31"))
    b = out.groupBy("area").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("lo"), F.max("time").alias("hi"))
    assert b.filter(F.col("n") != F.datediff("hi", "lo") + 1).count() == 0


def test_regrid_of_a_grid_onto_itself_is_identity(spark):
    g = Grid(7, 9, 8.0, 44.0, 0.3)
    m = G.regrid_map(G.grid_cells(spark, g).drop("value"), g)
    assert m.filter((F.col("row") != F.col("src_row")) | (F.col("col") != F.col("src_col"))).count() == 0 and m.count() == 63


@pytest.mark.parametrize("k", [1, 4, 9])
@pytest.mark.parametrize("lat0", [0.0, 44.0, 70.0])
def test_nearest_cells_equal_brute_force(spark, k, lat0):
    g = Grid(12, 14, 8.0, lat0, 0.1)
    rng = np.random.default_rng(k)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(rng.uniform(7.9, 9.6, 60), rng.uniform(lat0 - 0.1, lat0 + 1.3, 60)))]
    m = G.regrid_map(spark.createDataFrame(pts, "id int, lon double, lat double"), g, k, 40000.0)
    got = {}
    for r in m.collect():
        got.setdefault(r["id"], []).append((r["rank"], r["dist_m"]))
    rr, cc = np.meshgrid(np.arange(12), np.arange(14), indexing="ij")
    lon, lat = np.radians(g.lon0 + cc * 0.1), np.radians(g.lat0 - rr * 0.1)
    for i, x, y in pts:
        x, y = np.radians(x), np.radians(y)
        a = np.sin((lat - y) / 2) ** 2 + np.cos(lat) * np.cos(y) * np.sin((lon - x) / 2) ** 2
        d = np.sort((2 * 6371000 * np.arcsin(np.sqrt(a))).ravel())
        want = d[d <= 40000][:k]
        have = [v for _, v in sorted(got.get(i, []))]
        assert len(have) == len(want) and np.allclose(have, want, atol=0.01)


def test_mosaic_order_and_missing(spark):
    rows_in = [(0, 0, 1, 1.0), (0, 0, 2, 2.0), (0, 1, 1, 5.0), (0, 1, 2, float("nan")), (1, 0, 1, None), (1, 1, 1, -9999.0), (1, 1, 2, None)]
    d = spark.createDataFrame(rows_in, "row int, col int, domain_order int, value double")
    assert rows(G.mosaic(d, [], no_data=-9999.0)) == [(0, 0, 2.0), (0, 1, 5.0), (1, 0, None), (1, 1, None)]


def test_thinned_files_keep_their_distance(spark):
    rng = random.Random(3)
    f = [("g", START + timedelta(minutes=rng.randrange(1440)), f"p{i}") for i in range(300)]
    out = R.thin_by_minutes(spark.createDataFrame(f, "g string, time timestamp_ntz, path string"), ["g"], 37)
    times = sorted(r["time"] for r in out.collect())
    assert all(b - a >= timedelta(minutes=37) for a, b in zip(times, times[1:])) and times[0] == min(t for _, t, _ in f)


def test_rasterized_cells_equal_point_in_polygon(spark):
    from geocadence.operators.alerts import locate_points
    ring = [{"x": 8.013, "y": 44.017}, {"x": 8.411, "y": 44.103}, {"x": 8.291, "y": 44.377}, {"x": 8.207, "y": 44.201}, {"x": 8.051, "y": 44.333}]
    poly = spark.createDataFrame([("P", ring)], "alert_area_code string, ring array<struct<x:double,y:double>>")
    got = rows(G.rasterize(poly, 0.01), "row", "col")
    box = Grid(36, 40, 8.013, 44.017, 0.01)
    cells = G.grid_cells(spark, box).drop("value")
    want = rows(locate_points(cells, poly, bin_deg=0.07).filter("alert_area_code_polygon IS NOT NULL"), "row", "col")
    assert got == want and len(got) > 300


# --- the regridded, masked reference form of the indicators against the collapsed one --------------------
def test_indicators_equal_the_fine_grid_computation(spark):
    src, fine = Grid(4, 4, 8.0, 44.0, 0.1), Grid(8, 8, 8.0, 44.0, 0.05)
    rng = np.random.default_rng(7)
    hours = 26
    vals = rng.gamma(1.0, 2.0, (hours, 4, 4)).round(2)
    vals[rng.random(vals.shape) < 0.01] = np.nan
    run = datetime(2024, 2, 29, 14)
    first = datetime(2024, 2, 28, 0)
    data = [(first + timedelta(hours=h), r, c, float(vals[h, r, c])) for h in range(hours) for r in range(4) for c in range(4)]
    cells = spark.createDataFrame(data, "time timestamp_ntz, row int, col int, value double").withColumn(
        "value", F.when(~F.isnan("value"), F.col("value")))
    mask = {(r, c): int((r * 8 + c) % 5 != 0) for r in range(8) for c in range(8)}
    area = {k: "A" if k[0] < 5 else "B" for k in mask}
    fm = G.grid_cells(spark, fine).select(
        F.when(F.col("row") < 5, "A").otherwise("B").alias("area"), F.col("row").alias("trow"), F.col("col").alias("tcol"), "lon", "lat",
        F.when(F.pmod(F.col("row") * 8 + F.col("col"), F.lit(5)) != 0, 1).otherwise(0).alias("mask"))
    mapping, weights = PI.area_geometry(fm, src)
    circles_in = {("A", 0): [(0, 1), (1, 1), (2, 2), (3, 4)], ("A", 1): [(4, 6), (4, 7), (3, 6)], ("B", 0): [(5, 1), (6, 2), (7, 3)]}
    members = [(a, p, r, c) for (a, p), cs in circles_in.items() for r, c in cs if mask[r, c]]
    circles = PI.source_circles(spark.createDataFrame(members, "area string, point_id int, trow int, tcol int"), mapping)
    windows = Z.run_window(spark.createDataFrame([(run,)], "run timestamp_ntz"), 24, 0, snap_end="none").select("time_run", "window_start", "window_end")
    out = {r["area"]: r for r in PI.rain_indicators(cells, Z.period_blocks(windows, 24, 24), weights, circles).collect()}

    period = vals[1:25]  # 01:00 .. 24:00 of 28 February
    grown = period.repeat(2, axis=1).repeat(2, axis=2)
    for a in ("A", "B"):
        keep = np.array([[mask[r, c] and area[r, c] == a for c in range(8)] for r in range(8)], dtype=bool)
        masked = np.where(keep, grown, np.nan)
        series = pd.Series(np.nanmean(masked.reshape(24, -1), axis=1))
        for w in (3, 6, 12, 24):
            roll = np.full_like(masked, np.nan)
            for h in range(w - 1, 24):
                roll[h] = masked[h - w + 1:h + 1].sum(axis=0)
            per = []
            for (ca, p), cs in circles_in.items():
                cs = [k for k in cs if mask[k]]
                if ca == a:
                    block = np.stack([roll[:, r, c] for r, c in cs], axis=1)
                    per.append(pd.DataFrame(block).max(axis=1))
            peaks = pd.concat(per, axis=1)
            acc = series.rolling(w).sum().dropna()
            row = out[a].asDict()
            want = {f"rain_peak_{w}H:max": peaks.max().max(), f"rain_peak_{w}H:avg": peaks.stack().mean(),
                    f"rain_average_{w}H:avg": (acc / w).mean(), f"rain_average_{w}H:max": (acc / w).max(), f"rain_average_{w}H:min": (acc / w).min(),
                    f"rain_accumulated_{w}H:max": acc.max(), f"rain_accumulated_{w}H:min": acc.min()}
            for k, v in want.items():
                assert (row[k] is None and np.isnan(v)) or row[k] == pytest.approx(v), (a, k)
