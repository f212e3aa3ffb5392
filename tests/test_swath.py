"""Nearest cells of grids given by coordinates against brute force."""

import numpy as np
import pytest

from geocadence.model import EARTH_RADIUS_M
from geocadence.operators.swath import swath_map

T, C = "id long, lon double, lat double", "row int, col int, lon double, lat double"


def _brute(targets, cells, k, radius):
    out = {}
    c = np.array([x[2:] for x in cells if None not in x]).reshape(-1, 2)
    names = [x[:2] for x in cells if None not in x]
    for i, lon, lat in targets:
        if lon is None or lat is None or not len(c):
            continue
        lam, phi, lam1, phi1 = np.radians(lon), np.radians(lat), np.radians(c[:, 0]), np.radians(c[:, 1])
        a = np.sin((phi1 - phi) / 2) ** 2 + np.cos(phi) * np.cos(phi1) * np.sin((lam1 - lam) / 2) ** 2
        d = 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(1, a)))
        best = sorted((x, *n) for x, n in zip(d, names) if x <= radius)[:k]
        if best:
            out[i] = best
    return out


def _check(spark, targets, cells, k, radius):
    t, c = spark.createDataFrame(targets, T), spark.createDataFrame(cells, C)
    got = {}
    for r in swath_map(t, c, ["id"], k=k, radius_m=radius).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r)
    want = _brute(targets, cells, k, radius)
    assert set(got) == set(want)
    for i, rows in got.items():
        assert [r["rank"] for r in rows] == list(range(len(want[i])))
        assert np.allclose([r["dist_m"] for r in rows], [w[0] for w in want[i]], atol=1e-3)
        for r, w in zip(rows, want[i]):  # the same cell, but for ties below rounding
            assert (r["src_row"], r["src_col"]) == w[1:] or abs(r["dist_m"] - w[0]) < 1e-6


@pytest.mark.parametrize("k,radius", [(1, 25000.0), (5, 60000.0), (40, 3000000.0)])
def test_uneven_density_date_line_and_poles(spark, k, radius):
    rng = np.random.default_rng(k)
    places = [rng.normal((179.95, 12.0), 0.2, (150, 2)), rng.normal((8.0, 44.0), 0.002, (150, 2)), rng.uniform((-180, -90), (180, 90), (60, 2)),
              np.column_stack([rng.uniform(-180, 180, 60), 89.7 + rng.random(60) * 0.3])]
    cells = np.vstack(places)
    cells[:, 0] = (cells[:, 0] + 180) % 360 - 180
    near = cells[rng.permutation(len(cells))[:80]] + rng.normal(0, 0.1, (80, 2))
    near[:, 1] = np.clip(near[:, 1], -90, 90)
    targets = [(i, float(x), float(y)) for i, (x, y) in enumerate(near)]
    _check(spark, targets, [(i // 50, i % 50, float(x), float(y)) for i, (x, y) in enumerate(cells)], k, radius)


def test_ties_repeated_places_nulls_and_nothing(spark):
    cells = [(1, 1, 8.0, 44.0), (0, 5, 8.0, 44.0), (0, 2, 8.0, 44.0), (2, 0, None, 44.0), (3, 3, 8.1, 44.0), (4, 4, 7.9, 44.0)] + [(9, i, 8.0, 44.05) for i in range(70)]
    targets = [(1, 8.0, 44.0), (2, 8.0, None), (3, 20.0, 10.0), (4, 8.0, 44.05), (5, 8.05, 44.0)]
    _check(spark, targets, cells, 4, 20000.0)
    _check(spark, targets, cells, 500, 20000.0)
    got = swath_map(spark.createDataFrame(targets, T), spark.createDataFrame(cells, C), ["id"], k=2).filter("id = 1").orderBy("rank").collect()
    assert [(r["src_row"], r["src_col"]) for r in got] == [(0, 2), (0, 5)]
    empty = spark.createDataFrame([], C)
    assert swath_map(spark.createDataFrame(targets, T), empty, ["id"]).count() == 0
    assert swath_map(spark.createDataFrame([], T), spark.createDataFrame(cells, C), ["id"]).count() == 0
