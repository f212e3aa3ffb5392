"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geocadence.catalog.compare import compare, connect
from geocadence.llm.multi_index import Codebooks, Part, fitted, hard_negatives, half_bounds, positives_of, scaled, visited
from geocadence.llm.queries import LLM_ORACLES, LLM_QUERIES

DDL = "vec_id long, embedding array<float>, label int, part int, rank string"


def brute(rows, asked, k=5, most=3, scale=256):
    ok = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or len(v) != 8 or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(scale * float(np.float32(c))) for c in v]
        if max(map(abs, x)) <= math.isqrt(2**55 // 8) and (i not in ok or (label, x) < ok[i]):
            ok[i] = (label, x)
    out = []
    for q in asked:
        if q not in ok:
            continue
        label, v = ok[q]
        score = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, (_, w) in ok.items() if j != q)
        for s, j in [x for x in score if ok[x[1]][0] == label][:k]:
            found = [(t, n) for t, n in score if ok[n][0] != label and 50 * -s <= 100 * -t <= 95 * -s][:most]
            out += [(q, j, r, n, -s, -t) for r, (t, n) in enumerate(found, 1)]
    return sorted(out)


def vectors(n=900, seed=1, near=True):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(12, 8))
    x = (centres[g.integers(0, 12, n)] + 0.3 * g.normal(size=(n, 8)) if near else g.normal(size=(n, 8))).round(2)
    rows = [(i, x[i].tolist(), int(g.integers(0, 4)), 7, "r") for i in range(n)]
    rows += [(n + i, x[7].tolist(), i % 2, 1, "r") for i in range(90)]                          # one vector many times
    rows += [(2000, None, 0, 1, "r"), (2050, [0.0] * 8, 0, 1, "r"), (2100, [1.0, None] + [0.0] * 6, 0, 1, "r"), (2150, [float("nan")] + [1.0] * 7, 0, 1, "r"), (2200, x[3].tolist(), None, 1, "r"),
             (2250, [float("inf")] + [1.0] * 7, 0, 1, "r"), (2300, [1.0, 2.0], 0, 1, "r"), (None, x[3].tolist(), 0, 1, "r"), rows[5], rows[50], (50, x[9].tolist(), 1, 0, "other"),
             (2350, [3e30] * 8, 0, 1, "r"), (2400, [2e6] + [0.0] * 7, 0, 1, "r"), (2401, [2e5] + [0.0] * 7, 0, 1, "r"), (2402, [1.5e5, 1.0] + [0.0] * 6, 1, 1, "r"), (2450, [], 0, 1, "r"), (2500, x[0].tolist(), 99, 1, "r")]
    return rows


@pytest.mark.parametrize("near, bounds", [(True, {}), (False, {}), (True, {"most_held": 8 * 60, "most_asking": 8 * 4, "cell": 12}), (True, {"codes": 1}), (False, {"sample": 5, "cell": 2})])
def test_equals_all_pairs(spark, near, bounds):
    rows = vectors(near=near)
    df = spark.createDataFrame(rows, DDL).repartition(5)
    asked = df.where("vec_id % 50 = 0").select(F.col("vec_id").alias("any_name"))
    got = sorted(map(tuple, hard_negatives(df, asked, **bounds).collect()))
    want = brute(rows, range(0, 3000, 50))
    assert got == want and len(want) > 100


def test_other_numbers_of_rows(spark):
    rows = vectors(300, 3)
    df = spark.createDataFrame(rows, DDL).repartition(3)
    got = sorted(map(tuple, hard_negatives(df, spark.createDataFrame([(0,), (0,), (7,), (299,), (99999,)], "v long"), 2, 9).collect()))
    assert got == brute(rows, [0, 7, 299], 2, 9)


def test_few_rows_and_none(spark):
    one = spark.createDataFrame([(0, [1.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    assert hard_negatives(one, one.select("vec_id")).count() == 0
    none = one.where("vec_id < 0")
    assert hard_negatives(none, none.select("vec_id")).count() == 0 == hard_negatives(one, none.select("vec_id")).count()
    three = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1), (2, [0.7], 2)], "vec_id long, embedding array<double>, label int")
    assert [tuple(r) for r in hard_negatives(three, three.where("vec_id = 0").select("vec_id")).collect()] == [(0, 1, 1, 2, 65536, 256 * 179)]


def test_cells_come_by_falling_bound_and_bounds_hold():
    g = np.random.default_rng(2)
    x, q = g.integers(-200, 200, (400, 6)), g.integers(-200, 200, (9, 6))
    books = Codebooks((fitted(x[:, :3].astype(float), 7), fitted(x[:, 3:].astype(float), 5)))
    part = Part(x, np.arange(400), g.integers(0, 3, 400), books)
    assert sorted(part.vec) == list(range(400)) and part.at[-1] == 400
    first, second = part.bounds(q)
    for i in range(9):
        seen = list(visited(first[i], second[i]))
        bounds = [b for b, *_ in seen]
        assert bounds == sorted(bounds, reverse=True) and len({c[1:] for c in seen}) == len(seen) == len(first[i]) * len(second[i])
        for bound, a, b in seen:
            rows = part.x[part.at[a * len(second[i]) + b]:part.at[a * len(second[i]) + b + 1]]
            assert not len(rows) or (rows @ q[i]).max() <= bound + 1e-6
    assert half_bounds(np.zeros((2, 3)), books.halves[0], np.ones(7)).max() == 0


def test_a_certified_search_leaves_cells_out(monkeypatch):
    import geocadence.llm.multi_index as m
    monkeypatch.setattr(m, "STEP", 16)
    g = np.random.default_rng(3)
    x = np.rint(np.repeat(g.normal(size=(20, 6)) * 400, 50, axis=0) + g.normal(size=(1000, 6)) * 5).astype(np.int64)
    books = Codebooks((fitted(x[:, :3].astype(float), 12), fitted(x[:, 3:].astype(float), 12)))
    part = Part(x, np.arange(1000), np.zeros(1000, np.int64), books)
    read, scores = [], Part.scores
    monkeypatch.setattr(Part, "scores", lambda self, held, q: read.append(sum(b - a for a, b in held)) or scores(self, held, q))
    q = x[:1]
    got = [v for _, v, _ in positives_of(part, q, np.array([0]), np.array([0]), np.array([-np.inf]), 5)]
    every = x @ q[0]
    assert got == sorted(range(1, 1000), key=lambda j: (-every[j], j))[:5] and sum(read) < 500


def test_scaled(spark):
    rows = scaled(spark.createDataFrame(vectors(40), DDL)).collect()
    assert all(x == int(x) for r in rows for x in r.v) and len({r.vec_id for r in rows}) == len(rows)


def test_query_equals_its_sql(spark):
    ok, message = compare(spark, connect("/root/testdata/sf0.001"), "op11_multi_index", LLM_QUERIES["op11_multi_index"], LLM_ORACLES["op11_multi_index"], "/root/testdata/sf0.001")
    assert ok, message
