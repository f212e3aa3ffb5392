"""Kernel products in blocks and the iterative fit against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from geocadence.operators import kernel as K
from geocadence.operators import kernel_blocks as KB


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(70, 3)) * 0.6
    y = np.round(4 * np.sin(x[:, 0]) - 2 * x[:, 1] + rng.normal(size=70))
    df = spark.createDataFrame([(i, [float(v) for v in r], float(t), i % 3) for i, (r, t) in enumerate(zip(x, y))], "i int, x array<double>, y double, fold int")
    return x, y, df.repartition(4)


def gram(kind, a, b, param):
    d = ((a[:, None] - b[None]) ** 2).sum(2)
    if kind in ("linear", "polynomial"):
        return a @ b.T if kind == "linear" else (1 + a @ b.T) ** param
    return np.exp(-(d**2 if kind == "gaussian" else d) / (2 * param**2))


@pytest.mark.parametrize("kind, param", [("linear", 1), ("polynomial", 2), ("gaussian", 0.7), ("rbf", 0.7)])
def test_products_in_any_blocks(data, kind, param):
    x, y, df = data
    want = gram(kind, x, x, param) @ np.column_stack([y, y**2])
    points = df.select("x", "y", (F.col("y") * F.col("y")).alias("y2"))
    for blocks in ({}, {"row_block": 9, "point_block": 16}):
        got = KB.kernel_product(df, points, ["i"], ["y", "y2"], kind, param, **blocks).orderBy("i").collect()
        assert np.allclose([r[1:] for r in got], want)


def test_rows_without_features_and_no_points(spark, data):
    x, y, df = data
    odd = spark.createDataFrame([(1, [0.0, 0.0, 0.0]), (1, [0.0, 0.0, 0.0]), (2, [None, 1.0, 1.0]), (3, None), (4, [1.0])], "k int, x array<double>")
    train = df.select("x", F.col("y").alias("c"))
    got = {r.k: r.raw_score for r in K.score_direct(odd, train, ["k"], kind="rbf", param=1).collect()}
    assert np.isclose(got.pop(1), gram("rbf", np.zeros((1, 3)), x, 1)[0] @ y) and got == {2: None, 3: None, 4: None}
    assert {r.raw_score for r in K.score_direct(odd, train.where("false"), ["k"], kind="rbf").collect()} == {None}
    assert KB.kernel_product(odd.where("false"), train, ["k"], ["c"]).count() == 0
    with pytest.raises(ValueError):
        KB.kernel_block(x, x, "cubic")


@pytest.mark.parametrize("kind, param", [("gaussian", 0.7), ("rbf", 0.5)])
def test_fit_of_several_systems(data, kind, param):
    x, y, df = data
    systems = [(0.05, None), (0.2, 1), (1.0, 2)]
    got = KB.fit_dual(df, systems, kind=kind, param=param, fold="fold", row_block=30, point_block=25).orderBy("i").collect()
    for k, (lam, held) in enumerate(systems):
        rows = np.flatnonzero(np.arange(70) % 3 != held) if held is not None else np.arange(70)
        c = np.zeros(70)
        c[rows] = np.linalg.solve(gram(kind, x[rows], x[rows], param) + lam * len(rows) * np.eye(len(rows)), y[rows])
        assert np.allclose([r[f"c{k}"] for r in got], c, atol=1e-7)


def test_folds(data):
    x, y, df = data
    got = {(r.lam, r.fold): (r.train_err, r.valid_err) for r in KB.cross_validate_dual(df, 3, [0.1, 0.5], kind="rbf", param=0.5).collect()}
    for lam in (0.1, 0.5):
        for f in range(3):
            out = np.arange(70) % 3 == f
            c = np.linalg.solve(gram("rbf", x[~out], x[~out], 0.5) + lam * (~out).sum() * np.eye((~out).sum()), y[~out])
            e = (np.rint(gram("rbf", x, x[~out], 0.5) @ c) - y) ** 2
            assert np.allclose(got[lam, f], (e[~out].mean(), e[out].mean()))


def test_no_training_points(data):
    with pytest.raises(ValueError):
        KB.fit_dual(data[2].where("false"), [(1.0, None)])


@pytest.mark.parametrize("kind, param", [("linear", 1), ("polynomial", 3), ("gaussian", 5.0), ("rbf", 2.0)])
def test_expanded_products_need_no_pairs(data, kind, param):
    x, y, df = data
    points = df.select("x", "y", (F.col("y") * F.col("y")).alias("y2"))
    plan = KB.product_plan(df, points, 2, kind, param, expand=True)
    assert plan.expanded and plan.expanded.terms < KB.MOST_TERMS
    product = KB.kernel_product(df, points, ["i"], ["y", "y2"], kind, param, plan=plan)
    assert "FlatMapCoGroups" not in product._jdf.queryExecution().executedPlan().toString()
    want = gram(kind, x, x, param) @ np.column_stack([y, y**2])
    assert np.allclose([r[1:] for r in product.orderBy("i").collect()], want, rtol=1e-11, atol=1e-9)


def test_expansions_are_exact_to_the_radius_or_refused():
    rng = np.random.default_rng(1)
    for spread in (0.05, 0.3, 1.0):
        x = rng.uniform(-spread, spread, size=(300, 4))
        low, high = x.min(0), x.max(0)
        radius = np.linalg.norm(x - (low + high) / 2, axis=1).max()
        found = KB.expansion("gaussian", 0.5, low, high, radius)
        assert (found is None) == (spread == 1.0)
        if found:
            sums = found.sums(x, found.prepared(found.moments(x, np.eye(300)), 300))
            assert np.abs(sums - KB.kernel_block(x, x, "gaussian", 0.5)).max() < KB.EXACT
    assert KB.expansion("rbf", 0.01, low, high, 2.0) is None and KB.expansion("polynomial", 2.5, low, high, 2.0) is None
    assert KB.expansion("gaussian", 0.5, low, high * np.inf, 2.0) is None


def test_large_products_are_expanded_and_small_ones_are_not(spark):
    many = spark.range(20000).select(F.col("id").alias("i"), F.array(*[F.sin(F.col("id") * k) * 0.3 for k in (1, 2, 3, 5)]).alias("x"), F.lit(1.0).alias("c"))
    assert KB.product_plan(many, many, 1, "gaussian", 0.5).expanded and not KB.product_plan(many, many.limit(20), 1, "gaussian", 0.5).expanded


def test_expanded_fit_and_odd_rows(spark, data):
    x, y, df = data
    fit = [r.c0 for r in KB.fit_dual(df, [(0.2, None)], kind="gaussian", param=5.0, expand=True).orderBy("i").collect()]
    assert np.allclose(fit, np.linalg.solve(gram("gaussian", x, x, 5.0) + 14 * np.eye(70), y), atol=1e-7)
    odd = spark.createDataFrame([(1, [0.0, 0.0, 0.0]), (1, [0.0, 0.0, 0.0]), (2, [None, 1.0, 1.0]), (3, None), (4, [1.0])], "k int, x array<double>")
    got = {r.k: r.c for r in KB.kernel_product(odd, df.select("x", F.col("y").alias("c")), ["k"], ["c"], "rbf", 2, expand=True).collect()}
    assert np.isclose(got.pop(1), gram("rbf", np.zeros((1, 3)), x, 2)[0] @ y) and got == {}
    missing = df.select("x", F.when(F.col("i") > 0, F.col("y")).alias("c"))
    assert {r.c for r in KB.kernel_product(df, missing, ["i"], ["c"], "rbf", 2, expand=True).collect()} == {None}
