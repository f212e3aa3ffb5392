"""Kernel operators against numpy on small data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from geocadence.operators import kernel as K


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 4)) * 0.5
    y = np.round(3 * x[:, 0] - 2 * x[:, 1] * x[:, 2] + rng.normal(size=60)) + 3
    df = spark.createDataFrame([(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))], "i int, x array<double>, y double")
    return x, y, df.repartition(5)


def poly(a, b, p):
    return (1 + a @ b.T) ** p


def test_fit_equals_the_dual_solution(data):
    x, y, df = data
    lam = 0.05
    c = np.linalg.solve(poly(x, x, 3) + lam * 60 * np.eye(60), y)
    model = K.fit_kernel(df, 4, lam)
    out = K.dual_coefficients(df, model, lam, 60).select("i", "c").collect()
    assert np.allclose([r["c"] for r in sorted(out)], c, atol=1e-7)


def test_linear_fit(data):
    x, y, df = data
    c = np.linalg.solve(x @ x.T + 0.1 * 60 * np.eye(60), y)
    model = K.fit_kernel(df, 4, 0.1, kind="linear", power=1)
    got = [r[0] for r in df.orderBy("i").select(model.score([F.col("x")[k] for k in range(4)])).collect()]
    assert np.allclose(got, x @ x.T @ c, atol=1e-8)


def test_collapsed_equals_direct_for_any_block_size(spark, data):
    x, y, df = data
    train = df.select("i", "x", ((F.col("y") - 3) / 10).alias("c"))
    model = K.collapse_model(train, 4, 3)
    a = df.select("i", model.score([F.col("x")[k] for k in range(4)]).alias("s")).orderBy("i").collect()
    want = poly(x, x, 3) @ ((y - 3) / 10)
    assert np.allclose([r["s"] for r in a], want)
    for block in (7, 1000):
        b = K.score_direct(df.select("i", "x"), train, ["i"], block=block).orderBy("i").collect()
        assert np.allclose([r["raw_score"] for r in b], want)


def test_scaled_model(data):
    x, y, df = data
    mx, mean = [2.0, 3.0, 4.0, 5.0], [0.1, 0.2, 0.3, 0.4]
    train = df.select("i", "x", (F.col("y") / 10).alias("c"))
    model = K.collapse_model(train, 4, 3, maxima=mx, means=mean)
    got = [r[0] for r in df.orderBy("i").select(model.score([F.col("x")[k] for k in range(4)])).collect()]
    assert np.allclose(got, poly(x / mx - mean, x, 3) @ (y / 10))


def test_cross_validation(data):
    x, y, df = data
    folds = df.withColumn("fold", F.pmod("i", F.lit(4)))
    out = {(r["lam"], r["power"], r["fold"]): (r["train_err"], r["valid_err"]) for r in K.cross_validate(folds, 4, 4, [0.01, 0.1], [1, 3]).collect()}
    assert len(out) == 16
    for lam in (0.01, 0.1):
        for p in (1, 3):
            for f in range(4):
                v = np.arange(60) % 4 == f
                xt, yt = x[~v], y[~v]
                c = np.linalg.solve(poly(xt, xt, p) + lam * len(xt) * np.eye(len(xt)), yt)
                err = lambda a, b: np.mean((np.round(poly(a, xt, p) @ c) - b) ** 2)
                assert out[lam, p, f] == pytest.approx((err(xt, yt), err(x[v], y[v])))


def test_fold_statistics(spark):
    e = spark.createDataFrame([("a", 1.0, 4.0), ("a", 3.0, 2.0), ("b", 1.0, 9.0)], "c string, train_err double, valid_err double")
    got = {r["c"]: r for r in K.fold_statistics(e, ["c"]).collect()}
    assert got["a"]["valid_median"] == 3.0 and got["a"]["train_std"] == 1.0 and got["a"]["is_best"] and not got["b"]["is_best"]


def test_principal_components(data):
    x, _, df = data
    pc = K.principal_components(df, 4, 2)
    vals, vecs = np.linalg.eigh(np.cov(x.T))
    top = vals[::-1][:2]
    assert np.allclose(pc.explained, np.cumsum(top / top.sum() * 100))
    out = K.project_components(df, pc).orderBy("i").collect()
    got = np.array([[r["pc1"], r["pc2"]] for r in out])
    want = (x - x.mean(0)) @ vecs[:, ::-1][:, :2]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-8)


def test_half_even_rounding(spark):
    d = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (-3.2,)], "v double")
    assert [r[0] for r in d.select(K.predicted_count(F.col("v"))).collect()] == [0, 2, 2, 0, 0]


def test_features_and_methods(spark):
    d = spark.createDataFrame([(1.0,)], "sm_value_first double")
    with pytest.raises(ValueError):
        K.feature_columns(d)
    with pytest.raises(ValueError):
        K.Methods({}).active({"a": {"active": True}, "b": {"active": True}})
    with pytest.raises(NotImplementedError):
        K.Methods({}).active({"a": {"active": True}})
