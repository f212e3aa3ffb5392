"""Kernel regression on Spark.

A polynomial kernel (1 + x.y)^p is a dot product of monomials, so a model with any number of training
points collapses to one weight per monomial (35 for four features and p = 3). Fitting sums the
monomial products in one pass; only that small matrix reaches the driver.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geocadence.model import KERNEL_FEATURES
from geocadence.operators.kernel_blocks import POINTS, kernel_product


# --- A12 -----------------------------------------------------------------------------------------
def feature_stats(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows (k, max, mean): the largest value and the mean after division by it."""
    one = df.agg(*[F.struct(F.lit(k).alias("k"), F.max(c).cast("double").alias("max"),
                            (F.avg(c) / F.max(c)).alias("mean")).alias(f"s{k}") for k, c in enumerate(features)])
    return one.select(F.inline(F.array(*[F.col(f"s{k}") for k in range(len(features))])))


def stats_arrays(stats: DataFrame) -> tuple[list[float], list[float]]:
    """The (max, mean) lists of a model; as many numbers as there are features."""
    rows = sorted(stats.select("k", "max", "mean").collect(), key=lambda r: r["k"])
    return [float(r["max"]) for r in rows], [float(r["mean"]) for r in rows]


def scale_features(x: list[Column], maxima: list[float], means: list[float]) -> list[Column]:
    """x / max - mean; extra statistics beyond the features are ignored."""
    return [c / F.lit(mx) - F.lit(mn) for c, mx, mn in zip(x, maxima, means)]


# --- A13 / A14 -----------------------------------------------------------------------------------
def mean_squared_error(df: DataFrame, predicted: str, observed: str, keys: list[str] | None = None) -> DataFrame:
    diff = F.col(predicted) - F.col(observed)
    return df.groupBy(*(keys or [])).agg(F.avg(diff * diff).alias("mse"))


def fold_statistics(errors: DataFrame, keys: list[str], train: str = "train_err", valid: str = "valid_err") -> DataFrame:
    """Median and population deviation of the fold errors per candidate, with the best candidate marked."""
    out = errors.groupBy(*keys).agg(
        F.median(train).alias("train_median"), F.stddev_pop(train).alias("train_std"),
        F.median(valid).alias("valid_median"), F.stddev_pop(valid).alias("valid_std"))
    best = F.min("valid_median").over(Window.partitionBy())  # one row per candidate: the errors are computed once
    return out.withColumn("is_best", F.col("valid_median") == best)


# --- M1 ------------------------------------------------------------------------------------------
def feature_columns(df: DataFrame, features=KERNEL_FEATURES) -> list[str]:
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"missing feature columns: {absent}")
    return list(features)


def feature_array(df: DataFrame, features=KERNEL_FEATURES, alias: str = "x") -> DataFrame:
    """Features as one array, in model order."""
    return df.withColumn(alias, F.array(*[F.col(c).cast("double") for c in feature_columns(df, features)]))


# --- M3 ------------------------------------------------------------------------------------------
def dot(x: Column, y: Column, features: int | None = None) -> Column:
    """Dot product of two arrays; with a known length it is plain arithmetic on their entries."""
    if features:
        return _sum([F.get(x, F.lit(k)) * F.get(y, F.lit(k)) for k in range(features)])
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def _sum(terms: list[Column]) -> Column:
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def square_distance(x: Column, y: Column, features: int | None = None) -> Column:
    if features:
        gaps = [F.get(x, F.lit(k)) - F.get(y, F.lit(k)) for k in range(features)]
        return _sum([g * g for g in gaps])
    return F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def kernel_value(x: Column, y: Column, kind: str = "polynomial", param: float = 3, features: int | None = None) -> Column:
    """Kernel of two arrays. ``gaussian`` squares the squared distance, as the model it must agree with
    does; ``rbf`` is the usual radial function."""
    if kind == "linear":
        return dot(x, y, features)
    if kind == "polynomial":
        return F.pow(dot(x, y, features) + 1.0, F.lit(float(param)))
    spread = 2.0 * float(param) ** 2
    if kind == "gaussian":
        return F.exp(-F.pow(square_distance(x, y, features), F.lit(2.0)) / spread)
    if kind == "rbf":
        return F.exp(-square_distance(x, y, features) / spread)
    raise ValueError(f"unknown kernel {kind!r}")


# --- monomials -----------------------------------------------------------------------------------
def monomials(d: int, p: int, kind: str = "polynomial") -> list[tuple[int, ...]]:
    """Exponent tuples of the feature map, by total degree."""
    if kind == "linear":
        return [tuple(1 if i == j else 0 for j in range(d)) for i in range(d)]
    out = []
    for degree in range(p + 1):
        for combo in itertools.combinations_with_replacement(range(d), degree):
            out.append(tuple(combo.count(j) for j in range(d)))
    return out


def monomial_factor(e: tuple[int, ...], p: int, kind: str = "polynomial") -> float:
    if kind == "linear":
        return 1.0
    rest = p - sum(e)
    return math.factorial(p) / (math.factorial(rest) * math.prod(math.factorial(k) for k in e))


def monomial_column(z: list[Column], e: tuple[int, ...]) -> Column:
    out = None
    for c, k in zip(z, e):
        for _ in range(k):
            out = c if out is None else out * c
    return F.lit(1.0) if out is None else out


# --- M2 ------------------------------------------------------------------------------------------
@dataclass
class KernelModel:
    """Collapsed model: the score of z is the sum of weight * monomial(z)."""

    features: int
    power: int
    weights: list[float]
    kind: str = "polynomial"
    maxima: list[float] = field(default_factory=list)
    means: list[float] = field(default_factory=list)

    def score(self, x: list[Column]) -> Column:
        z = scale_features(x, self.maxima, self.means) if self.maxima else x
        terms = [monomial_column(z, e) * F.lit(float(w))
                 for e, w in zip(monomials(self.features, self.power, self.kind), self.weights)]
        # a balanced sum keeps the expression tree shallow
        while len(terms) > 1:
            terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        return terms[0]


def collapse_model(train: DataFrame, features: int, power: int = 3, kind: str = "polynomial",
                   maxima: list[float] | None = None, means: list[float] | None = None) -> KernelModel:
    """Weights of the collapsed model from training points (i, x ARRAY, c): one aggregate over them.

    Only the first ``features`` entries of x are used, as for the statistics.
    """
    z = [F.get("x", F.lit(k)) for k in range(features)]
    exps = monomials(features, power, kind)
    row = train.agg(*[F.sum(F.col("c") * monomial_column(z, e)).alias(f"w{k}") for k, e in enumerate(exps)]).first()
    if row[0] is None:
        raise ValueError("the training table is empty")
    weights = [float(row[k]) * monomial_factor(e, power, kind) for k, e in enumerate(exps)]
    return KernelModel(features, power, weights, kind, maxima or [], means or [])


def score_collapsed(df: DataFrame, model: KernelModel, features: list[str], out: str = "raw_score") -> DataFrame:
    """M2, collapsed: a narrow projection without any join."""
    return df.withColumn(out, model.score([F.col(c).cast("double") for c in features]))


def score_direct(df: DataFrame, train: DataFrame, keys: list[str], x: str = "x", kind: str = "polynomial",
                 param: float = 3, out: str = "raw_score", block: int = POINTS, features: int | None = None) -> DataFrame:
    """M2, direct, for kernels without a small feature map (and as a check of the collapsed form).

    Blocks of rows meet blocks of ``block`` training points (x, c) and kernel values are multiplied there, so pairs are never
    emitted and no task holds the model. Rows that repeat a key share its score; a null feature has no score.
    """
    scored = kernel_product(df.select(*keys, F.col(x).alias("x")), train.select("x", F.col("c").alias(out)), keys, [out], kind, param, features=features, point_block=block)
    return df.join(scored, keys, "left")


def predicted_count(raw: Column) -> Column:
    """Half-even rounding, negatives to 0, integer; a missing score has no count."""
    return F.when(raw < 0, F.lit(0.0)).otherwise(F.rint(raw)).cast("int")


# --- M4 ------------------------------------------------------------------------------------------
def gram_sums(df: DataFrame, x: str, y: str | None, exps: list[tuple[int, ...]], fold: str | None = None) -> DataFrame:
    """Sums of monomial products, long form (fold, i, j, v): j = m holds sums with y, (m, m) the row count.

    Every task adds up its own rows with numpy and emits one small matrix per fold; Spark adds those.
    """
    m, powers = len(exps), np.array(exps, dtype=float)
    names = [f"x{k}" for k in range(powers.shape[1])]

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            if not len(pdf):
                continue
            phi = _design(pdf[names].to_numpy(dtype=float), powers)
            wide = np.column_stack([phi, pdf["y"].to_numpy(dtype=float)])
            folds = pdf["fold"].to_numpy()
            for f in np.unique(folds):
                part = wide[folds == f]
                g = np.zeros((m + 1, m + 1))
                g[:m, :] = part[:, :m].T @ part
                g[m, m] = len(part)
                sums[int(f)] = sums.get(int(f), 0) + g
        import pandas as pd
        ii, jj = np.meshgrid(np.arange(m + 1), np.arange(m + 1), indexing="ij")
        for f, g in sums.items():
            yield pd.DataFrame({"fold": f, "i": ii.ravel(), "j": jj.ravel(), "v": g.ravel()})

    base = df.select(
        *[F.get(x, F.lit(k)).cast("double").alias(n) for k, n in enumerate(names)], (F.col(y).cast("double") if y else F.lit(0.0)).alias("y"),
        (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"))
    return base.mapInPandas(partial, "fold int, i int, j int, v double").groupBy("fold", "i", "j").agg(F.sum("v").alias("v"))


def _design(x: np.ndarray, powers: np.ndarray) -> np.ndarray:
    phi = np.ones((len(x), len(powers)))
    for j in range(powers.shape[1]):
        for k in range(1, int(powers[:, j].max(initial=0)) + 1):
            phi[:, powers[:, j] >= k] *= x[:, [j]]
    return phi


def _gram_matrices(sums: DataFrame, m: int) -> dict[int, np.ndarray]:
    out: dict[int, np.ndarray] = {}
    for r in sums.collect():  # (m + 1)^2 numbers per fold
        out.setdefault(r["fold"], np.zeros((m + 1, m + 1)))[r["i"], r["j"]] = r["v"]
    return out


def _solve(gram: np.ndarray, scale: np.ndarray, lam: float, sub: np.ndarray) -> np.ndarray:
    """Raw monomial weights of the ridge solution for the monomials in ``sub``."""
    n = gram[-1, -1]
    g = gram[np.ix_(sub, sub)] * np.outer(scale, scale)
    b = gram[sub, -1] * scale
    a = g + lam * n * np.eye(len(sub))
    try:
        low = np.linalg.cholesky(a)
        w = np.linalg.solve(low.T, np.linalg.solve(low, b))
    except np.linalg.LinAlgError:
        w = np.linalg.lstsq(a, b, rcond=None)[0]
    return w * scale


def fit_kernel(df: DataFrame, features: int, lam: float, x: str = "x", y: str = "y", power: int = 3,
               kind: str = "polynomial") -> KernelModel:
    """Solves (K + lam n I) c = y in monomial space: one pass, then a small solve."""
    exps = monomials(features, power, kind)
    gram = _gram_matrices(gram_sums(df, x, y, exps), len(exps))[0]
    scale = np.sqrt([monomial_factor(e, power, kind) for e in exps])
    weights = _solve(gram, scale, lam, np.arange(len(exps)))
    return KernelModel(features, power, [float(w) for w in weights], kind)


def dual_coefficients(df: DataFrame, model: KernelModel, lam: float, n: int, x: str = "x", y: str = "y") -> DataFrame:
    """Coefficient of every training row: (y - f(x)) / (lam n), a projection."""
    cols = [F.get(x, F.lit(k)) for k in range(model.features)]
    return df.withColumn("c", (F.col(y) - model.score(cols)) / F.lit(lam * n))


# --- M5 ------------------------------------------------------------------------------------------
def with_fold(df: DataFrame, key: str, folds: int, seed: int = 0) -> DataFrame:
    """Fold by a seeded hash of a stored key, so the split survives a recomputed task."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int"))


def cross_validate(df: DataFrame, features: int, folds: int, lams: list[float], powers: list[int],
                   x: str = "x", y: str = "y", fold: str = "fold") -> DataFrame:
    """Errors per (lambda, exponent, fold): two passes over the data for any number of candidates.

    The first pass sums one Gram matrix per fold for the largest exponent; training sums of a fold are the
    total minus its own. The second pass adds squared errors of the rounded scores for all candidates.
    """
    top = max(powers)
    exps = monomials(features, top)
    grams = _gram_matrices(gram_sums(df, x, y, exps, fold), len(exps))
    total = sum(grams.values())
    degree = np.array([sum(e) for e in exps])
    plan = []
    for lam in lams:
        for p in powers:
            sub = np.flatnonzero(degree <= p)
            scale = np.sqrt([monomial_factor(exps[i], p) for i in sub])
            for f in range(folds):
                w = np.zeros(len(exps))
                w[sub] = _solve(total - grams.get(f, 0 * total), scale, lam, sub)
                plan.append((float(lam), int(p), f, w))
    weights = np.array([w for *_, w in plan]).T
    own = np.array([f for _, _, f, _ in plan])
    power_table = np.array(exps, dtype=float)
    names = [f"x{k}" for k in range(features)]

    def errors(batches):
        import pandas as pd
        acc = np.zeros((len(plan), 4))
        for pdf in batches:
            if not len(pdf):
                continue
            phi = _design(pdf[names].to_numpy(dtype=float), power_table)
            sq = (np.rint(phi @ weights) - pdf["y"].to_numpy(dtype=float)[:, None]) ** 2
            valid = pdf["fold"].to_numpy()[:, None] == own[None, :]
            acc += np.column_stack([
                np.where(valid, 0, sq).sum(0), (~valid).sum(0), np.where(valid, sq, 0).sum(0), valid.sum(0)])
        yield pd.DataFrame(
            [(lam, p, f, *acc[k]) for k, (lam, p, f, _) in enumerate(plan)],
            columns=["lam", "power", "fold", "ts", "tn", "vs", "vn"])

    base = df.select(*[F.get(x, F.lit(k)).cast("double").alias(n) for k, n in enumerate(names)],
                     F.col(y).cast("double").alias("y"), F.col(fold).alias("fold"))
    parts = base.mapInPandas(errors, "lam double, power int, fold int, ts double, tn double, vs double, vn double")
    return parts.groupBy("lam", "power", "fold").agg(
        F.try_divide(F.sum("ts"), F.sum("tn")).alias("train_err"),
        F.try_divide(F.sum("vs"), F.sum("vn")).alias("valid_err"))


# --- M6 ------------------------------------------------------------------------------------------
@dataclass
class Components:
    mean: list[float]
    vectors: list[list[float]]
    explained: list[float]


def principal_components(df: DataFrame, d: int, k: int, x: str = "x") -> Components:
    """First k axes of the sample covariance and the cumulative percent among those k.

    The cross products come from the same one-pass sums; the sign of an axis is fixed so that its
    largest entry is positive.
    """
    exps = monomials(d, 1)
    g = _gram_matrices(gram_sums(df, x, None, exps), len(exps))[0]
    n, s, xx = g[-1, -1], g[0, 1:-1], g[1:-1, 1:-1]
    mean = s / n
    cov = (xx - n * np.outer(mean, mean)) / (n - 1)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:k]
    axes = vectors[:, order].T
    axes *= np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(1)])[:, None]
    share = values[order] / values[order].sum() * 100
    return Components(mean.tolist(), axes.tolist(), np.cumsum(share).tolist())


def project_components(df: DataFrame, pc: Components, x: str = "x", prefix: str = "pc") -> DataFrame:
    centre = F.array(*[F.lit(float(v)) for v in pc.mean])
    centred = F.zip_with(F.col(x), centre, lambda a, b: a - b)
    return df.withColumn("_z", centred).withColumns({
        f"{prefix}{i + 1}": dot(F.col("_z"), F.array(*[F.lit(float(v)) for v in axis]))
        for i, axis in enumerate(pc.vectors)}).drop("_z")


# --- M7 / F3 -------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Methods:
    """Prediction methods by name."""

    functions: dict[str, Callable]

    def active(self, settings: dict[str, dict]) -> tuple[Callable, dict]:
        """The function of the one method whose settings are marked ``active``, and its other settings."""
        on = [name for name, own in settings.items() if own.get("active")]
        if len(on) != 1:
            raise ValueError(f"exactly one method must be active, found {sorted(on)}")
        if on[0] not in self.functions:
            raise NotImplementedError(f"method {on[0]!r} is not among {sorted(self.functions)}")
        return self.functions[on[0]], {k: v for k, v in settings[on[0]].items() if k != "active"}
