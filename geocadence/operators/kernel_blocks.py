"""Kernel models of any kind at scale (M2, M4, M5): kernel products in blocks and an iterative fit.

Kernels without a small feature map need every pair of a row and a training point. Rows and training points are dealt to
blocks of bounded size by hash; a block of rows meets a block of points in one group, where numpy computes their kernel
values and multiplies them with the points' coefficients, so pairs never become rows and no task holds a whole side.

Pairs grow with the square of the tables. A smooth kernel is therefore expanded where that is cheaper: it is a function of
|x|^2 + |y|^2 - 2 x.y, so a polynomial of it that meets the kernel to ``EXACT`` over all distances that can occur falls into products of a function
of x and one of y. Sums over the points of the latter (moments) are all that rows need, and work grows with rows plus points. Kernels
that bend too much for the spread of the data, or have too many features, stay with the blocks.

A fit solves (K + lambda n I) c = y by conjugate residuals, which need K only in products and also hold for kernels that are not
positive (the squared ``gaussian`` is none). The vectors of the iteration are columns of a table beside the training points, a row per
point; each step is one product for all candidates and folds together, and only a few sums per candidate reach the driver.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geocadence.session import discard, stored

ROWS, POINTS = 2048, 2048  # rows and training points in a group
EXACT = 1e-12  # largest error of an expanded kernel value, as a part of the largest: sums of doubles are no better
MOST_TERMS = 100_000  # terms of an expansion: 800 KB a value column
TERM = 16  # terms that cost as much as a pair in a block


def kernel_block(a: np.ndarray, b: np.ndarray, kind: str = "polynomial", param: float = 3) -> np.ndarray:
    """Kernel values of every row of a with every row of b."""
    if kind == "linear":
        return a @ b.T
    if kind == "polynomial":
        return (a @ b.T + 1.0) ** float(param)
    if kind not in ("gaussian", "rbf"):
        raise ValueError(f"unknown kernel {kind!r}")
    gap = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        gap += (a[:, [k]] - b[:, k]) ** 2
    return np.exp(-(gap**2 if kind == "gaussian" else gap) / (2.0 * float(param) ** 2))


def _matrix(column, features: int | None) -> np.ndarray:
    """Rows of a list column; null entries are not a number, entries beyond ``features`` are left out."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)[:, :features]


@dataclass(frozen=True)
class Expansion:
    """kernel(x, y) = sum over l, i, j of shells[l][i, j] a^i b^j z^l.

    With u = (x - centre) / scale and v likewise for y: a = |u|^2 - 1/2, b = |v|^2 - 1/2, z = u.v, which splits into monomials of u and v.
    """

    centre: np.ndarray
    scale: float
    shells: list[np.ndarray]

    @property
    def terms(self) -> int:
        return sum(len(c) * math.comb(n + len(self.centre) - 1, n) for n, c in enumerate(self.shells))

    def parts(self, x: np.ndarray):
        """Per degree of the monomials: their values, their weights in z^l and the powers of a that go with them."""
        u = (x - self.centre) / self.scale
        a = (u**2).sum(1) - 0.5
        width = u.shape[1]
        exps, values = [(0,) * width], np.ones((len(u), 1))
        for n, c in enumerate(self.shells):
            if n:
                place = {e: k for k, e in enumerate(exps)}
                exps = [tuple(map(picks.count, range(width))) for picks in itertools.combinations_with_replacement(range(width), n)]
                var = np.array([next(k for k in range(width) if e[k]) for e in exps])
                values = values[:, [place[tuple(v - (k == first) for k, v in enumerate(e))] for e, first in zip(exps, var)]] * u[:, var]
            weights = np.array([math.factorial(n) / math.prod(map(math.factorial, e)) for e in exps])
            yield values, weights, a[:, None] ** np.arange(len(c))

    def moments(self, x: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums over the points x of their terms times each of their values, all in one vector."""
        return np.concatenate([(m.T @ (powers[:, :, None] * values[:, None, :]).reshape(len(x), -1)).ravel() for m, _, powers in self.parts(x)])

    def prepared(self, moments: np.ndarray, values: int) -> list[np.ndarray]:
        """The factors of a row's terms, from the moments: per degree (monomial, power of a, value)."""
        out, at, width = [], 0, len(self.centre)
        for n, c in enumerate(self.shells):
            shape = math.comb(n + width - 1, n), len(c), values
            out.append(np.einsum("ij,mjv->miv", c, moments[at:at + math.prod(shape)].reshape(shape)))
            at += math.prod(shape)
        return out

    def sums(self, x: np.ndarray, prepared: list[np.ndarray]) -> np.ndarray:
        """(row, value): the sums over all points of kernel times value."""
        out = np.zeros((len(x), prepared[0].shape[2]))
        for (m, weights, powers), f in zip(self.parts(x), prepared):
            out += np.einsum("ni,niv->nv", powers, ((m * weights) @ f.reshape(len(f), -1)).reshape(len(x), *f.shape[1:]))
        return out


def expansion(kind: str, param: float, low: np.ndarray, high: np.ndarray, radius: float, exact: float = EXACT) -> Expansion | None:
    """The kernel as a short sum of products, for points no farther than ``radius`` from the middle of the box ``low`` to ``high``. None if there is none."""
    if not (np.isfinite(radius) and np.isfinite(low).all() and np.isfinite(high).all()):
        return None
    width, scale = len(low), float(radius) or 1.0
    if kind in ("linear", "polynomial"):
        power = 1 if kind == "linear" else param
        if power != int(power) or not 0 <= power <= 16:
            return None
        scale = max(1e-3, scale + float(np.linalg.norm((low + high) / 2)))  # lengths from zero
        c = [math.comb(int(power), n) * scale ** (2 * n) if kind == "polynomial" else float(n == 1) * scale**2 for n in range(int(power) + 1)]
        found = Expansion(np.zeros(width), scale, [np.full((1, 1), v) for v in c])
        return found if np.isfinite(c).all() and found.terms <= MOST_TERMS else None
    if kind not in ("gaussian", "rbf"):
        return None
    # the squared distance is (1 + a + b - 2 z) scale^2, from 0 to 4 scale^2
    bend = 2.0 * float(param) ** 2
    value = lambda t: np.exp(-((t * scale**2) ** 2 if kind == "gaussian" else t * scale**2) / bend)
    nodes = np.polynomial.chebyshev.chebinterpolate(lambda s: value(2 + 2 * s), 63)
    tail = np.cumsum(np.abs(nodes[::-1]))[::-1]
    degree = next((n for n in range(41) if tail[n + 1] <= exact / 4), None)
    if degree is None:
        return None
    series = np.polynomial.Chebyshev(nodes[:degree + 1], domain=[0, 4])
    taylor = [(series.deriv(k) if k else series)(1.0) / math.factorial(k) for k in range(degree + 1)]  # in a + b - 2 z
    t = np.linspace(0, 4, 4001)
    if np.abs(np.polynomial.polynomial.polyval(t - 1, taylor) - value(t)).max() > exact / 2:
        return None
    terms = [(n, i, j, taylor[i + j + n] * math.factorial(i + j + n) / (math.factorial(i) * math.factorial(j) * math.factorial(n)) * (-2.0) ** n)
             for n in range(degree + 1) for i in range(degree + 1 - n) for j in range(degree + 1 - n - i)]
    size = np.array([abs(c) * 0.5 ** (i + j) for n, i, j, c in terms])  # a and b reach 1/2, z reaches 1
    if size.sum() * 1e-15 > exact:
        return None  # the terms would cancel
    order = np.argsort(size)
    kept = [terms[k] for k in order[np.cumsum(size[order]) > exact / 4]]  # the others together are less than that
    shells = []
    for n in range(max(t[0] for t in kept) + 1):
        own = [t for t in kept if t[0] == n]
        c = np.zeros((1 + max((max(t[1], t[2]) for t in own), default=0),) * 2)
        for _, i, j, v in own:
            c[i, j] = v
        shells.append(c)
    found = Expansion((low + high) / 2, scale, shells)
    return found if found.terms <= MOST_TERMS else None


@dataclass(frozen=True)
class Plan:
    """How a kernel product is taken: sizes of the sides, and the expansion if it is the cheaper way."""

    rows: int
    points: int
    width: int | None
    expanded: Expansion | None = None


def _whole(x: str, width: int | None) -> Column:
    return F.coalesce(F.forall(x, lambda e: e.isNotNull()), F.lit(False)) & (F.size(x) >= (width or 0))


def product_plan(rows: DataFrame, points: DataFrame, values: int, kind: str = "polynomial", param: float = 3, x: str = "x", features: int | None = None,
                 expand: bool | None = None, exact: float = EXACT) -> Plan:
    """Counts both sides and decides; ``expand`` true or false forces the way (true: where the kernel has an expansion)."""
    size = points.agg(F.max(F.size(x)).alias("d"), F.count(F.lit(1)).alias("n")).first()
    width = features or size.d
    rows = rows.where(_whole(x, width))
    count = rows.count()
    if not width or width > 16 or not count or expand is False:
        return Plan(count, size.n, width)
    both = rows.select(x).unionByName(points.where(_whole(x, width)).select(x))
    at = [F.get(x, F.lit(k)).cast("double") for k in range(width)]
    box = both.agg(*[f(c).alias(f"{name}{k}") for k, c in enumerate(at) for name, f in (("lo", F.min), ("hi", F.max))]).first()
    low, high = (np.array([box[f"{n}{k}"] for k in range(width)], float) for n in ("lo", "hi"))
    gap = sum(((c - float(m)) * (c - float(m)) for c, m in zip(at, (low + high) / 2)), F.lit(0.0))
    radius = math.sqrt(both.agg(F.max(gap).alias("r")).first().r) if np.isfinite([low, high]).all() else math.inf
    found = expansion(kind, param, low, high, radius * (1 + 1e-9), exact)
    if found and (expand or found.terms * values * (count + size.n) < TERM * count * size.n):
        return Plan(count, size.n, width, found)
    return Plan(count, size.n, width)


_PIECE = 1 << 16  # numbers of a vector of moments in a row


def _moments(points: DataFrame, found: Expansion, names: list[str], features: int | None) -> np.ndarray:
    """The moments of all points: every task adds up its own, Spark adds those, only the sum reaches the driver."""
    schema = pa.schema([("piece", pa.int32()), ("sums", pa.binary())])

    def partial(batches):
        total = None
        for b in batches:
            x, v = _matrix(b.column("_x"), features), np.column_stack([b.column(n).to_numpy(zero_copy_only=False) for n in names])
            for i in range(0, len(x), 1024):
                own = found.moments(x[i:i + 1024], v[i:i + 1024])
                total = own if total is None else total + own
        if total is not None:
            cut = [total[i:i + _PIECE].tobytes() for i in range(0, len(total), _PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())], schema=schema)

    def added(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_py()) for s in group.column("sums"))
        return pa.table([pa.array([group.column("piece")[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=schema)

    pieces = points.mapInArrow(partial, "piece int, sums binary").groupBy("piece").applyInArrow(added, "piece int, sums binary").collect()
    return np.concatenate([np.frombuffer(r.sums) for r in sorted(pieces, key=lambda r: r.piece)])


def kernel_product(rows: DataFrame, points: DataFrame, keys: list[str], values: list[str], kind: str = "polynomial", param: float = 3, x: str = "x",
                   features: int | None = None, row_block: int = ROWS, point_block: int = POINTS, expand: bool | None = None, plan: Plan | None = None) -> DataFrame:
    """(keys, values): per row the sum over all ``points`` (x ARRAY, values DOUBLE) of value times kernel, for each of the value columns.

    ``rows``: keys and x; a key that repeats counts once. Rows whose x is null, has a null entry or another length than the points' have no
    result. A null in a point makes every sum null. Without points there are no results. ``plan``: of ``product_plan``, to take it once.
    """
    plan = plan or product_plan(rows, points, len(values), kind, param, x, features, expand)
    points = points.select(F.col(x).alias("_x"), *[F.col(v).cast("double").alias(f"_v{k}") for k, v in enumerate(values)])
    own = rows.select(*keys, F.col(x).alias("_x")).where(_whole("_x", plan.width)).dropDuplicates(keys)
    names = [f"_v{k}" for k in range(len(values))]
    kinds = dict(rows.dtypes)
    ddl = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"{n} double" for n in names])
    clean = lambda c, n: F.when(F.isnan(c), F.lit(None)).otherwise(c).alias(n)
    if plan.expanded and plan.points:
        found = plan.expanded
        prepared = found.prepared(_moments(points, found, names, features), len(values))

        def summed(batches):
            for b in batches:
                a = _matrix(b.column("_x"), features)
                sums = np.concatenate([found.sums(a[i:i + 1024], prepared) for i in range(0, len(a), 1024)] or [np.zeros((0, len(names)))])
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], *[pa.array(s) for s in sums.T]], [*keys, *names])

        return own.mapInArrow(summed, ddl).select(*keys, *[clean(F.col(n), v) for n, v in zip(names, values)])
    a, b = max(1, math.ceil(plan.rows / row_block)), max(1, math.ceil(plan.points / point_block))

    def dealt(df: DataFrame, by: list[Column], name: str, many: int, other: str, others: int) -> DataFrame:
        return df.withColumns({name: F.pmod(F.xxhash64(*by), F.lit(many)).cast("int"), other: F.explode(F.sequence(F.lit(0), F.lit(others - 1)))})

    left = dealt(own, [F.col(k) for k in keys], "_a", a, "_b", b)
    right = dealt(points, [F.col(c) for c in points.columns], "_b", b, "_a", a)

    def product(rows: pa.Table, points: pa.Table) -> pa.Table:
        out = {k: rows.column(k) for k in keys}
        if not rows.num_rows or not points.num_rows:
            return pa.table({**{k: c[:0] for k, c in out.items()}, **{n: pa.array([], pa.float64()) for n in names}})
        sums = kernel_block(_matrix(rows.column("_x"), features), _matrix(points.column("_x"), features), kind, param) @ np.column_stack(
            [points.column(n).to_numpy() for n in names])
        return pa.table({**out, **{n: sums[:, k] for k, n in enumerate(names)}})

    parts = left.groupBy("_a", "_b").cogroup(right.groupBy("_a", "_b")).applyInArrow(product, ddl)
    return parts.groupBy(*keys).agg(*[clean(F.sum(n), v) for n, v in zip(names, values)])


def fit_dual(df: DataFrame, systems: list[tuple[float, int | None]], key: str = "i", x: str = "x", y: str = "y", fold: str | None = None, kind: str = "gaussian", param: float = 1.0,
             tolerance: float = 1e-10, steps: int = 500, expand: bool | None = None, **blocks) -> DataFrame:
    """(key, x, y, fold, c0, c1, ...): coefficients of every training point for each (lambda, held-out fold or None) of ``systems``.

    c solves (K + lambda n I) c = y over the rows outside the held-out fold (n of them, the others get 0) to a residual of
    ``tolerance`` times the length of y. ``key`` is unique. Raises if that takes more than ``steps`` steps.
    """
    m = range(len(systems))
    has = [F.lit(1.0) if f is None else F.when(F.col("fold") == f, 0.0).otherwise(1.0) for _, f in systems]
    base = df.select(F.col(key), F.col(x).alias("x"), F.col(y).cast("double").alias("y"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"))
    n = base.agg(*[F.sum(h).alias(f"n{k}") for k, h in enumerate(has)]).first()
    if not n[0]:
        raise ValueError("the training table is empty")
    ridge = [lam * n[k] for k, (lam, _) in enumerate(systems)]
    plan = product_plan(base, base, len(systems), kind, param, expand=expand, exact=min(tolerance, 1e-10))

    def applied(state: DataFrame) -> DataFrame:
        """With a0, a1, ...: the system's matrix times r."""
        r = [f"r{k}" for k in m]
        found = kernel_product(state.select(key, "x"), state.select("x", *r), [key], r, kind, param, plan=plan, **blocks)
        state = state.join(found.toDF(key, *[f"_k{k}" for k in m]), key)
        return state.select("*", *[(h * F.col(f"_k{k}") + ridge[k] * F.col(f"r{k}")).alias(f"a{k}") for k, h in enumerate(has)]).drop(*[f"_k{k}" for k in m])

    def sums(state: DataFrame):
        pairs = {"rr": ("r", "r"), "ra": ("r", "a"), "aa": ("a", "a"), "aq": ("a", "q"), "qq": ("q", "q"), "yy": ("_y", "_y")}
        state = state.select("*", *[(h * F.col("y")).alias(f"_y{k}") for k, h in enumerate(has)])
        row = state.agg(*[F.sum(F.col(f"{p}{k}") * F.col(f"{q}{k}")).alias(f"{name}{k}") for name, (p, q) in pairs.items() for k in m]).first()
        return {name: np.array([row[f"{name}{k}"] for k in m]) for name in pairs}

    start = base.select("*", *[e for k, h in enumerate(has) for e in (F.lit(0.0).alias(f"c{k}"), (h * F.col("y")).alias(f"r{k}"), F.lit(0.0).alias(f"p{k}"), F.lit(0.0).alias(f"q{k}"))])
    state = stored(applied(start), "kernel-fit")  # c: solution, r: residual, a: matrix times r, p: direction, q: matrix times p
    before = None
    for _ in range(steps):
        s = sums(state)
        done = s["rr"] <= tolerance**2 * s["yy"]
        if done.all():
            out = stored(state.select(key, "x", "y", "fold", *[f"c{k}" for k in m]), "kernel-coefficients")
            discard(state)
            return out
        beta = np.zeros(len(systems)) if before is None else np.where(done | (before == 0), 0.0, s["ra"] / np.where(before == 0, 1, before))
        length = s["aa"] + 2 * beta * s["aq"] + beta**2 * s["qq"]
        alpha = np.where(done | (length == 0), 0.0, s["ra"] / np.where(length == 0, 1, length))
        before = s["ra"]
        step = []
        for k in m:
            p, q = (F.col(f"{u}{k}") + float(beta[k]) * F.col(f"{v}{k}") for u, v in (("r", "p"), ("a", "q")))
            step += [p.alias(f"p{k}"), q.alias(f"q{k}"), (F.col(f"c{k}") + float(alpha[k]) * p).alias(f"c{k}"), (F.col(f"r{k}") - float(alpha[k]) * q).alias(f"r{k}")]
        last, state = state, stored(applied(state.select(key, "x", "y", "fold", *step)), "kernel-fit")
        discard(last)
    raise RuntimeError(f"the kernel fit did not settle in {steps} steps")


def cross_validate_dual(df: DataFrame, folds: int, lams: list[float], key: str = "i", x: str = "x", y: str = "y", fold: str = "fold", kind: str = "gaussian", param: float = 1.0, **blocks) -> DataFrame:
    """(lam, fold, train_err, valid_err): mean squared errors of the rounded scores, all candidates and folds fitted side by side."""
    systems = [(float(lam), f) for lam in lams for f in range(folds)]
    fitted = fit_dual(df, systems, key, x, y, fold, kind, param, **blocks)
    c = [f"c{k}" for k in range(len(systems))]
    found = kernel_product(fitted.select(key, "x"), fitted.select("x", *c), [key], c, kind, param, **blocks)
    rows = fitted.select(key, "y", "fold").join(found, key)
    one = F.explode(F.array(*[F.struct(F.lit(lam).alias("lam"), F.lit(f).alias("held"), F.pow(F.rint(F.col(f"c{k}")) - F.col("y"), F.lit(2.0)).alias("e")) for k, (lam, f) in enumerate(systems)]))
    errors = rows.select("fold", one.alias("s")).select("s.lam", F.col("s.held").alias("held"), (F.col("fold") == F.col("s.held")).alias("valid"), F.col("s.e").alias("e"))
    return errors.groupBy("lam", F.col("held").alias("fold")).agg(F.avg(F.when(~F.col("valid"), F.col("e"))).alias("train_err"), F.avg(F.when(F.col("valid"), F.col("e"))).alias("valid_err"))
