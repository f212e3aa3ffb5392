"""Kernel queries: A12-A14, M1-M7."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import functions as F

from geocadence.catalog.registry import SQL_AREA_DAYS, Tables, area_days, big, query, r6, text
from geocadence.operators import kernel as K
from geocadence.operators import kernel_blocks as KB

FEATURES = ["x0", "x1", "x2", "x3"]


def vectors(t: Tables):
    """Embeddings as four features and a target: (i, x0..x3, y)."""
    return t.embeddings.select(
        F.col("vec_id").alias("i"), *[F.get("embedding", F.lit(k)).cast("double").alias(f"x{k}") for k in range(4)], F.col("label").cast("double").alias("y"))


def training(t: Tables):
    """Training points on scaled features with coefficients made from the label: (i, x, c)."""
    v = vectors(t)
    return v.select(F.col("i").cast("int").alias("i"), F.array(*FEATURES).alias("x"), ((F.col("y") - 4.5) / 10.0).alias("c"))


SQL_VECTORS = "vectors AS (SELECT vec_id AS i, " + ", ".join(f"CAST(embedding[{k + 1}] AS DOUBLE) AS x{k}" for k in range(4)) + ", CAST(label AS DOUBLE) AS y FROM embeddings)"


@query("a12_feature_stats", f"""
WITH {SQL_VECTORS} """ + " UNION ALL ".join(
    f"SELECT CAST({k} AS BIGINT) AS k, MAX(x{k}) AS max, round(AVG(x{k}) / MAX(x{k}) + 1e-9, 6) AS mean FROM vectors" for k in range(4)))
def a12(t: Tables):
    return K.feature_stats(vectors(t), FEATURES).select(big("k").alias("k"), "max", r6("mean").alias("mean"))


@query("a12_scaled_features", f"""
WITH {SQL_VECTORS}, s AS (SELECT """ + ", ".join(f"MAX(x{k}) AS m{k}, AVG(x{k}) / MAX(x{k}) AS a{k}" for k in range(4)) + " FROM vectors) SELECT i, "
    + ", ".join(f"round(x{k} / m{k} - a{k} + 1e-9, 6) AS z{k}" for k in range(4)) + " FROM vectors, s")
def a12_scaled(t: Tables):
    v = vectors(t)
    mx, mean = K.stats_arrays(K.feature_stats(v, FEATURES))
    z = K.scale_features([F.col(c) for c in FEATURES], mx, mean)
    return v.select("i", *[r6(c).alias(f"z{k}") for k, c in enumerate(z)])


@query("a13_mean_squared_error", f"WITH {SQL_VECTORS} SELECT CAST(y AS BIGINT) AS label, round(AVG((x0 - x1) * (x0 - x1)) + 1e-9, 6) AS mse FROM vectors GROUP BY y")
def a13(t: Tables):
    return K.mean_squared_error(vectors(t), "x0", "x1", ["y"]).select(big("y").alias("label"), r6("mse").alias("mse"))


@query("a14_fold_statistics", f"""
WITH {SQL_VECTORS}, e AS (SELECT CAST(y AS BIGINT) AS cand, i % 5 AS fold, AVG(x0 * x0) AS tr, AVG(x1 * x1) AS va FROM vectors GROUP BY 1, 2),
s AS (SELECT cand, median(tr) AS a, stddev_pop(tr) AS b, median(va) AS c, stddev_pop(va) AS d FROM e GROUP BY cand)
SELECT cand, round(a + 1e-9, 6) AS train_median, round(b + 1e-9, 6) AS train_std, round(c + 1e-9, 6) AS valid_median, round(d + 1e-9, 6) AS valid_std, c = (SELECT MIN(c) FROM s) AS is_best FROM s""")
def a14(t: Tables):
    e = vectors(t).groupBy(big("y").alias("cand"), F.pmod("i", F.lit(5)).alias("fold")).agg(
        F.avg(F.col("x0") * F.col("x0")).alias("train_err"), F.avg(F.col("x1") * F.col("x1")).alias("valid_err"))
    out = K.fold_statistics(e, ["cand"])
    return out.select("cand", *[r6(c).alias(c) for c in ("train_median", "train_std", "valid_median", "valid_std")], "is_best")


@query("m1_feature_array", f"""
WITH {SQL_AREA_DAYS} SELECT area, CAST(time AS VARCHAR) AS time, CAST(n AS DOUBLE) AS f0, value AS f1, value / 2 AS f2, CAST(dayofyear(time) AS DOUBLE) AS f3 FROM area_days""")
def m1(t: Tables):
    d = area_days(t).select("area", "time", F.col("n").alias("sm_value_first"), F.col("value").alias("rain_accumulated_12H"),
                            (F.col("value") / 2).alias("rain_peak_3H"), F.dayofyear("time").alias("day_of_the_year"))
    x = K.feature_array(d)
    return x.select("area", text("time").alias("time"), *[F.col("x")[k].alias(f"f{k}") for k in range(4)])


_DOT = "+".join(f"a.x{k} * b.x{k}" for k in range(4))
_SCORE = f"WITH {SQL_VECTORS}, s AS (SELECT a.i, SUM((b.y - 4.5) / 10.0 * pow(1 + {_DOT}, 3)) AS raw FROM vectors a, vectors b GROUP BY a.i)"
_SCORE_SQL = _SCORE + " SELECT i, round(raw + 1e-9, 6) AS raw_score, CAST(greatest(round_even(raw, 0), 0) AS BIGINT) AS slips FROM s"


@query("m2_kernel_score", _SCORE_SQL)
def m2(t: Tables):
    rows = vectors(t).select("i", F.array(*FEATURES).alias("x"))
    out = K.score_direct(rows, training(t), ["i"], block=200, features=4)
    return out.select("i", r6("raw_score").alias("raw_score"), big(K.predicted_count(F.col("raw_score"))).alias("slips"))


@query("m2_kernel_score_collapsed", _SCORE_SQL)
def m2_collapsed(t: Tables):
    model = K.collapse_model(training(t), 4, 3)
    out = K.score_collapsed(vectors(t), model, FEATURES)
    return out.select("i", r6("raw_score").alias("raw_score"), big(K.predicted_count(F.col("raw_score"))).alias("slips"))


@query("m3_kernel_values", f"""
WITH {SQL_VECTORS}, c AS (SELECT y, """ + ", ".join(f"MIN(x{k}) AS c{k}" for k in range(4)) + """ FROM vectors GROUP BY y),
d AS (SELECT i, """ + "+".join(f"x{k} * c{k}" for k in range(4)) + " AS dt, " + "+".join(f"(x{k} - c{k}) * (x{k} - c{k})" for k in range(4)) + """ AS d2 FROM vectors JOIN c USING (y))
SELECT i, round(dt + 1e-9, 6) AS linear, round(pow(1 + dt, 3) + 1e-9, 6) AS polynomial, round(exp(-d2 * d2 / 0.5) + 1e-9, 6) AS gaussian, round(exp(-d2 / 0.5) + 1e-9, 6) AS rbf FROM d""")
def m3(t: Tables):
    v = vectors(t)
    centre = v.groupBy("y").agg(F.array(*[F.min(c) for c in FEATURES]).alias("m"))
    j = v.join(centre, "y").withColumn("x", F.array(*FEATURES))
    kinds = {"linear": 0, "polynomial": 3, "gaussian": 0.5, "rbf": 0.5}
    return j.select("i", *[r6(K.kernel_value(F.col("x"), F.col("m"), kind, p)).alias(kind) for kind, p in kinds.items()])


@query("m2_gaussian_score", f"""
WITH {SQL_VECTORS}, s AS (SELECT a.i, SUM((b.y - 4.5) / 10.0 * exp(-pow(""" + "+".join(f"(a.x{k} - b.x{k}) * (a.x{k} - b.x{k})" for k in range(4)) + """, 2) / 0.5)) AS raw FROM vectors a, vectors b GROUP BY a.i)
SELECT i, round(raw + 1e-9, 6) AS raw_score FROM s""")
def m2_gaussian(t: Tables):
    rows = vectors(t).select("i", F.array(*FEATURES).alias("x"))
    return K.score_direct(rows, training(t), ["i"], kind="gaussian", param=0.5, block=200, features=4).select("i", r6("raw_score").alias("raw_score"))


def _fit_sql(power: int, lam: float, steps: int) -> str:
    """Coefficients of the ridge solution: the normal equations in the feature space of (1 + x.y)^power, solved by small steps."""
    exps = [e for e in itertools.product(range(power + 1), repeat=4) if sum(e) <= power]
    factor = lambda e: math.factorial(power) / math.prod(map(math.factorial, (*e, power - sum(e))))
    phi = ", ".join(" * ".join([f"sqrt({factor(e)}::DOUBLE)"] + [f"x{k}" for k, n in enumerate(e) for _ in range(n)]) for e in exps)
    m = len(exps)
    return f"""WITH RECURSIVE {SQL_VECTORS}, f AS MATERIALIZED (SELECT i, y, [{phi}] AS p FROM vectors),
gram AS (SELECT a, b, SUM(p[a] * p[b]) AS v FROM f, range(1, {m + 1}) ra(a), range(1, {m + 1}) rb(b) GROUP BY a, b),
rows_ AS (SELECT a, list(v ORDER BY b) AS row_ FROM gram GROUP BY a), side AS (SELECT a, SUM(p[a] * y) AS v FROM f, range(1, {m + 1}) ra(a) GROUP BY a),
h AS MATERIALIZED (SELECT (SELECT list(row_ ORDER BY a) FROM rows_) AS g, (SELECT list(v ORDER BY a) FROM side) AS b,
  (SELECT COUNT(*) * {lam} FROM f) AS ln, (SELECT SUM(v) FROM gram WHERE a = b) AS tr),
r(k, w) AS (SELECT 0, [0.0::DOUBLE for z in range({m})] UNION ALL
  SELECT k + 1, [w[j] + (b[j] - ln * w[j] - list_dot_product(g[j], w)) / (tr + ln) for j in range(1, {m + 1})] FROM r, h WHERE k < {steps})
SELECT i, round((y - list_dot_product(p, w)) / ln + 1e-9, 6) AS c FROM f, h, (SELECT w FROM r WHERE k = {steps})"""


@query("m4_kernel_fit", _fit_sql(3, 0.01, 4000))
def m4(t: Tables):
    d = vectors(t).withColumn("x", F.array(*FEATURES))
    model = K.fit_kernel(d, 4, 0.01)
    out = K.dual_coefficients(d, model, 0.01, d.count())
    return out.select("i", r6("c").alias("c"))


@query("m5_cross_validation")
def m5(t: Tables):
    d = K.with_fold(vectors(t).withColumn("x", F.array(*FEATURES)), "i", 5)
    out = K.fold_statistics(K.cross_validate(d, 4, 5, [0.001, 0.01, 0.1], [1, 2, 3]), ["lam", "power"])
    return out.select("lam", "power", *[r6(c).alias(c) for c in ("train_median", "train_std", "valid_median", "valid_std")], "is_best")


@query("m5_linear_folds", f"""
WITH RECURSIVE {SQL_VECTORS}, f AS MATERIALIZED (SELECT i, y, i % 5 AS fold, [1.0::DOUBLE, x0, x1, x2, x3] AS p FROM vectors),
gram AS (SELECT o.fold, a, b, SUM(p[a] * p[b]) AS v FROM f, (SELECT DISTINCT fold FROM f) o, range(1, 6) ra(a), range(1, 6) rb(b) WHERE f.fold <> o.fold GROUP BY ALL),
g AS (SELECT fold, list(row_ ORDER BY a) AS g FROM (SELECT fold, a, list(v ORDER BY b) AS row_ FROM gram GROUP BY fold, a) GROUP BY fold),
side AS (SELECT fold, list(v ORDER BY a) AS b FROM (SELECT o.fold, a, SUM(p[a] * y) AS v FROM f, (SELECT DISTINCT fold FROM f) o, range(1, 6) ra(a) WHERE f.fold <> o.fold GROUP BY ALL) GROUP BY fold),
h AS MATERIALIZED (SELECT lam, g.fold, g, b, lam * n AS ln, tr FROM g JOIN side USING (fold) JOIN (SELECT fold, SUM(v) AS tr FROM gram WHERE a = b GROUP BY fold) USING (fold)
  JOIN (SELECT o.fold, COUNT(*) AS n FROM f, (SELECT DISTINCT fold FROM f) o WHERE f.fold <> o.fold GROUP BY o.fold) USING (fold), (VALUES (0.01::DOUBLE), (0.1), (1.0)) l(lam)),
r(k, lam, fold, w) AS (SELECT 0, lam, fold, [0.0::DOUBLE for z in range(5)] FROM h UNION ALL
  SELECT k + 1, lam, fold, [w[j] + (b[j] - ln * w[j] - list_dot_product(g[j], w)) / (tr + ln) for j in range(1, 6)] FROM r JOIN h USING (lam, fold) WHERE k < 4000),
e AS (SELECT lam, r.fold, AVG(pow(round_even(list_dot_product(p, w), 0) - y, 2)) FILTER (f.fold <> r.fold) AS tr, AVG(pow(round_even(list_dot_product(p, w), 0) - y, 2)) FILTER (f.fold = r.fold) AS va
  FROM r, f WHERE k = 4000 GROUP BY lam, r.fold),
s AS (SELECT lam, median(tr) AS a, stddev_pop(tr) AS b, median(va) AS c, stddev_pop(va) AS d FROM e GROUP BY lam)
SELECT lam, CAST(1 AS INTEGER) AS power, round(a + 1e-9, 6) AS train_median, round(b + 1e-9, 6) AS train_std, round(c + 1e-9, 6) AS valid_median, round(d + 1e-9, 6) AS valid_std, c = MIN(c) OVER () AS is_best FROM s""")
def m5_linear(t: Tables):
    d = vectors(t).withColumns({"x": F.array(*FEATURES), "fold": F.pmod("i", F.lit(5)).cast("int")})  # folds from the stored key
    out = K.fold_statistics(K.cross_validate(d, 4, 5, [0.01, 0.1, 1.0], [1]), ["lam", "power"])
    return out.select("lam", "power", *[r6(c).alias(c) for c in ("train_median", "train_std", "valid_median", "valid_std")], "is_best")


_GAUSS = "exp(-pow(" + " + ".join(f"pow(a.x{k} - b.x{k}, 2)" for k in range(4)) + ", 2) / 0.5)"
# the matrix of the training points, and the steps of a slow but plain iteration towards the solution of (K + ln I) w = y
_GAUSS_ROWS = f"""{SQL_VECTORS}, f AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY i) AS j, i % 3 AS fold FROM vectors),
k AS (SELECT a.j, list({_GAUSS} ORDER BY b.j) AS row_ FROM f a, f b GROUP BY a.j),
g AS MATERIALIZED (SELECT (SELECT list(row_ ORDER BY j) FROM k) AS g, list(y ORDER BY j) AS y, list(fold ORDER BY j) AS fold, COUNT(*) AS n FROM f)"""


@query("m4_gaussian_fit", f"""
WITH RECURSIVE {_GAUSS_ROWS},
r(s, w) AS (SELECT 0, [0.0::DOUBLE for z in y] FROM g UNION ALL
  SELECT s + 1, [w[j] + (y[j] - 0.1 * n * w[j] - list_dot_product(g[j], w)) / (1.1 * n) for j in range(1, n + 1)] FROM r, g WHERE s < 500)
SELECT i, round(w[j] + 1e-9, 6) AS c, abs(y - 0.1 * n * w[j] - list_dot_product(g[j], w)) < 1e-6 AS solved FROM f, (SELECT w FROM r WHERE s = 500), (SELECT n, g FROM g)""")
def m4_gaussian(t: Tables):
    d = vectors(t).withColumn("x", F.array(*FEATURES))
    fit = KB.fit_dual(d, [(0.1, None)], "i", kind="gaussian", param=0.5)
    back = KB.kernel_product(fit.select("i", "x"), fit.select("x", F.col("c0").alias("kc")), ["i"], ["kc"], "gaussian", 0.5)
    gap = F.abs(F.col("y") - 0.1 * fit.count() * F.col("c0") - F.col("kc"))
    return fit.join(back, "i").select("i", r6("c0").alias("c"), (gap < 1e-6).alias("solved"))


@query("m5_gaussian_folds", f"""
WITH RECURSIVE {_GAUSS_ROWS},
h AS MATERIALIZED (SELECT lam, o.f AS held, lam * len(list_filter(fold, lambda x: x <> o.f)) AS ln, [CASE WHEN x = o.f THEN 0 ELSE 1 END for x in fold] AS inside FROM g, (VALUES (0.1::DOUBLE), (1.0)) l(lam), range(3) o(f)),
r(s, lam, held, w) AS (SELECT 0, lam, held, [0.0::DOUBLE for z in y] FROM h, g UNION ALL
  SELECT s + 1, lam, held, [w[j] + inside[j] * (y[j] - ln * w[j] - list_dot_product(g[j], w)) / (n + ln) for j in range(1, n + 1)] FROM r JOIN h USING (lam, held), g WHERE s < 300),
e AS (SELECT lam, held, AVG(pow(round_even(list_dot_product(g[j], w), 0) - f.y, 2)) FILTER (f.fold <> held) AS tr, AVG(pow(round_even(list_dot_product(g[j], w), 0) - f.y, 2)) FILTER (f.fold = held) AS va
  FROM r, g, f WHERE s = 300 GROUP BY lam, held),
q AS (SELECT lam, median(tr) AS a, stddev_pop(tr) AS b, median(va) AS c, stddev_pop(va) AS d FROM e GROUP BY lam)
SELECT lam, round(a + 1e-9, 6) AS train_median, round(b + 1e-9, 6) AS train_std, round(c + 1e-9, 6) AS valid_median, round(d + 1e-9, 6) AS valid_std, c = MIN(c) OVER () AS is_best FROM q""")
def m5_gaussian(t: Tables):
    d = vectors(t).withColumns({"x": F.array(*FEATURES), "fold": F.pmod("i", F.lit(3)).cast("int")})
    out = K.fold_statistics(KB.cross_validate_dual(d, 3, [0.1, 1.0], "i", kind="gaussian", param=0.5), ["lam"])
    return out.select("lam", *[r6(c).alias(c) for c in ("train_median", "train_std", "valid_median", "valid_std")], "is_best")


_AXES = """[v[j] / sqrt(list_dot_product(v, v)) for j in range(1, 5)]"""


@query("m6_principal_components", f"""
WITH RECURSIVE {SQL_VECTORS}, mu AS (SELECT AVG(x0) AS a, AVG(x1) AS b, AVG(x2) AS c, AVG(x3) AS d, COUNT(*) AS n FROM vectors),
f AS MATERIALIZED (SELECT i, [x0 - a, x1 - b, x2 - c, x3 - d] AS z, n FROM vectors, mu),
cov AS (SELECT r, c, SUM(z[r] * z[c]) / (MAX(n) - 1) AS v FROM f, range(1, 5) p(r), range(1, 5) q(c) GROUP BY r, c),
h AS MATERIALIZED (SELECT list(row_ ORDER BY r) AS m FROM (SELECT r, list(v ORDER BY c) AS row_ FROM cov GROUP BY r)),
one(k, v) AS (SELECT 0, [1.0::DOUBLE, 0.9, 0.8, 0.7] UNION ALL SELECT k + 1, [list_dot_product(m[j], u) for j in range(1, 5)] FROM (SELECT k, {_AXES} AS u FROM one), h WHERE k < 4000),
first_ AS MATERIALIZED (SELECT {_AXES} AS e, sqrt(list_dot_product(v, v)) AS size FROM one WHERE k = 4000),
left_ AS MATERIALIZED (SELECT [[m[r][c] - size * e[r] * e[c] for c in range(1, 5)] for r in range(1, 5)] AS m FROM h, first_),
two(k, v) AS (SELECT 0, [0.3::DOUBLE, -0.8, 0.9, 1.0] UNION ALL SELECT k + 1, [list_dot_product(m[j], u) for j in range(1, 5)] FROM (SELECT k, {_AXES} AS u FROM two), left_ WHERE k < 4000),
axes AS (SELECT e, 1 AS pc FROM first_ UNION ALL SELECT {_AXES}, 2 FROM two WHERE k = 4000),
signed AS (SELECT pc, [e[j] * CASE WHEN list_max(e) >= -list_min(e) THEN 1 ELSE -1 END for j in range(1, 5)] AS e FROM axes)
SELECT i, round(list_dot_product(z, (SELECT e FROM signed WHERE pc = 1)) + 1e-9, 6) AS pc1, round(list_dot_product(z, (SELECT e FROM signed WHERE pc = 2)) + 1e-9, 6) AS pc2 FROM f""")
def m6(t: Tables):
    d = vectors(t).withColumn("x", F.array(*FEATURES))
    pc = K.principal_components(d, 4, 2)
    return K.project_components(d, pc).select("i", r6("pc1").alias("pc1"), r6("pc2").alias("pc2"))


@query("m7_active_method", _SCORE_SQL.replace("SELECT i, round(raw + 1e-9, 6) AS raw_score, CAST(greatest(round_even(raw, 0), 0) AS BIGINT) AS slips FROM s", "SELECT i, CAST(greatest(round_even(raw, 0), 0) AS BIGINT) AS slips FROM s"))
def m7(t: Tables):
    def fx_kernel(rows, train, kernel_type, kernel_exponent):
        model = K.collapse_model(train, 4, kernel_exponent, kernel_type)
        return K.score_collapsed(rows, model, FEATURES)

    methods = {"fx_kernel": {"kernel_type": "polynomial", "kernel_exponent": 3, "active": True}, "fx_other": {"active": False}}
    apply, settings = K.Methods({"fx_kernel": fx_kernel}).active(methods)
    return apply(vectors(t), training(t), **settings).select("i", big(K.predicted_count(F.col("raw_score"))).alias("slips"))
