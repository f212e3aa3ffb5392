"""Quality by a sparse ensemble of rules over text statistics.

1. Statistics of every whole text (``STATS``), computed per Arrow batch.
2. Small trees are boosted on a bounded sample of labelled texts (``SAMPLE`` rows of a class, chosen by hash and weighted back
   to the shares of all labelled rows). Every path from a root to a node is a rule: a conjunction of comparisons.
3. A logistic model with a lasso penalty weighs the rules; most weights become 0.
4. The rules left are Spark column expressions over the statistics; their weighted sum is the score.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geocadence.llm.tables import Batches
from geocadence.llm.toxicity import labelled_sample
from geocadence.llm.words import as_bytes, portions, word_hashes

SAMPLE, TREES, DEPTH, PENALTY = 4000, 24, 3, 1e-3
_KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".,;:?", "bang": b"!", "symbol": b"#$%&*@^~=+<>[]{}\\/_|", "line": b"\n", "space": b" \t\r\x0b\x0c", "wide": bytes(range(128, 256))}
_KIND = np.zeros(256, np.int64)
for _i, _bytes in enumerate(_KINDS.values()):
    _KIND[list(_bytes)] = _i + 1
STATS = ("log_bytes", "log_words", "word_length", *(f"{k}_share" for k in _KINDS), "distinct_words", "top_word", "same_as_before", "same_lines", "distinct_pairs")
_DDL = ", ".join(f"{s} double" for s in STATS)


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of STATS per text; shares of an empty text are 0."""
    hashes, first = word_hashes(texts)
    out = np.zeros((len(texts), len(STATS)))
    for i, text in enumerate(texts):
        words = hashes[first[i]:first[i + 1]]
        n, size = len(words), len(text)
        kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=len(_KINDS) + 1)[1:]
        row = [np.log1p(size), np.log1p(n), (size - kinds[-2] - kinds[-3]) / max(n, 1), *(kinds / max(size, 1))]
        if n:
            counts = np.unique(words, return_counts=True)[1]
            same = np.count_nonzero(words[1:] == words[:-1])
            lines = [x for x in text.split(b"\n") if x.strip()]
            pairs = words[1:] * np.uint64(3) + words[:-1]
            row += [len(counts) / n, counts.max() / n, same / n, 1 - len(set(lines)) / len(lines), len(np.unique(pairs)) / max(n - 1, 1)]
            out[i] = row
        else:
            out[i, :len(row)] = row
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics...) per row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64())] + [(s, pa.float64()) for s in STATS])

    def run(batches: Batches) -> Batches:
        for b in portions(batches):
            x = statistics(as_bytes(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c) for c in x.T)], schema=schema)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {_DDL}")


# --- rules ------------------------------------------------------------------------------------------
Rule = tuple[tuple[int, float, bool], ...]  # (statistic, cut, whether at most) and so on, all must hold


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, [(x[:, f] <= cut) == low for f, cut, low in rule])


def tree_rules(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int, rule: Rule = ()) -> list[tuple[Rule, float]]:
    """(path, value) of every node below the root of a regression tree on the gradient; cuts lie between values."""
    value = gradient.sum() / max(weight.sum(), 1e-9)
    own = [(rule, value)] if rule else []
    if depth == 0 or len(x) < 20:
        return own
    gain, best = 1e-9, None
    total, whole = gradient.sum(), weight.sum()
    for f in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, 33)))
        place = np.searchsorted(cuts, x[:, f])  # rows with place <= i are at most cuts[i]
        g, w = (np.cumsum(np.bincount(place, v, len(cuts) + 1))[:-1] for v in (gradient, weight))
        inside = (w > 1e-6) & (whole - w > 1e-6)
        score = np.where(inside, g**2 / np.maximum(w, 1e-9) + (total - g)**2 / np.maximum(whole - w, 1e-9), 0) - total**2 / max(whole, 1e-9)
        i = int(np.argmax(score))
        if score[i] > gain:
            gain, best = score[i], (f, float(cuts[i]))
    if best is None:
        return own
    f, cut = best
    low = x[:, f] <= cut
    return own + tree_rules(x[low], gradient[low], weight[low], depth - 1, (*rule, (f, cut, True))) + tree_rules(x[~low], gradient[~low], weight[~low], depth - 1, (*rule, (f, cut, False)))


def boosted_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = 0.3, seed: int = 1) -> list[Rule]:
    """Distinct paths of trees boosted on random halves of the rows; deep paths add to what their shorter ones say."""
    rng, at, rules = np.random.default_rng(seed), np.zeros(len(y)), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-at))
        half = rng.random(len(y)) < 0.5
        found = tree_rules(x[half], (weight * (y - p))[half], (weight * np.maximum(p * (1 - p), 1e-3))[half], depth)
        ends = [(r, v) for r, v in found if not any(o[:len(r)] == r and len(o) > len(r) for o, _ in found)]
        for rule, value in ends:
            at[holds(rule, x)] += rate * np.clip(value, -4, 4)
        rules |= {tuple(sorted(r)): None for r, _ in found}
    return list(rules)


def lasso_logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY, steps: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise the weighted log loss plus ``penalty`` times the sum of absolute weights (accelerated proximal steps)."""
    weight = weight / weight.sum()
    design = np.column_stack([np.ones(len(z)), z])
    step = 4 / max(np.linalg.eigvalsh((design * weight[:, None]).T @ design)[-1], 1e-9)
    w = ahead = np.zeros(design.shape[1])
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ ahead, -30, 30)))
        new = ahead - step * (design.T @ (weight * (p - y)))
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (last - 1) / t * (new - w)
        done, w = np.abs(new - w).max() < 1e-5, new
        if done:
            break
    return float(w[0]), w[1:]


@dataclass
class Rules:
    intercept: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        def one(rule: Rule) -> Column:
            return reduce(lambda a, b: a & b, [F.col(STATS[f]) <= cut if low else F.col(STATS[f]) > cut for f, cut, low in rule])
        total = reduce(lambda a, b: a + b, [F.when(one(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules], F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def trained(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, penalty: float = PENALTY) -> Rules:
    """Rules from labelled documents: ``labels`` (doc_id, quality) of the rows to learn from, null labels left out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    shares = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = labelled_sample(known, "quality", per_class)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample.select("doc_id")), "doc_id")  # bounded by the sample
    rows = with_statistics(texts).join(sample.select("doc_id", "label"), "doc_id").orderBy("doc_id", *STATS).toArrow()
    y = rows.column("label").to_numpy().astype(float)
    x = np.column_stack([rows.column(s).to_numpy() for s in STATS])
    if len(np.unique(y)) < 2:  # nothing to tell apart
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Rules(float(np.log(share / (1 - share))), [])
    weight = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
    weight = weight / weight.mean()
    rules = boosted_rules(x, y, weight)
    intercept, weights = lasso_logistic(np.column_stack([holds(r, x) for r in rules]).astype(float), y, weight, penalty)
    return Rules(intercept, [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def scored(docs: DataFrame, rules: Rules, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs`` (doc_id LONG, text STRING); null texts are empty, doc_id may be null or repeat, other columns are not read."""
    rows = with_statistics(docs).select("doc_id", rules.column().alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
