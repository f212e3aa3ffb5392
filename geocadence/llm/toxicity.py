"""Toxicity by class-conditional Kneser-Ney models of spelling.

Each class has a model of the next byte of a word given up to ``ORDER - 1`` bytes before it in the word (A-Z lower-cased, the end of a
word is a byte too). The highest order has the counts of its class; every lower order is one set of continuation counts that
both classes share:

    P_y(b | h) = (max(c_y(hb) - D(c_y(hb)), 0) + g_y(h) S(b | h')) / c_y(h),   or S(b | h') where class y never saw h

so an expression that neither class knows says nothing, and a rare one little. A word's evidence is its toxic minus its
ordinary log-likelihood; a text is described by the evidence normalised by its length (mean per word) and by its strongest words, and a
logistic function of these gives the score. It is fitted on each half of the labelled sample with models of the other half; the
models that score use both halves.

The labelled sample is bounded (``SAMPLE`` rows of a class, chosen by hash), so the models are: they travel with the tasks. What is
scored is every word of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geocadence.llm.counts import summed
from geocadence.llm.kneser_ney import modified_discounts
from geocadence.llm.tables import Batches, batch
from geocadence.llm.words import as_bytes, hash_spans, portions, word_buffers

ORDER, SAMPLE, THRESHOLD = 6, 4000, 0.7
TOP = (1, 2, 4, 6)  # places of the strongest words that describe a text
_END = 0x20


# --- n-grams of distinct words ----------------------------------------------------------------------
def distinct_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of the distinct words with an end after each, where each begins, which one every word is)."""
    _, pick, which = np.unique(hash_spans(buf, start, end), return_index=True, return_inverse=True)
    start, size = start[pick], end[pick] - start[pick] + 1
    begin = np.cumsum(size) - size
    at = np.arange(size.sum()) - np.repeat(begin - start, size)
    out = buf[np.minimum(at, len(buf) - 1)] if len(buf) else buf
    out[begin + size - 1] = _END
    return out, begin, which


def grams(word_bytes: np.ndarray, begin: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For every byte the n-gram that ends there, its bytes as one number (0 before the word)."""
    depth = np.arange(len(word_bytes)) - np.repeat(begin, np.diff(np.append(begin, len(word_bytes))))
    out = word_bytes.astype(np.int64)
    for k in range(1, min(order, len(word_bytes))):
        out[k:] += np.where(depth[k:] >= k, word_bytes[:len(word_bytes) - k].astype(np.int64), 0) << (8 * k)
    return out


@dataclass
class Evidence:
    """Log-likelihood ratios: of known n-grams, and of known contexts followed by anything else; both arrays of keys sorted."""

    keys: np.ndarray
    ratios: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray

    def words(self, word_bytes: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Evidence of every distinct word."""
        if not len(begin):
            return np.zeros(0)
        key = grams(word_bytes, begin)
        out = _looked_up(self.contexts, self.backoff, key >> 8)
        at, found = _places(self.keys, key)
        out[found] = self.ratios[at[found]]
        return np.add.reduceat(out, begin)


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at, found = _places(keys, wanted)
    return np.where(found, values[at] if len(values) else 0.0, 0.0)


def shared_model(keys: np.ndarray, order: int) -> np.ndarray:
    """S(last byte | bytes before) of every distinct n-gram of ``order`` bytes, by continuation counts of all orders below it.

    ``keys`` of order k + 1 give the continuation counts of order k; order 0 is uniform over bytes.
    """
    if order == 0:
        return np.full(len(keys), 1 / 256)
    mask = (1 << (8 * order)) - 1
    grams_, back = np.unique(keys & mask, return_inverse=True)
    count = np.bincount(back, minlength=len(grams_)) if order < ORDER else np.ones(len(grams_))
    lower = shared_model(grams_, order - 1)
    d = np.array((0.0,) + modified_discounts(*[int((count == k).sum()) for k in (1, 2, 3, 4)]))
    took = d[np.minimum(count, 3).astype(int)]
    context, of = np.unique(grams_ >> 8, return_inverse=True)
    total, left = np.bincount(of, count), np.bincount(of, took)
    return ((np.maximum(count - took, 0) + left[of] * lower) / total[of])[back]


def evidence(keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> Evidence:
    """From the counts of every n-gram in the two classes."""
    keep = (toxic > 0) | (ordinary > 0)
    keys, toxic, ordinary = keys[keep], toxic[keep], ordinary[keep]
    below = shared_model(keys, ORDER - 1)
    contexts, of = np.unique(keys >> 8, return_inverse=True)
    logs, backs = [], []
    for count in (toxic, ordinary):
        d = np.array((0.0,) + modified_discounts(*[int((count == k).sum()) for k in (1, 2, 3, 4)]))
        took = d[np.minimum(count, 3)]
        total, left = np.bincount(of, count, len(contexts)), np.bincount(of, took, len(contexts))
        weight = np.where(total > 0, left / np.maximum(total, 1), 1.0)
        logs.append(np.log(np.where(total[of] > 0, (count - took) / np.maximum(total[of], 1), 0) + weight[of] * below))
        backs.append(np.log(weight))
    return Evidence(keys, logs[0] - logs[1], contexts, backs[0] - backs[1])


# --- texts ------------------------------------------------------------------------------------------
def described(texts: list[bytes], model: Evidence) -> np.ndarray:
    """Per text: mean evidence of its words, that of its strongest words (places TOP), log of its length. Zeros without words."""
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    top = np.zeros((len(texts), TOP[-1]))
    for buf, start, end, text in word_buffers(texts):
        word_bytes, begin, which = distinct_words(buf, start, end)
        own = model.words(word_bytes, begin)[which] if len(which) else np.zeros(0)
        total += np.bincount(text, own, len(texts))
        n += np.bincount(text, minlength=len(texts))
        order = np.lexsort((-own, text))
        first = np.searchsorted(text[order], np.arange(len(texts) + 1))
        new = np.zeros((len(texts), TOP[-1]))
        for k in range(TOP[-1]):
            have = np.flatnonzero(first[:-1] + k < first[1:])
            new[have, k] = np.maximum(own[order[first[have] + k]], 0)
        top = -np.sort(-np.concatenate([top, new], axis=1), axis=1)[:, :TOP[-1]]
    return np.column_stack([total / np.maximum(n, 1), top[:, [k - 1 for k in TOP]], np.log1p(n)])


FEATURES = len(TOP) + 2


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (last: intercept) by Newton steps with a small ridge; classes count as they are."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


@dataclass
class Classifier:
    model: Evidence
    scale: np.ndarray
    weights: np.ndarray

    def score(self, texts: list[bytes]) -> np.ndarray:
        x = described(texts, self.model) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def labelled_sample(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label, half): at most about ``per_class`` documents of each class, by hash of doc_id; a doc_id counts once, as 1 if any row says so."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("label") == 1, per_class / max(sizes.get(1, 0), 1)).otherwise(per_class / max(sizes.get(0, 0), 1))
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 20))
    return rows.where(place < share * (1 << 20)).withColumn("half", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2)).cast("int"))


def trained(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, even: float = THRESHOLD) -> Classifier:
    """From labelled documents: ``labels`` (doc_id, toxic) of the rows to learn from, null labels left out. A text as likely toxic as not scores ``even``."""
    sample = labelled_sample(labels, "toxic", per_class)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("text", "label", "half")
    count_schema = pa.schema([("half", pa.int32()), ("label", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])

    def count(batches: Batches) -> Batches:
        for b in portions(batches):
            kinds = b.column("half").to_numpy() * 2 + b.column("label").to_numpy()
            texts = as_bytes(b.column("text"), lower=True)
            for kind in np.unique(kinds).tolist():
                keys, counts = [], []
                for buf, start, end, _ in word_buffers([texts[i] for i in np.flatnonzero(kinds == kind)]):
                    word_bytes, begin, which = distinct_words(buf, start, end)
                    keys.append(grams(word_bytes, begin))
                    counts.append(np.repeat(np.bincount(which, minlength=len(begin)), np.diff(np.append(begin, len(word_bytes)))))
                key, n = summed(np.concatenate(keys), np.concatenate(counts))
                yield batch(count_schema, half=np.full(len(key), kind // 2, np.int32), label=np.full(len(key), kind % 2, np.int32), key=key, n=n)

    n_of = lambda half, label: F.sum(F.when((F.col("half") == half) & (F.col("label") == label), F.col("n")).otherwise(0)).alias(f"n{half}{label}")
    counts = texts.mapInArrow(count, "half int, label int, key long, n long").groupBy("key").agg(*[n_of(h, y) for h in (0, 1) for y in (0, 1)])
    found = counts.toArrow().sort_by("key")  # bounded by the sample
    key, n00, n01, n10, n11 = (found.column(c).to_numpy() for c in ("key", "n00", "n01", "n10", "n11"))
    halves = evidence(key, n11, n10), evidence(key, n01, n00)  # for the first half the models of the second, and the other way round
    model = evidence(key, n01 + n11, n00 + n10)
    feature_schema = pa.schema([("label", pa.int32()), ("x", pa.list_(pa.float64()))])

    def describe(batches: Batches) -> Batches:
        for b in portions(batches):
            texts, half, label = as_bytes(b.column("text"), lower=True), b.column("half").to_numpy(), b.column("label").to_numpy()
            for h in (0, 1):
                mine = np.flatnonzero(half == h)
                yield batch(feature_schema, label=label[mine], x=list(described([texts[i] for i in mine], halves[h])))

    rows = texts.mapInArrow(describe, "label int, x array<double>").orderBy("label", "x").toArrow()  # bounded by the sample
    y = rows.column("label").to_numpy().astype(float)
    x = np.array(rows.column("x").to_pylist()).reshape(len(y), FEATURES)
    if len(np.unique(y)) < 2:  # nothing to tell apart: the score is the share of the class, or a half
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Classifier(model, np.ones(FEATURES), np.append(np.zeros(FEATURES), np.log(share / (1 - share))))
    scale = x.std(0) + 1e-9
    weights = logistic_fit(x / scale, y)
    weights[-1] += np.log(even / (1 - even))
    return Classifier(model, scale, weights)


def scored(docs: DataFrame, classifier: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs`` (doc_id LONG, text STRING).

    Null and empty texts get the score of a text without words. doc_id may be null or repeat. Other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Batches) -> Batches:
        for b in portions(batches):
            score = classifier.score(as_bytes(b.column("text"), lower=True))
            yield batch(schema, doc_id=b.column("doc_id"), score=score, predicted=(score >= threshold).astype(np.int32))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def without_toxic(docs: DataFrame, classifier: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    def low(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            rows = portions([pa.RecordBatch.from_arrays([t], ["text"])])
            yield pa.array(np.concatenate([np.zeros(0, bool), *(classifier.score(as_bytes(b.column("text"), lower=True)) < threshold for b in rows)]))
    return docs.where(F.arrow_udf(low, "boolean")("text"))
