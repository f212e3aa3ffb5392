"""Quality rules and toxicity models: held-out accuracy, edge cases, and parts against direct computations."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import frame
from geocadence.llm import quality, toxicity
from geocadence.llm.kneser_ney import modified_discounts
from geocadence.llm.queries import LLM_QUERIES
from geocadence.llm.words import word_buffers

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name, label, least", [("op1_quality_rules", "quality", 0.97), ("op10_toxicity", "toxic", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    rows = LLM_QUERIES[name](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = rows.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("hit"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert got.hit >= least and 0 <= got.lo < got.hi <= 1
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def labelled(n=200, seed=1):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = " ".join(rnd.choices(["alpha", "beta", "gamma", "delta", "omega", "rho"], k=rnd.randint(5, 60)))
        rows.append((i, text + (" vilewordxyz" if bad else "") if i % 8 else "spam " * 40, "en", "s", 0, None, 1, "k", 2, "c"))
        labels.append((i, 0 if i % 8 == 0 else 1, int(bad and i % 8 != 0)))
    return rows, labels


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, module):
    rows, labels = labelled()
    odd = [(None, None), (500, ""), (501, " \n"), (502, "x" * 100_000), (503, "alpha beta " * 20_000), (500, ""), (None, "alpha VILEWORDXYZ beta")]
    docs = frame(spark, rows + [(i, t, None, None, None, None, None, None, None, None) for i, t in odd] + rows[:2])
    known = spark.createDataFrame(labels + [(None, 1, 1), (77777, 1, 0), (3, None, None)] + labels[:3], "doc_id long, quality int, toxic int")
    model = module.trained(docs, known)
    got = module.scored(docs, model)
    assert got.columns == ["doc_id", "score", "predicted"] and got.count() == docs.count()
    assert got.where("score IS NULL OR score < 0 OR score > 1").isEmpty()
    truth = {i: q if module is quality else t for i, q, t in labels}
    hits = [r.predicted == truth[r.doc_id] for r in got.collect() if r.doc_id in truth]
    assert np.mean(hits) > 0.95
    assert module.scored(frame(spark, []), model).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_nothing_to_learn_from(spark, module):
    rows, labels = labelled(20)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    alike = spark.createDataFrame([(i, 1, 1) for i, _, _ in labels], "doc_id long, quality int, toxic int")
    assert {r.score for r in module.scored(frame(spark, rows), module.trained(frame(spark, rows), none)).collect()} == {0.5}
    assert all(r.score > 0.9 for r in module.scored(frame(spark, rows), module.trained(frame(spark, rows), alike)).collect())


def test_filter_keeps_columns(spark):
    rows, labels = labelled()
    docs = frame(spark, rows)
    model = toxicity.trained(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = toxicity.without_toxic(docs, model)
    bad = {r.doc_id for r in toxicity.scored(docs, model).where("predicted = 1").collect()}
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - bad and bad


def test_evidence_equals_dictionaries():
    """The two class models of one spelling, computed with dictionaries."""
    order, rnd = toxicity.ORDER, random.Random(4)
    vocabulary = [bytes(rnd.choices(b"abc", k=rnd.randint(1, 9))) for _ in range(40)]
    counts = [Counter(), Counter()]
    for y in (0, 1):
        for w in rnd.choices(vocabulary[y * 5:30 + y * 10], k=400):
            whole = b"\0" * (order - 1) + w + b" "
            for i in range(order - 1, len(whole)):
                counts[y][whole[i - order + 1:i + 1]] += 1

    def shared(gram):  # S(last | rest) by continuation counts of n-gram types
        if not gram:
            return 1 / 256
        k = len(gram)
        types = set(counts[0]) | set(counts[1])
        a = Counter(t[-k:] for t in {t[-k - 1:] for t in types})
        d = (0,) + modified_discounts(*[sum(c == m for c in a.values()) for m in (1, 2, 3, 4)])
        total = sum(c for t, c in a.items() if t[:-1] == gram[:-1])
        left = sum(d[min(c, 3)] for t, c in a.items() if t[:-1] == gram[:-1])
        if not total:
            return shared(gram[1:])
        return (a[gram] - (d[min(a[gram], 3)] if a[gram] else 0) + left * shared(gram[1:])) / total

    def prob(y, gram):
        d = (0,) + modified_discounts(*[sum(c == m for c in counts[y].values()) for m in (1, 2, 3, 4)])
        rest = {t: c for t, c in counts[y].items() if t[:-1] == gram[:-1]}
        s = shared(gram[1:])
        if not rest:
            return s
        c = counts[y][gram]
        return (c - (d[min(c, 3)] if c else 0) + sum(d[min(x, 3)] for x in rest.values()) * s) / sum(rest.values())

    keys = sorted(set(counts[0]) | set(counts[1]), key=lambda t: int.from_bytes(t, "big"))
    model = toxicity.evidence(np.array([int.from_bytes(t, "big") for t in keys]), np.array([counts[1][t] for t in keys]), np.array([counts[0][t] for t in keys]))
    for w in vocabulary[:12] + [b"abca", b"zzz"]:
        (buf, start, end, _), = word_buffers([w])
        word_bytes, begin, _ = toxicity.distinct_words(buf, start, end)
        whole = b"\0" * (order - 1) + w + b" "
        want = sum(math.log(prob(1, whole[i - order + 1:i + 1]) / prob(0, whole[i - order + 1:i + 1])) for i in range(order - 1, len(whole)))
        assert model.words(word_bytes, begin)[0] == pytest.approx(want, abs=1e-9)


def test_statistics():
    text = b"To be, be be!\nline\nline\n  \nA\xc3\xa91"
    row = dict(zip(quality.STATS, quality.statistics([text, b"", b" "])[0]))
    words = text.split()
    assert row["log_words"] == pytest.approx(np.log1p(len(words))) and row["distinct_words"] == pytest.approx(len(set(words)) / len(words))
    assert row["same_lines"] == pytest.approx(0.25) and row["upper_share"] == pytest.approx(2 / len(text)) and row["wide_share"] == pytest.approx(2 / len(text))
    assert (quality.statistics([b"", b" "])[0] == 0).all()


def test_lasso_drops_noise():
    g = np.random.default_rng(2)
    z = (g.random((600, 12)) < 0.5).astype(float)
    y = (z[:, 0] + g.random(600) * 0.2 > 0.6).astype(float)
    _, w = quality.lasso_logistic(z, y, np.ones(600), 0.02)
    assert w[0] > 1 and np.abs(w[1:]).max() < 0.2 * w[0]
