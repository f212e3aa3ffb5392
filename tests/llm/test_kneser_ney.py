"""The language model against a direct computation with dictionaries."""

import math
import random
from collections import Counter, defaultdict

import pytest

from geocadence.llm.kneser_ney import modified_discounts, scored, trained

DDL = "doc_id long, text string, source int"


def brute(train, texts):
    cut = lambda t: [w for w in (t or "").encode().lower().split()] + [None]
    uni, bi = Counter(), Counter()
    for t in train:
        toks = cut(t)
        uni.update(toks)
        bi.update(zip(["<s>"] + toks[:-1], toks))
    n, v = sum(uni.values()), len(uni)
    a, follow, total = Counter(w for _, w in bi), defaultdict(Counter), Counter()
    for (x, w), c in bi.items():
        follow[x][min(c, 3)] += 1
        total[x] += c
    d = (0,) + modified_discounts(*[sum(c == k for c in bi.values()) for k in (1, 2, 3, 4)])
    e = (0,) + modified_discounts(*[sum(c == k for c in a.values()) for k in (1, 2, 3, 4)])
    pre = sum(a.values())
    left = sum(e[min(c, 3)] for c in a.values()) / pre if pre else 1
    out = []
    for t in texts:
        toks = cut(t)
        score = base = 0
        for x, w in zip(["<s>"] + toks[:-1], toks):
            q = (max(a[w] - e[min(a[w], 3)], 0) / pre if pre else 0) + left / (v + 1)
            if total[x]:
                c = bi[x, w]
                q = (max(c - d[min(c, 3)], 0) + sum(d[k] * m for k, m in follow[x].items()) * q) / total[x]
            score += math.log10(q)
            base += math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1)))
        out.append((len(toks), sum(w in uni for w in toks), n, base, score))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_dictionaries(spark, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    texts = [None, "", " \t\n", "Ä ä ß", "A" * 3000, "a b " * 2000] + [" ".join(rnd.choices(words, [1 / (i + 1) for i in range(30)], k=rnd.randint(1, 40))) for _ in range(120)]
    texts += [texts[10]] * 5 + ["the w1 W1\x0bw2"]
    rows = [(i if i else None, t, 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DDL).repartition(3)
    train = [t for i, t in enumerate(texts) if i % 4]
    model = trained(spark.createDataFrame([(t,) for t in train], "text string").repartition(4))
    got = {r.doc_id if r.doc_id is not None else 0: r for r in scored(df, model).collect()}
    for i, want in enumerate(brute(train, texts)):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert r.base_score == pytest.approx(want[3], rel=1e-9) and r.score == pytest.approx(want[4], rel=1e-9)


def test_counts_over_a_byte_and_probabilities_sum_to_one(spark):
    model = trained(spark.createDataFrame([("x y",)] * 700 + [("x z",)] * 3, "text string"), bits=3)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["x y", "x z", "x x", "x", "x q"])], "doc_id long, text string")
    got = {r.doc_id: r.score for r in scored(rows, model).collect()}
    want = brute(["x y"] * 700 + ["x z"] * 3, ["x y", "x z", "x x", "x", "x q"])
    assert [got[i] for i in range(5)] == pytest.approx([w[4] for w in want], rel=1e-9)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = trained(none)
    row = scored(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isfinite(row.score)
    assert scored(none, trained(spark.createDataFrame([("a",)], "text string"))).count() == 0
