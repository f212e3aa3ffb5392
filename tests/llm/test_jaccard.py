"""Similarity join against all pairs."""

import random

import numpy as np
import pytest

from cases import documents, frame
from geocadence.llm.jaccard import least_linking, need, one_of_each, prefix_length, similar_classes
from geocadence.llm.tables import bitmap, components, in_bitmap
from geocadence.llm.words import portions, shingle_sets, word_hashes


def shingles(t, width):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, percent, width):
    sets = [shingles(r[1], width) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), low[root(i)] if r[0] is not None else None) for i, r in enumerate(rows)), key=repr)


def chain(n, seed):
    """Texts that drift: neighbours are similar, the ends are not; and many that share a passage only."""
    rnd = random.Random(seed)
    words = [f"v{i}" for i in range(4000)]
    text = rnd.choices(words, k=90)
    passage = " ".join(rnd.choices(words, k=45))
    rows = []
    for i in range(n):
        text = list(text)
        text[rnd.randrange(len(text))] = rnd.choice(words)
        rows.append((i * 2, " ".join(text)))
        rows.append((i * 2 + 1, " ".join(rnd.choices(words, k=rnd.randint(3, 50))) + " " + passage))
    return rows


@pytest.mark.parametrize("percent, width, boundary", [(90, 3, None), (80, 5, None), (90, 3, 0), (90, 3, 10**6), (80, 5, 30)])
def test_equals_all_pairs(spark, percent, width, boundary):
    rows = documents()
    got = similar_classes(frame(spark), percent, width, boundary=boundary).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, percent, width)


@pytest.mark.parametrize("common", [3, 30])
def test_chains_and_shared_passages(spark, common):
    rows = chain(60, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = similar_classes(df, 80, 3, common=common).collect()
    want = brute(rows, 80, 3)
    assert sorted(map(tuple, got), key=repr) == want and len({r[2] for r in want}) < len(rows)


def test_one_of_each(spark):
    rows = documents()
    groups = brute(rows, 80, 5)
    out = one_of_each(frame(spark))
    assert out.columns == frame(spark).columns
    got = [r for r in out.collect() if r.doc_id is not None and shingles(r.text, 5)]
    assert {r.doc_id for r in got} == {c for i, n, c in groups if n and i is not None}
    texts = [r for r in rows if r[0] is not None and shingles(r[1], 5)]
    link = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    left = [shingles(r.text, 5) for r in got]
    assert not any(link(a, b) for i, a in enumerate(left) for b in left[:i])
    alike = brute([(i, r[1]) for i, r in enumerate(texts)], 80, 5)
    assert len(got) == len({c for _, _, c in alike})
    assert sum(r.doc_id is None or not shingles(r.text, 5) for r in out.collect()) == sum(r[0] is None or not shingles(r[1], 5) for r in rows)


def test_unrelated_texts_of_one_id_all_stay(spark):
    rnd = random.Random(7)
    a, b = ([f"{x}{rnd.randrange(500)}" for _ in range(80)] for x in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(a[1:])), (3, " ".join(b[1:])), (4, "c " * 30), (1, " ".join(a)), (5, " ".join(b[2:])), (5, " ".join(a[2:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in one_of_each(df).collect()) == sorted([(1, " ".join(a)), (1, " ".join(b)), (4, "c " * 30)])
    assert sorted(r.component_id for r in similar_classes(df, 80, 5).collect()) == [1] * 7 + [4]
    chained = [(9, " ".join(a)), (9, " ".join(a[1:])), (7, " ".join(a[2:]))]
    assert [tuple(r) for r in one_of_each(spark.createDataFrame(chained, "doc_id long, text string")).collect()] == [chained[2]]


def test_empty_table(spark):
    assert similar_classes(frame(spark, [])).count() == 0 == one_of_each(frame(spark, [])).count()


def test_bounds():
    for percent in (80, 90):
        for n in range(1, 400):
            assert 100 * need(n, percent) >= percent * n > 100 * (need(n, percent) - 1)
            assert prefix_length(n, 1, percent) == n - need(n, percent) + 1 or n == 0
        k = least_linking(percent)
        assert 100 * k >= percent * (k + 1) and 100 * (k - 1) < percent * k


def test_words_of_any_length(monkeypatch):
    import geocadence.llm.words as w
    texts = [r[1].encode().lower() if r[1] else b"" for r in documents()]
    want, sets = word_hashes(texts), list(shingle_sets(texts, 5))
    assert list(np.diff(want[1])) == [len(t.split()) for t in texts]
    assert [len(s) for s in sets] == [len(shingles(t.decode(), 5)) for t in texts]
    monkeypatch.setattr(w, "SLICE", 64)
    again = word_hashes(texts)
    assert (again[0] == want[0]).all() and (again[1] == want[1]).all()


def test_portions_keep_every_row():
    import pyarrow as pa
    b = pa.record_batch({"text": ["a" * n for n in (0, 5, 100, 1, 1, 1, 300)] + [None]})
    parts = list(portions([b], limit=100))
    assert [x for p in parts for x in p.column("text").to_pylist()] == b.column("text").to_pylist() and len(parts) > 2


def test_bitmap_has_all_its_keys(spark):
    keys = [-5, 0, 7, 2**62, -2**63]
    packed = bitmap(spark.createDataFrame([(k,) for k in keys], "k long"), 18)
    assert in_bitmap(packed, np.array(keys)).all() and in_bitmap(packed, np.arange(1000, 2000)).sum() < 50


def test_components(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, i) for i in range(5001, 5100)] + [(7, 7)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: root(i) for i in up}
