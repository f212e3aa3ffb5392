"""Mixing against exact targets, and its permutations."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cases import documents, frame
from geocadence.llm.mixing import mix_counts, mixed_documents, mixed_slots, permuted, targets


def words(t):
    return (t or "").encode().split()


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by giving out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if share * weight[s] > most * sizes[s]}
        if not above:
            target |= {s: share * weight[s] for s in open_}
            break
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= above
    return target


@pytest.mark.parametrize("block", [7, 64, 512])
def test_targets_are_met_to_the_word(spark, block):
    rows = documents()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = filled(sizes)
    got = mix_counts(frame(spark), block=block).collect()
    assert len(got) == len(rows) and Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows)
    by = {round(t, 6): s for s, t in want.items()}
    assert {round(r.target, 6) for r in got} == set(by)
    taken = defaultdict(int)
    for r in got:
        s = by[round(r.target, 6)]
        taken[s] += r.taken
        assert r.taken <= 3 * r.size and r.source_size == sizes[s]
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = mix_counts(frame(spark).repartition(7), block=block).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_water_filling(spark):
    for sizes in ({"a": 1, "b": 100, "c": 100}, {"a": 1, "b": 1, "c": 1000, None: 5}, {"x": 0, "y": 0}, {"x": 0, "y": 9}, {"only": 7}, {chr(97 + i): (i * 37) % 11 for i in range(20)}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in targets(df).collect()}
        assert got == pytest.approx(filled(sizes))


def test_permutations(spark):
    for n in (1, 2, 3, 10, 257, 1000):
        df = spark.range(n).withColumn("p", permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3))).withColumn("q", permuted(F.col("p"), F.lit(n).cast("long"), F.lit(3), inverse=True))
        rows = df.collect()
        assert sorted(r.p for r in rows) == list(range(n)) and all(r.q == r.id for r in rows)
    assert sum(r.p == r.id for r in rows) < 20


def test_slots_fill_shards(spark):
    sources = spark.createDataFrame([(1, 1000, 2500.0), (2, 333, 333.0), (3, 90, 45.0)], "source_id long, source_size long, target double")
    slots = mixed_slots(sources, 10, shard_slots=16).collect()
    assert sorted((r.shard, r.place) for r in slots) == [(i // 16, i % 16) for i in range(len(slots))]
    assert {s: sum(r.words for r in slots if r.source_id == s) for s in (1, 2, 3)} == {1: 2500, 2: 333, 3: 45}
    counts = Counter((r.shard, r.source_id) for r in slots)
    assert len({counts[g, 1] for g in range(len(slots) // 16)}) > 1  # drawn, not dealt evenly


def test_documents_of_the_mix(spark):
    rows = documents()
    unique = list(dict.fromkeys(rows))
    df = frame(spark, unique)
    out = mixed_documents(df, block=16).collect()
    counts = {(r.doc_id, r.size): r.taken for r in mix_counts(df, block=16).collect()}
    got, texts = Counter(), {(r[0], len(words(r[1]))): r[1] for r in unique}
    for r in out:
        mine = [(k, t) for k, t in texts.items() if k[0] == r.doc_id and (t == r.text or set(words(r.text)) <= set(words(t)))]
        assert mine and r.n_chars == len(r.text)
        got[r.doc_id] += len(words(r.text))
    want = Counter()
    for (i, _), taken in counts.items():
        want[i] += taken
    assert +got == +want and list(df.columns) == list(out[0].__fields__)


def test_equal_rows_are_all_written(spark):
    rows = documents()
    rows += [rows[30]] * 2500 + [(*rows[30][:2], "xx", *rows[30][3:])] * 3
    df = frame(spark, rows)
    want, got = Counter(), Counter()
    for r in mix_counts(df, block=16).collect():
        want[r.doc_id] += r.taken
    for r in mixed_documents(df, block=16).collect():
        got[r.doc_id] += len(words(r.text))
    assert +got == +want


def test_empty_table(spark):
    assert mix_counts(frame(spark, [])).count() == 0 == mixed_documents(frame(spark, [])).count()
    assert [tuple(r)[1:5] for r in mix_counts(frame(spark, [documents()[-5]][:0] + [(1, None, "", "s", 0, "", 1, "", 1, "")])).collect()] == [(0, 0, 0.0, 0)]
