"""Nearest vectors and reply links against brute force."""

import inspect
import math
import random

import numpy as np
from pyspark.sql import functions as F

from geocadence.llm.forest import in_groups, leaves_for, nearest
from geocadence.llm.queries import mailbox
from geocadence.llm.quotes import conversations, level_of, parsed

DDL = "vec_id long, embedding array<float>, label int, v int, rank string"


def brute(rows, queries, k):
    ok = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in queries:
        for i, v in ok:
            if i == q:
                a = np.array(v, np.float32).astype(float)
                score = sorted((-float(a @ np.array(w, np.float32).astype(float)), j) for j, w in ok if j != q)
                out[q] = score[:k]
    return out


def vectors(n=600, seed=1):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, 8)).round(2)
    rows = [(i, x[i].tolist(), 0, 1, "r") for i in range(n)]
    rows += [(n + i, x[7].tolist(), 0, 1, "r") for i in range(90)]         # one vector many times
    rows += [(2000, None, 0, 1, "r"), (2020, [0.0] * 8, 0, 1, "r"), (2040, [1.0, None] + [0.0] * 6, 0, 1, "r"), (2060, [float("nan")] + [1.0] * 7, 0, 1, "r"),
             (2080, [float("inf")] + [1.0] * 7, 0, 1, "r"), (2100, [1.0, 2.0], 0, 1, "r"), (None, x[3].tolist(), 0, 1, "r"), rows[5], rows[40]]
    return rows


def test_recall_and_exact_scores(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, DDL).repartition(4)
    got = nearest(df, df.where("vec_id % 20 = 0").select("vec_id"), 20, trees=6, leaf=16).collect()
    want = brute(rows, range(0, 2200, 20), 20)
    assert {r.query_id for r in got} == set(want)
    true, found = {}, 0
    for q, best in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(best) + 1)) and len({r.vec_id for r in mine}) == len(mine)
        assert all(a.score > b.score or a.score == b.score and a.vec_id < b.vec_id for a, b in zip(mine, mine[1:]))
        true = {j for _, j in best}
        found += len(true & {r.vec_id for r in mine}) / len(true)
    assert found / len(want) >= 0.9
    exact = nearest(df, df.select("vec_id").where("vec_id % 20 = 0"), 20, trees=3, leaf=16, recall=1.0).collect()
    by = {(r.query_id, r["rank"]): r for r in exact}
    hits = [abs(by[q, i + 1].score + s) < 1e-9 for q, best in want.items() for i, (s, _) in enumerate(best)]
    assert np.mean(hits) > 0.98


def test_groups_are_bounded_and_whole(spark):
    held = spark.range(2000).selectExpr("0 AS block", "20 AS parts", "id AS vec").unionByName(spark.range(50).selectExpr("1 AS block", "1 AS parts", "id AS vec"))
    opened = spark.range(600).selectExpr("0 AS block", "20 AS parts", "id AS query").unionByName(spark.range(600).selectExpr("1 AS block", "1 AS parts", "id AS query"))
    x, y = in_groups(held, opened, 6)
    group = ["block", "part", "chunk"]
    assert x.groupBy(*group).count().agg(F.max("count")).first()[0] < 150 and y.groupBy(*group).count().agg(F.max("count")).first()[0] < 150
    met = x.join(y, group)
    assert met.count() == met.select("block", "vec", "query").distinct().count() == 2000 * 600 + 50 * 600
    df = spark.createDataFrame(vectors(), DDL).repartition(4)
    asked = df.where("vec_id % 20 = 0").select("vec_id")
    whole, cut = (sorted(map(tuple, nearest(df, asked, 20, trees=3, leaf=16, **most).collect())) for most in ({}, {"most_held": 8 * 100, "most_asking": 8 * 10}))
    assert [r[:3] for r in whole] == [r[:3] for r in cut] and np.allclose([r[3] for r in whole], [r[3] for r in cut], rtol=0, atol=1e-12)


def test_enough_trial_vectors():
    assert inspect.signature(leaves_for).parameters["trial"].default >= 128


def test_few_or_no_candidates(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (21, [0.5, 0.5])], "vec_id long, embedding array<float>")
    got = nearest(few, few.where("vec_id % 20 = 0").select("vec_id"))
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got.collect()) == [(0, 1, 20), (0, 2, 21), (20, 1, 0), (20, 2, 21)]
    none = few.where("vec_id < 0")
    assert nearest(none, none.select("vec_id")).count() == 0
    assert nearest(few, none.select("vec_id")).count() == 0


def test_levels():
    assert level_of("> > a") == (2, "a") and level_of(">>b") == (2, "b") and level_of("c > d") == (0, "c > d") and level_of(" >e") == (1, "e")
    body, units = parsed("Yes.\n\nAnn wrote:\n> Shall  WE?\n> > old\n> More")
    assert body == "Yes." and units == [(1, 0, "shall we?"), (2, 1, "old"), (1, 2, "more"), (0, 3, "yes.")]
    assert parsed(None) == ("", []) and parsed("> only") == ("", [(1, 0, "only")])


def test_reply_links(spark):
    rows = [
        (1, "First question here"), (2, "I say no\n> first   QUESTION here"), (3, "An answer\nin two lines\n> First question here"),
        (4, "Me too\n> > First question here\n> I say no"), (5, "partly\n\nBob wrote:\n> in two lines"), (6, "First question here"),
        (7, "late\n> First question here"), (8, "> nobody said this"), (9, None), (10, ""), (11, "> quoting the future"), (12, "quoting the future"),
        (13, "self\n> self"), (None, "no id\n> First question here"), (14, "x" * 5000 + "\n> An answer\n> in two lines"),
    ]
    df = spark.createDataFrame([(i, t, 0, "c") for i, t in rows], "message_id long, text string, depth int, conversation string").repartition(3)
    got = {r.message_id: r for r in conversations(df).collect()}
    replies = {i: r.reply_to for i, r in got.items()}
    assert replies == {1: None, 2: 1, 3: 1, 4: 2, 5: 3, 6: None, 7: 1, 8: None, 9: None, 10: None, 11: None, 12: None, 13: None, 14: 3}
    assert {i: (r.conversation, r.depth) for i, r in got.items() if r.reply_to} == {2: (1, 1), 3: (1, 1), 4: (1, 2), 5: (1, 2), 7: (1, 1), 14: (1, 2)}
    assert got[5].text == "partly" and got[8].text == "" and got[9].text == "" and ">" not in got[4].text
    order = [(r.conversation, r.depth, r.message_id) for r in conversations(df).collect()]
    assert order == sorted(order)


def test_long_chains_and_a_common_passage(spark):
    rnd = random.Random(3)
    rows, parent = [(0, "common words")], {0: None}
    for i in range(1, 80):
        rows.append((i, f"text number {i}\n> text number {i - 1}" if i > 1 else "text number 1\n> common words"))
        parent[i] = i - 1
    for i in range(100, 400):
        rows.append((i, f"common words\n> text number {rnd.randint(1, 79)}" if i % 2 else f"own {i}\n> common words"))
    got = {r.message_id: r for r in conversations(spark.createDataFrame(rows, "message_id long, text string").repartition(4)).collect()}
    assert got[79].depth == 79 and all(r.conversation == 0 for r in got.values())
    assert all(got[i].reply_to == 0 for i in range(100, 400, 2))


def test_turns_that_conversations_share(spark):
    rnd = random.Random(9)
    turns = [(c, t, "a first turn\nof two lines" if t == 0 and c % 2 else rnd.choice(["yes", "no", "thanks"]) + f"\nand {rnd.randrange(2)}" if c % 3 and t < 4 else f"own {c} {t}") for c in range(60) for t in range(6)]
    turns = [(c, t, x if t < 4 or c % 3 == 0 else f"own {c} {t}") for c, t, x in turns]
    mails = mailbox(spark.createDataFrame(turns, "conv_id long, turn long, text string").repartition(4))
    got = {r.message_id: r for r in conversations(mails, latest=True).collect()}
    assert len(got) == len(turns)
    for c, t, _ in turns:
        r = got[(c << 20) + t]
        assert (r.reply_to, r.conversation, r.depth) == ((c << 20) + t - 1 if t else None, c << 20, t)


def test_a_deeper_quotation_tells_originals_apart(spark):
    rows = [(1, "question one"), (2, "question two"), (3, "yes\n> question one"), (4, "yes\n> question two"), (5, "yes"),
            (6, "a\n> yes\n> > question two"), (7, "b\n> yes\n> > question one"), (8, "c\n> yes"), (9, "d\n> yes\n> > something else")]
    mails = spark.createDataFrame(rows, "message_id long, text string").repartition(3)
    first, last = ({r.message_id: r.reply_to for r in conversations(mails, latest=x).collect()} for x in (False, True))
    assert first == {1: None, 2: None, 3: 1, 4: 2, 5: None, 6: 4, 7: 3, 8: 5, 9: 3}
    assert last == first | {9: 5}


def test_no_messages(spark):
    assert conversations(spark.createDataFrame([], "message_id long, text string")).count() == 0
