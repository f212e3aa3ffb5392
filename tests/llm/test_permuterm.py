"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from cases import documents, frame

from geocadence.llm.permuterm import MARK, neighbours, rotations, spelling_groups, variants, word_counts


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=10):
    close = {w: [v for v in counts if near(v, w)] for w in counts}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(close[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def brute_counts(rows, least=7, every=31):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def words(seed, alphabet, n=250):
    """Few stems and many changes of them, with runs of equal letters and counts that make long ways."""
    rnd = random.Random(seed)
    out = {}
    for _ in range(n):
        w = list(rnd.choice([*out] or ["aabbaab"])) if out and rnd.random() < 0.8 else rnd.choices(alphabet, k=rnd.randint(2, 9))
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randrange(len(w) + 1)
            w[at:at + rnd.randint(0, 1)] = rnd.choices(alphabet, k=rnd.randint(0, 1))
        if w:
            out["".join(w)] = rnd.choice([2, 3, 25, 260, 2700, 30000])
    return out


@pytest.mark.parametrize("seed, alphabet, longest", [(1, "ab", 64), (2, "abc", 64), (3, "abcdeféÿß", 64), (4, "ab", 4), (5, "abc", 1), (6, "abé", 7)])
def test_equals_all_pairs(spark, seed, alphabet, longest):
    counts = words(seed, alphabet)
    got = variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5), longest=longest).collect()
    want = brute(counts)
    assert sorted(map(tuple, got)) == want and any(r[2] not in (r[0], r[1]) for r in want)


def test_words_of_documents(spark):
    rnd = random.Random(8)
    stems = ["kitchen", "KITCHEN", "sitting", "Élégance", "élégance", "commmittee", "committee", "straße", "straßen", "naïvement", "l" * 3000, "l" * 2999 + "k", "w" * 70]
    more = [(2000 + i, " ".join(rnd.choices(stems, k=40)) + rnd.choice(["_x", "9kitchens", "×kitchen÷", "kitch-en"]), None, None, 0, None, -1, "k", 0, "x") for i in range(90)]
    rows = documents() + more
    counts = brute_counts(rows)
    assert {r.word: r.n for r in word_counts(frame(spark, rows)).collect()} == counts
    assert {r.word: r.n for r in word_counts(frame(spark, rows), flush=3).collect()} == counts
    assert sorted(map(tuple, spelling_groups(frame(spark, rows)).collect())) == brute(counts)


def test_long_words_have_short_keys():
    rows = list(rotations("ab" * 4000))
    assert len(rows) == 16001 and max(len(k) for k, _ in rows) < 64
    assert len({k for k, letter in rows if not letter}) == 8001
    short = list(rotations("aab"))
    assert short == [("aab" + MARK, ""), ("ab" + MARK + "a", ""), ("b" + MARK + "aa", ""), (MARK + "aab", ""), ("ab" + MARK, "a"), ("b" + MARK + "a", MARK + "a"), (MARK + "aa", "b")]


def test_groups_stay_small(spark):
    """One letter after a common stem: a group holds a row per letter, however many words share the stem."""
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    counts = {"stemmed" + a + b: 2 for a in letters for b in letters[:12]} | {"stemmeda": 500}
    got = {r.word: r for r in neighbours(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got["stemmedaa"].n_near == len(letters) - 1 + 11 + 1 and got["stemmedaa"].best == "stemmeda" and got["stemmeda"].n_near == len(letters) + 12 - 1


def test_empty_table(spark):
    assert spelling_groups(frame(spark, [])).count() == 0
