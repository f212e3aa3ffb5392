"""Spelling variants: words that differ by one code point, found in sorted rotations (a permuterm index).

A word w ends with a terminator and stands in the index under all rotations of that. For a word x+a+y the rotation that begins behind a is
``y | x a``: without its last character it is the key ``y | x``, which every word x+b+y has as well (a replacement), and which
is a whole rotation of x+y (an insertion or deletion). So with

* a *whole* row for each rotation of a word (the key is all of it), and
* a *cut* row for each character (the key is the rotation without it, the last),

the words near each other are those that meet under one key, and sorted by key they stand together. A replacement has one
place and so meets under one key only. An inserted character may stand anywhere in a run of equal ones; it counts at the first of the
run. A group has at most one whole row and one cut row per letter of the alphabet, so groups are small whatever the table, and the scan
emits per member how many are near it there and the best of them, never pairs.

Keys of more than ``LONGEST`` characters are written as a 127-bit polynomial remainder, so a word of n characters has 2 n + 1 rows
of bounded size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geocadence.llm.tables import Batches, batch
from geocadence.llm.words import as_bytes, portions
from geocadence.session import stored

LEAST, TWICE, RATIO, EVERY, LONGEST, FLUSH = 7, 2, 10, 31, 64, 400_000
MARK = "|"
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_PRIME, _BASE = (1 << 127) - 1, 0x5DEECE66D1234567 << 32 | 0x9E3779B9
_COUNT = pa.schema([("word", pa.string()), ("n", pa.int64())])
_ROW = pa.schema([("key", pa.string()), ("letter", pa.string()), ("n", pa.int64())])
_NEAR = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
_NEAR_DDL = "word string, near long, best_n long, best string"


# --- words ------------------------------------------------------------------------------------------
def changed(doc, run: str, every: int = EVERY) -> str:
    """The run, or for one of ``every`` by the crc32 of ``doc:run`` without one code point. A null doc is written as nothing."""
    h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
    at = h % len(run)
    return run if h % every else run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least: int = LEAST, twice: int = TWICE, every: int = EVERY, flush: int = FLUSH) -> DataFrame:
    """(word, n): words of at least ``least`` code points that occur at least ``twice`` times in ``docs`` (doc_id LONG, text STRING).

    Only A-Z are lower-cased. A task adds words up, ``flush`` distinct ones at a time, before they are shuffled.
    """
    some = re.compile(f"{_RUN.pattern[:-1]}{{{least},}}")

    def run(batches: Batches) -> Batches:
        seen: Counter = Counter()
        for b in portions(batches):
            for doc, text in zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text"), lower=True)):
                own = Counter(some.findall(text.decode()))
                for word in [w for w in own if zlib.crc32(f"{'' if doc is None else doc}:{w}".encode()) % every == 0]:
                    n, new = own.pop(word), changed(doc, word, every)
                    if len(new) >= least:
                        seen[new] += n
                seen.update(own)
            if len(seen) > flush:
                yield batch(_COUNT, word=list(seen), n=list(seen.values()))
                seen = Counter()
        if seen:
            yield batch(_COUNT, word=list(seen), n=list(seen.values()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= twice)


# --- rotations --------------------------------------------------------------------------------------
def rotations(word: str, longest: int = LONGEST) -> Iterator[tuple[str, str]]:
    """(key, letter) rows of a word: its whole rotations with letter "", and the cut ones with the letter that is left out.

    A letter that follows an equal one is written after MARK: no insertion counts there.
    """
    n = len(word)
    if n + 1 <= longest:
        for i in range(n + 1):
            yield word[i:] + MARK + word[:i], ""
    else:
        sums, powers = _sums(word)
        for i in range(n + 1):
            yield _digest(sums, powers, i, i, n), ""
    for i, letter in enumerate(word):
        key = word[i + 1:] + MARK + word[:i] if n <= longest else _digest(sums, powers, i, i + 1, n)
        yield key, MARK + letter if i and word[i - 1] == letter else letter


def _sums(word: str) -> tuple[list[int], list[int]]:
    sums, powers = [0], [1]
    for c in word:
        sums.append((sums[-1] * _BASE + ord(c)) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    return sums, powers


def _digest(sums: list[int], powers: list[int], head: int, tail: int, n: int) -> str:
    """Remainder of ``word[tail:] + MARK + word[:head]``, as text that no key of letters is equal to."""
    value = (sums[n] - sums[tail] * powers[n - tail]) % _PRIME
    value = (value * _BASE + ord(MARK)) % _PRIME
    return f"{MARK}{n - tail + 1 + head}{MARK}{(value * powers[head] + sums[head]) % _PRIME:x}"


def _longer(key: str, letter: str) -> str:
    """The word of a cut row (letter) or a whole row (""), for keys of letters."""
    tail, _, head = key.partition(MARK)
    return head + letter + tail


# --- the scan ---------------------------------------------------------------------------------------
def group_rows(members: list[tuple[str, int, bool, bool]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, how many are near it in the group, n and word of the best of them) from (word, n, whole, repeated letter) of one key.

    Cut rows are near each other; the whole row is near the cut rows whose letter follows no equal one.
    """
    ranked = sorted(members, key=lambda m: (-m[1], m[0]))
    cuts = [m for m in ranked if not m[2]]
    base = next((m for m in ranked if m[2]), None)
    for m in cuts:
        near = [x for x in cuts[:2] if x is not m][:1] + ([base] if base and not m[3] else [])
        if near:
            best = min(near, key=lambda x: (-x[1], x[0]))
            yield m[0], len(cuts) - 1 + (base is not None and not m[3]), best[1], best[0]
    if base and (near := [m for m in cuts if not m[3]]):
        yield base[0], len(near), near[0][1], near[0][0]


def neighbours(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have a near one; ``words``: (word, n), distinct."""
    wide = _ROW.append(pa.field("word", pa.string()))

    def turn(batches: Batches) -> Batches:
        for b in batches:
            rows, size = [], 0
            for word, n in zip(*(c.to_pylist() for c in b.columns)):
                kept = word if len(word) >= longest else None  # else the key tells the word
                for key, letter in rotations(word, longest):
                    rows.append((key, letter, n, kept))
                    size += 64 + (len(word) if kept else 0)
                    if size > 8 << 20:
                        yield batch(wide, **dict(zip(wide.names, zip(*rows))))
                        rows, size = [], 0
            if rows:
                yield batch(wide, **dict(zip(wide.names, zip(*rows))))

    def scan(batches: Batches) -> Batches:
        key, members = None, []
        for b in batches:
            out = []
            for k, letter, n, word in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    if len(members) > 1:
                        out += group_rows(members)
                    key, members = k, []
                members.append((word or _longer(k, letter[-1:]), n, letter == "", letter[:1] == MARK))
            yield batch(_NEAR, **dict(zip(_NEAR.names, zip(*out) if out else [[]] * 4)))
        if len(members) > 1:
            yield batch(_NEAR, **dict(zip(_NEAR.names, zip(*group_rows(members)))))

    rows = words.select("word", "n").mapInArrow(turn, "key string, letter string, n long, word string")
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(scan, _NEAR_DDL)
    most = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("first")
    found = found.groupBy("word").agg(F.sum("near").alias("n_near"), most)
    return found.select("word", "n_near", (-F.col("first.m")).alias("best_n"), F.col("first.w").alias("best"))


def variants(words: DataFrame, ratio: int = RATIO, longest: int = LONGEST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n).

    form is the near word of largest n, ties to the smallest by code point, if that n is at least ``ratio`` times the word's; root is the
    last word that forms lead to, the word itself without a form. n grows along forms, so they have no cycles, and each round doubles the
    steps taken: the rounds are the logarithm of the longest way.
    """
    words = stored(words, "permuterm-words")
    near = stored(neighbours(words, longest), "permuterm-near")
    rows = words.join(near, "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    rows = stored(rows.select("word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best_n")).alias("form_n")), "permuterm-forms")
    ways = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ways = stored(ways, "permuterm-roots")
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if ways.join(onward, "root", "left_semi").isEmpty():
            break
        ways = ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return rows.join(ways, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, least: int = LEAST, twice: int = TWICE, ratio: int = RATIO, every: int = EVERY, longest: int = LONGEST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``docs`` (doc_id LONG, text STRING): runs of A-Z, a-z and U+00C0 to U+00FF.

    Null and empty texts have no words; a null doc_id is written as nothing where a run is changed. Rows that repeat count
    again. An empty table gives no rows. Other columns are not read.
    """
    return variants(word_counts(docs, least, twice, every), ratio, longest)
