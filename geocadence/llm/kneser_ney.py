"""Interpolated modified Kneser-Ney bigram model, counted by Spark, kept as sorted arrays that workers map into memory.

Tokens are the words of a text (A-Z lower-cased) and one end; the first word follows a start mark.

* Counting runs over all training texts. A task sums its words (then its word pairs) and sends, per shard of the hash range, one block of
  sorted keys and counts. A shard adds its blocks and writes its array to the shared folder: first the words, sorted by
  64-bit hash, whose place is the word's number; then the pairs, sorted by (number, number), with their counts.
* The merged pairs give, by block of word numbers, how many different words precede and follow each word.
* Scoring maps the arrays (``numpy.memmap``: pages are shared by the workers of a machine and are no process memory) and looks up
  the sorted distinct words and pairs of a part of the texts by binary search.

    p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v) + g(v) q(w)        q(w) = max(a(w) - D'(a(w)), 0) / A + g' / (V + 1)

with a(w) the number of different words before w, D and D' the three modified discounts of each order, g and g' what the
discounts took. A word that training lacks has only the last term, as context it leaves p = q.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geocadence.llm.counts import counted, united
from geocadence.llm.tables import Batches, batch, shard_bits
from geocadence.llm.words import as_bytes, mix, portions, word_hashes
from geocadence.session import scratch, stored

_END = np.uint64(0x7E5D1C3B9A48F607)  # stands for the end of a text among the word hashes


# --- arrays in the shared folder --------------------------------------------------------------------
def local_folder(uri: str) -> str:
    """The shared folder as a path every worker has mounted; memory mapping needs one."""
    path = uri.removeprefix("file:") if uri.startswith("file:") else uri
    if "://" in path:
        raise ValueError(f"the model's arrays need a shared folder that workers have mounted, not {uri}")
    return "/" + path.lstrip("/")


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Appears whole or not at all; a repeated task writes the same again."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    array.tofile(part)
    os.replace(part, f"{folder}/{name}")


def mapped(folder: str, name: str, kind, n: int) -> np.ndarray:
    return np.memmap(f"{folder}/{name}", kind, "r", shape=(n,)) if n else np.zeros(0, kind)


_STATS = np.dtype([("c", "<i8"), ("a", "<u4"), ("f1", "<u4"), ("f2", "<u4"), ("f3", "<u4")])


@dataclass
class Model:
    """Where the arrays are, how long they are, and the few numbers that belong to the whole corpus."""

    folder: str
    bits: int                      # shards are the highest bits of a key's hash
    words: list[int]               # words per shard
    pairs: list[int] = field(default_factory=list)
    tokens: int = 0                # N
    starts: int = 0                # training texts
    start_followers: tuple = (0, 0, 0)
    discounts: tuple = (0.0, 0.0, 0.0)
    lower: tuple = (0.0, 0.0, 0.0)
    predecessors: int = 0          # A
    lower_left: float = 0.0        # g'

    @property
    def vocabulary(self) -> int:
        return sum(self.words)

    def open(self) -> "Model":
        """Maps the arrays, once in a worker."""
        if hasattr(self, "_hash"):
            return self
        self._hash = [mapped(self.folder, f"words-{s}", np.uint64, n) for s, n in enumerate(self.words)]
        self._first = np.concatenate([[0], np.cumsum(self.words)]).astype(np.int64)
        self._keys = [mapped(self.folder, f"pairs-{s}", np.uint64, n) for s, n in enumerate(self.pairs)]
        self._counts = [mapped(self.folder, f"pair-counts-{s}", np.uint8, n) for s, n in enumerate(self.pairs)]
        self._stats = [mapped(self.folder, f"stats-{s}", _STATS, n) for s, n in enumerate(self.words)] if self.pairs else []
        return self

    def _shards(self, hashes: np.ndarray) -> np.ndarray:
        """Bounds of the shards in sorted hashes."""
        edges = np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits) if self.bits else np.zeros(0, np.uint64)
        return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of every word, -1 if training lacks it."""
        distinct, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(distinct), -1, np.int64)
        bounds = self._shards(distinct)
        for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if b > a and self.words[s]:
                at = np.minimum(np.searchsorted(self._hash[s], distinct[a:b]), self.words[s] - 1)
                out[a:b] = np.where(self._hash[s][at] == distinct[a:b], at + self._first[s], -1)
        return out[back]

    def stats(self, numbers: np.ndarray) -> np.ndarray:
        """Counts of words by (valid) number."""
        distinct, back = np.unique(numbers, return_inverse=True)
        out = np.zeros(len(distinct), _STATS)
        bounds = np.searchsorted(distinct, self._first)
        for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if b > a:
                out[a:b] = self._stats[s][distinct[a:b] - self._first[s]]
        return out[back]

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(keys, return_inverse=True)
        place = mix(distinct)
        out = np.zeros(len(distinct), np.int64)
        shard = (place >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(place), np.int64)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange((1 << self.bits) + 1))
        for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if b > a and self.pairs[s]:
                own = distinct[order[a:b]]
                at = np.minimum(np.searchsorted(self._keys[s], own), self.pairs[s] - 1)
                found = self._keys[s][at] == own
                count = self._counts[s][at].astype(np.int64)
                many = np.flatnonzero(found & (count == 255))
                if len(many):
                    over = np.fromfile(f"{self.folder}/pair-over-{s}", np.int64).reshape(2, -1)
                    count[many] = over[1][np.searchsorted(over[0], at[many])]
                out[order[a:b]] = np.where(found, count, 0)
        return out[back]

    def score(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """n_tokens, n_known, base and score of every text."""
        hashes, first = word_hashes(texts)
        n = np.diff(first) + 1
        last = np.cumsum(n) - 1
        tokens = np.full(len(hashes) + len(texts), _END, np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[last] = False
        tokens[inner] = hashes
        number = self.numbers(tokens)
        known = number >= 0
        stats = np.zeros(len(number), _STATS)
        stats[known] = self.stats(number[known])
        base = np.log10((stats["c"] + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))
        d = np.array((0.0,) + self.lower)
        left = np.maximum(stats["a"] - d[np.minimum(stats["a"], 3)], 0) / max(self.predecessors, 1)
        q = left + self.lower_left / (self.vocabulary + 1)
        # the word before; texts begin after the start mark
        begins = last - n + 1
        before, begin = np.empty(len(number), np.int64), np.zeros(len(number), bool)
        before[1:], before[:1] = number[:-1], -1
        begin[begins] = True
        before[begin] = self.vocabulary
        total = np.empty(len(number))
        total[1:], total[:1] = stats["c"][:-1], 0
        total[begin] = self.starts
        d = np.array((0.0,) + self.discounts)
        follow = [np.empty(len(number)) for _ in range(3)]
        for f, name, own in zip(follow, ("f1", "f2", "f3"), self.start_followers):
            f[1:], f[:1] = stats[name][:-1], 0
            f[begin] = own
        g = sum(f * x for f, x in zip(follow, self.discounts))
        some = (before >= 0) & (total > 0)
        c = np.zeros(len(number), np.int64)
        both = some & known
        c[both] = self.pair_counts(before[both].astype(np.uint64) << np.uint64(32) | number[both].astype(np.uint64))
        p = np.where(some, (np.maximum(c - d[np.minimum(c, 3)], 0) + g * q) / np.where(some, total, 1), q)
        logs = np.log10(p)
        add = lambda x: np.add.reduceat(x, begins) if len(begins) else np.zeros(0, x.dtype)
        return {"n_tokens": n, "n_known": add(known.astype(np.int64)), "base": add(base), "score": add(logs)}


def modified_discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts from how many n-grams have count 1, 2, 3 and 4; halves where there are too few to tell."""
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(float(min(max(x, 0.1), k)) for k, x in zip((0.99, 1.9, 2.9), d))


# --- training ---------------------------------------------------------------------------------------
def _with_end(texts: list[bytes]) -> np.ndarray:
    hashes, _ = word_hashes(texts)
    return np.concatenate([hashes, np.full(len(texts), _END, np.uint64)])


def trained(texts: DataFrame, folder: str | None = None, bits: int | None = None) -> Model:
    """A model of all rows of ``texts`` (text STRING, null as empty). ``folder``: where the arrays go, by default below the shared folder."""
    spark: SparkSession = texts.sparkSession
    folder = local_folder(folder or scratch(spark, "kneser-ney"))
    bits = shard_bits(spark) if bits is None else bits
    shift = np.uint64(64 - bits)

    def merge_words(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        keys, counts = united(group)
        save(folder, f"words-{shard}", keys)
        save(folder, f"counts-{shard}", counts)
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64()), "tokens": pa.array([int(counts.sum())], pa.int64())})

    found = counted(texts.select("text"), lambda b: _with_end(as_bytes(b.column(0), lower=True)), lambda keys: (keys >> shift).astype(np.int32))
    words, tokens = [0] * (1 << bits), 0
    for r in stored(found.groupBy("shard").applyInArrow(merge_words, "shard int, n long, tokens long"), "kneser-ney-words").collect():  # a row per shard
        words[r.shard], tokens = r.n, tokens + r.tokens
    model = Model(folder, bits, words, tokens=tokens)
    if model.vocabulary >= (1 << 32) - 1:
        raise ValueError("the vocabulary has more than 2**32 words")
    start = np.int64(model.vocabulary)

    def pairs_of(texts: list[bytes]) -> np.ndarray:
        own = model.open()
        hashes, first = word_hashes(texts)
        last = np.cumsum(np.diff(first) + 1) - 1
        tokens = np.full(len(hashes) + len(texts), _END, np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[last] = False
        tokens[inner] = hashes
        number = own.numbers(tokens)
        before = np.empty(len(number), np.int64)
        before[1:] = number[:-1]
        before[np.concatenate([[0], last[:-1] + 1])[:len(texts)]] = start
        return before.astype(np.uint64) << np.uint64(32) | number.astype(np.uint64)

    firsts = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)
    stat_schema = pa.schema([("block", pa.int32()), ("number", pa.binary()), ("a", pa.binary()), ("f1", pa.binary()), ("f2", pa.binary()), ("f3", pa.binary())])

    def merge_pairs(group: pa.Table) -> pa.Table:
        """Writes the shard's pairs; returns, by block of word numbers, what they say about words, and in block -1 the counts of counts."""
        shard = group.column("shard")[0].as_py()
        keys, counts = united(group)
        save(folder, f"pairs-{shard}", keys)
        save(folder, f"pair-counts-{shard}", np.minimum(counts, 255).astype(np.uint8))
        many = np.flatnonzero(counts >= 255)
        save(folder, f"pair-over-{shard}", np.stack([many, counts[many]]).astype(np.int64))
        v, w = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        number, back = np.unique(np.concatenate([v, w]), return_inverse=True)
        count = lambda at: np.bincount(at, minlength=len(number)).astype(np.uint32)
        a = count(back[len(v):])
        f1, f2, f3 = (count(back[:len(v)][pick]) for pick in (counts == 1, counts == 2, counts > 2))
        block = np.searchsorted(firsts, number, "right") - 1
        edge = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        rows = [(int(block[x]), *(z[x:y].tobytes() for z in (number, a, f1, f2, f3))) for x, y in zip(edge[:-1], edge[1:])]
        rows.append((-1, np.array([shard, len(keys)], np.int64).tobytes(), np.array([(counts == k).sum() for k in (1, 2, 3, 4)], np.int64).tobytes(), b"", b"", b""))
        return pa.table({f.name: pa.array(c, f.type) for f, c in zip(stat_schema, zip(*rows))}, schema=stat_schema)

    def merge_stats(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        rows = group.to_pylist()
        if block < 0:
            return _summary(block, b"".join(r["number"] for r in rows), b"".join(r["a"] for r in rows))
        size = (words + [1])[block]  # behind the last word stands the start mark
        stats = np.zeros(size, _STATS)
        for r in rows:
            at = np.frombuffer(r["number"], np.int64) - firsts[block]
            for name in ("a", "f1", "f2", "f3"):
                stats[name][at] += np.frombuffer(r[name], np.uint32)
        if block < len(words):
            stats["c"] = np.fromfile(f"{folder}/counts-{block}", np.int64)
            save(folder, f"stats-{block}", stats)
            return _summary(block, np.array([(stats["a"] == k).sum() for k in (1, 2, 3, 4)], np.int64).tobytes(), np.array([stats["a"].sum(dtype=np.int64)], np.int64).tobytes())
        return _summary(block, np.array([stats["f1"][0], stats["f2"][0], stats["f3"][0]], np.int64).tobytes(), b"")

    found = counted(texts.select("text"), lambda b: pairs_of(as_bytes(b.column(0), lower=True)), lambda keys: (mix(keys) >> shift).astype(np.int32))
    merged = found.groupBy("shard").applyInArrow(merge_pairs, "block int, number binary, a binary, f1 binary, f2 binary, f3 binary")
    ends = stored(merged.groupBy("block").applyInArrow(merge_stats, "block int, x binary, y binary"), "kneser-ney-stats").collect()  # a row per block
    model.pairs = [0] * (1 << bits)
    of_pairs, of_words = np.zeros(4, np.int64), np.zeros(4, np.int64)
    for r in ends:
        x, y = np.frombuffer(r.x, np.int64), np.frombuffer(r.y, np.int64)
        if r.block < 0:
            for shard, n in x.reshape(-1, 2).tolist():
                model.pairs[shard] = n
            of_pairs = y.reshape(-1, 4).sum(0)
        elif r.block < len(words):
            of_words, model.predecessors = of_words + x, model.predecessors + int(y[0])
        else:
            model.start_followers = tuple(x.tolist())
    model.discounts, model.lower = modified_discounts(*of_pairs.tolist()), modified_discounts(*of_words.tolist())
    model.starts = texts.count()
    more = model.vocabulary - int(of_words[:2].sum())
    taken = model.lower[0] * of_words[0] + model.lower[1] * of_words[1] + model.lower[2] * more
    model.lower_left = taken / model.predecessors if model.predecessors else 1.0
    return model


def _summary(block: int, x: bytes, y: bytes) -> pa.Table:
    return pa.table({"block": pa.array([block], pa.int32()), "x": pa.array([x], pa.binary()), "y": pa.array([y], pa.binary())})


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs`` (doc_id LONG, text STRING); log10 of probabilities.

    A null or empty text is its end token. With an empty training table every probability is that of an unknown word. doc_id may be
    null or repeat; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Batches) -> Batches:
        own = model.open()
        for b in portions(batches):
            s = own.score(as_bytes(b.column("text"), lower=True))
            yield batch(schema, doc_id=b.column("doc_id"), n_tokens=s["n_tokens"], n_known=s["n_known"], train_tokens=np.full(b.num_rows, own.tokens), base_score=s["base"], score=s["score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
