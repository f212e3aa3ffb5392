"""Hard negatives by an inverted multi-index: exact searches among integer inner products that stop on certified windows.

* A vector is cut into two halves; each half has a codebook of ``codes`` centroids, fitted by k-means on at most ``SAMPLE``
  vectors chosen by hash. Every vector lies in the cell of its two nearest centroids, the index.
* Cells, in order, are cut into parts of bounded size; a cell that is larger is dealt to several parts by hash. A part keeps for
  each of its centroids the radius of the half vectors it stands for, so ``q1.c1 + |q1| r1`` bounds the first half of every inner product and
  the sum of two half bounds a whole one.
* An anchor visits the cells of a part by falling bound, from a heap over the two sorted lists of half bounds (the multi-sequence
  algorithm), and stops when the bound certifies that no later cell can change its result: below its k-th best positive, or for negatives below
  the low end of every window whose best are not yet found. Parts are searched side by side and their lists are merged, which is exact.
* An anchor first goes to the parts of its best cell. Its k-th best there is a floor, and only parts whose bound reaches the
  floor are searched after that; for negatives the floor is the low end of the lowest window.

Anchors and vectors meet in groups of bounded size: (part, chunk of anchors). Only codebooks, radii and cell counts reach the driver.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geocadence.llm.forest import matrix
from geocadence.llm.tables import Batches
from geocadence.session import stored

SAMPLE, ROUNDS, CELL, CODES, SCALE, SEED = 20_000, 8, 256, 64, 256, 11
HELD, ASKING, STEP = 1 << 20, 1 << 18, 2048  # numbers in the vectors on either side of a group; rows compared at once
_BOUND_SLACK = 1e-6


# --- codebooks and bounds ---------------------------------------------------------------------------
@dataclass
class Codebooks:
    """Centroids of the two halves of a vector, and the parts that cells are dealt to."""

    halves: tuple[np.ndarray, np.ndarray]
    cells: np.ndarray | None = None      # cell numbers, sorted
    first: np.ndarray | None = None      # of each cell: its first part, and how many parts it is dealt to
    spread: np.ndarray | None = None
    radii: dict[int, tuple[np.ndarray, ...]] | None = None  # of each part: codes and radii of both halves

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.halves[0].shape[1]
        return x[:, :cut], x[:, cut:]

    def encoded(self, x: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Nearest centroid of each half and the distance to it."""
        codes, gaps = zip(*(_closest(h, c) for h, c in zip(self.split(x), self.halves)))
        return codes, gaps

    def cell(self, codes) -> np.ndarray:
        return codes[0] * len(self.halves[1]) + codes[1]


def _closest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = np.argmin((centres**2).sum(1) - 2 * (x @ centres.T), axis=1) if len(x) else np.zeros(0, np.int64)
    return code, np.sqrt(((x - centres[code]) ** 2).sum(1))


def fitted(x: np.ndarray, codes: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """At most ``codes`` centroids of the rows of x by k-means; at least one."""
    rng = np.random.default_rng(seed)
    centres = np.unique(x, axis=0)
    centres = centres[rng.permutation(len(centres))[:codes]]
    if not len(centres):
        return np.zeros((1, x.shape[1]))
    for _ in range(rounds):
        code, _ = _closest(x, centres)
        n = np.bincount(code, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, code, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def half_bounds(q: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Upper bound of the inner product of each q with any half vector that lies within ``radius`` of a centroid."""
    norm = np.sqrt((q**2).sum(1))
    return q @ centres.T + norm[:, None] * radius


def visited(first: np.ndarray, second: np.ndarray):
    """(bound, i, j) by falling sum of two lists of half bounds: a heap that holds the frontier only."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    a, b = a.tolist(), b.tolist()
    heap = [(-(x[0] + y[0]), 0, 0)] if x and y else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, a[i], b[j]
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


class Part:
    """The rows of a part by cell and label, with the centroids and radii its cells have."""

    def __init__(self, x: np.ndarray, vec: np.ndarray, label: np.ndarray, books: Codebooks):
        codes, gaps = books.encoded(x.astype(float))
        self.codes, codes = zip(*(np.unique(c, return_inverse=True) for c in codes))
        self.radius = [np.zeros(len(c)) for c in self.codes]
        for r, c, g in zip(self.radius, codes, gaps):
            np.maximum.at(r, c, g)
        self.centres = [h[c] for h, c in zip(books.halves, self.codes)]
        cell = codes[0] * len(self.codes[1]) + codes[1]
        order = np.lexsort((vec, label, cell))
        self.x, self.vec, self.label, cell = x[order], vec[order], label[order], cell[order]
        self.at = np.searchsorted(cell, np.arange(len(self.codes[0]) * len(self.codes[1]) + 1))
        self.books = books

    def bounds(self, q: np.ndarray) -> list[np.ndarray]:
        return [half_bounds(h, c, r) for h, c, r in zip(self.books.split(q.astype(float)), self.centres, self.radius)]

    def beside(self, q: np.ndarray) -> np.ndarray:
        """q; it and the rows become doubles if all inner products are exact in them, else as longs."""
        exact = self.x.shape[1] * max(1.0, float(np.abs(self.x).max())) * max(1.0, float(np.abs(q).max())) < 2**52
        self.x = self.x.astype(float if exact else np.int64)
        return q.astype(self.x.dtype)

    def batches(self, first: np.ndarray, second: np.ndarray, least: float, label: int | None = None):
        """(row ranges, bound of what follows) in the order of the heap, about STEP rows at a time; ends below ``least``."""
        wide, held, size = len(self.codes[1]), [], 0
        for bound, i, j in visited(first, second):
            if bound + _slack(bound) < least:
                break
            if size >= STEP:
                yield held, bound + _slack(bound)
                held, size = [], 0
            a, b = self.at[i * wide + j], self.at[i * wide + j + 1]
            if label is not None and a < b:
                a, b = a + np.searchsorted(self.label[a:b], label), a + np.searchsorted(self.label[a:b], label, "right")
            if a < b:
                held.append((a, b))
                size += b - a
        yield held, -math.inf

    def scores(self, held, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.concatenate([np.arange(a, b) for a, b in held]) if held else np.zeros(0, np.int64)
        score = self.x[at] @ q
        return at, np.rint(score).astype(np.int64) if score.dtype.kind == "f" else score


def _slack(bound: float) -> float:
    """What rounding may take from a bound."""
    return _BOUND_SLACK * (1 + abs(bound))


def first_k(vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first by falling score, then by vec."""
    if len(score) > 4 * k:
        some = np.flatnonzero(score >= np.partition(score, -k)[-k])
        return some[np.lexsort((vec[some], -score[some]))[:k]]
    return np.lexsort((vec, -score))[:k]


def positives_of(part: Part, q: np.ndarray, anchor: np.ndarray, label: np.ndarray, floor: np.ndarray, k: int):
    """(anchor, vec, score) of the k best of the anchor's label in a part; none below ``floor`` is looked for."""
    first, second = part.bounds(q)
    qs = part.beside(q)
    for i in range(len(anchor)):
        vec, score, least = np.zeros(0, np.int64), np.zeros(0, np.int64), float(floor[i])
        for held, bound in part.batches(first[i], second[i], least, label[i]):
            at, new = part.scores(held, qs[i])
            other = part.vec[at] != anchor[i]
            vec, score = np.append(vec, part.vec[at][other]), np.append(score, new[other])
            best = first_k(vec, score, k)
            vec, score = vec[best], score[best]
            if len(vec) == k and score[-1] > bound:
                break
        yield from ((int(anchor[i]), int(v), int(s)) for v, s in zip(vec, score))


def negatives_of(part: Part, q: np.ndarray, anchor: np.ndarray, label: np.ndarray, windows: list, k: int):
    """(anchor, positive, vec, score) of the k best of other labels in each of the anchor's windows (positive, score, low, high)."""
    first, second = part.bounds(q)
    qs = part.beside(q)
    for i in range(len(anchor)):
        open_ = [[*w, np.zeros(0, np.int64), np.zeros(0, np.int64)] for w in windows[i]]
        lowest = min(w[2] for w in open_)
        for held, bound in part.batches(first[i], second[i], lowest):
            at, score = part.scores(held, qs[i])
            keep = (score >= lowest) & (part.label[at] != label[i])
            at, score = at[keep], score[keep]
            for w in open_:
                mine = (score >= w[2]) & (score <= w[3])
                vec, own = np.append(w[4], part.vec[at[mine]]), np.append(w[5], score[mine])
                best = first_k(vec, own, k)
                w[4], w[5] = vec[best], own[best]
            if all(bound < w[2] or len(w[5]) == k and w[5][-1] > bound for w in open_):
                break
        for positive, p_score, _, _, vec, own in open_:
            yield from ((int(anchor[i]), int(positive), int(p_score), int(v), int(s)) for v, s in zip(vec, own))


# --- on tables --------------------------------------------------------------------------------------
def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): the rows that take part, one per vec_id, components as ``floor(scale * x)``.

    Rows with a null vec_id, label or vector, a null or non-finite component, or a length other than the most frequent take no
    part, nor do those with a component so large that a hundred times an inner product might not fit a LONG. Of rows that repeat a vec_id the
    first by label and components stays.
    """
    v = F.transform("embedding", lambda x: F.floor(scale * x.cast("double")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < 2.0**31))
    rows = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    widths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").first()
    width = widths.n if widths else 0
    most = min(2**31 - 1, math.isqrt(2**55 // max(width, 1)))
    rows = rows.where((F.size("v") == width) & F.forall("v", lambda x: F.abs(x) <= most))
    rows = rows.select("vec_id", "label", F.col("v").cast("array<int>").alias("v"))
    one = Window.partitionBy("vec_id").orderBy("label", "v")
    return rows.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")


_HIT = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
_HIT_DDL = "anchor_id long, positive_id long, positive_score long"
_FOUND = _HIT.append(pa.field("negative_id", pa.int64())).append(pa.field("negative_score", pa.int64()))
_FOUND_DDL = _HIT_DDL + ", negative_id long, negative_score long"


def _table(rows, schema: pa.Schema) -> pa.Table:
    rows = list(rows)
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def indexed(rows: DataFrame, sample: int = SAMPLE, cell: int = CELL, codes: int = CODES, most_held: int = HELD) -> tuple[DataFrame, Codebooks]:
    """(rows with part, codebooks) of ``rows`` (vec_id, label, v), stored: every row is in one cell of one part."""
    total = rows.count()
    place = F.pmod(F.xxhash64("vec_id", F.lit("books")), F.lit(1 << 20)) / (1 << 20)
    own = matrix(rows.where(place < min(1.0, sample / max(total, 1))).orderBy("vec_id").select("v").toArrow().column("v")).astype(float)  # about ``sample`` rows
    width = own.shape[1] if len(own) else rows.select(F.size("v").alias("n")).first().n if total else 2
    own = own.reshape(-1, width)
    k = max(1, min(codes, round(math.sqrt(total / cell))))
    books = Codebooks((fitted(own[:, :width // 2], k), fitted(own[:, width // 2:], k)))

    def count(batches: Batches) -> Batches:
        for b in batches:
            found, _ = books.encoded(matrix(b.column("v")).astype(float).reshape(-1, width))
            cells, n = np.unique(books.cell(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(n, pa.int64())], ["cell", "n"])

    counts = sorted(map(tuple, rows.select("v").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()))  # at most codes**2 rows
    most, part, room = max(1, most_held // width), -1, 0
    first, spread = [], []
    for _, n in counts:
        if n > room:
            part, room = part + 1, most
        first.append(part), spread.append(-(-n // most))
        part, room = part + spread[-1] - 1, room - n if spread[-1] == 1 else 0
    books.cells, books.first, books.spread = np.array([c for c, _ in counts], np.int64), np.array(first, np.int64), np.array(spread, np.int64)

    def deal(batches: Batches) -> Batches:
        for b in batches:
            found, gaps = books.encoded(matrix(b.column("v")).astype(float).reshape(-1, width))
            at = np.searchsorted(books.cells, books.cell(found))
            vec = b.column("vec_id").to_numpy()
            own = books.first[at] + (vec * 0x9E3779B1 >> 7) % books.spread[at]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *(pa.array(c, pa.int32()) for c in found), *map(pa.array, gaps), *(b.column(c) for c in ("vec_id", "label", "v"))],
                                             ["part", "code_1", "code_2", "gap_1", "gap_2", "vec_id", "label", "v"])

    dealt = stored(rows.select("vec_id", "label", "v").mapInArrow(deal, "part int, code_1 int, code_2 int, gap_1 double, gap_2 double, vec_id long, label long, v array<int>"), "index-rows")
    radius = dealt.select("part", F.explode(F.array(*[F.struct(F.lit(h).alias("half"), F.col(f"code_{h + 1}").alias("code"), F.col(f"gap_{h + 1}").alias("gap")) for h in (0, 1)])).alias("x"))
    found: dict[int, list] = {}
    for r in radius.groupBy("part", "x.half", "x.code").agg(F.max("x.gap").alias("gap")).collect():  # a few numbers per part
        found.setdefault(r.part, [[], [], [], []])
        found[r.part][r.half].append(r.code), found[r.part][2 + r.half].append(r.gap)
    books.radii = {p: (np.array(a), np.array(b), np.array(x), np.array(y)) for p, (a, b, x, y) in sorted(found.items())}
    return dealt.select("part", "vec_id", "label", "v"), books


def part_bounds(books: Codebooks, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(part numbers, bound of every q in every part)."""
    first, second = books.split(q.astype(float))
    out = np.empty((len(q), len(books.radii)))
    for k, (a, b, x, y) in enumerate(books.radii.values()):
        out[:, k] = half_bounds(first, books.halves[0][a], x).max(1) + half_bounds(second, books.halves[1][b], y).max(1)
    return np.array(list(books.radii), np.int64), out


def dispatched(anchors: DataFrame, books: Codebooks, home: bool | None) -> DataFrame:
    """A row of ``anchors`` (vec_id, v, floor, ...) for every part it must search.

    ``home`` True: the parts of its best cell; False: all others whose bound reaches ``floor``; None: all whose bound reaches it.
    """
    ddl = ", ".join(f"`{c}` {t}" for c, t in anchors.dtypes)

    def run(batches: Batches) -> Batches:
        for b in batches:
            q = matrix(b.column("v"))
            if not len(q):
                continue
            parts, bound = part_bounds(books, q)
            best = np.searchsorted(parts, _home(books, q))
            at_home = np.zeros(bound.shape, bool)
            at_home[np.arange(len(q)), best] = True
            if home:
                who, where = np.nonzero(at_home)
            else:
                floor = b.column("floor").to_numpy(zero_copy_only=False)
                wanted = bound + _BOUND_SLACK * (1 + np.abs(bound)) >= floor[:, None]
                who, where = np.nonzero(wanted & ~at_home if home is False else wanted)
            for i in range(0, len(who), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(parts[where[i:i + 4096]], pa.int32()), *(c.take(pa.array(who[i:i + 4096])) for c in b.columns)], ["part", *b.schema.names])
    return anchors.mapInArrow(run, "part int, " + ddl)


def _home(books: Codebooks, q: np.ndarray) -> np.ndarray:
    """The first part of the cell whose centroids have the largest inner product with q, among cells that have rows."""
    wide = len(books.halves[1])
    a, b = (h @ c.T for h, c in zip(books.split(q.astype(float)), books.halves))
    return books.first[np.argmax(a[:, books.cells // wide] + b[:, books.cells % wide], axis=1)]


def met(dealt: DataFrame, asking: DataFrame, chunks: int, search, ddl: str) -> DataFrame:
    """``search(rows, anchors)`` for every part and chunk of the anchors that ask it, both sides bounded."""
    asking = stored(asking.withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit("chunk")), F.lit(chunks)).cast("int")), "index-asking")
    rows = dealt.join(asking.select("part", "chunk").distinct().toDF("part", "chunk"), "part")
    return rows.groupBy("part", "chunk").cogroup(asking.groupBy("part", "chunk")).applyInArrow(search, ddl)


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = SCALE,
                   most_held: int = HELD, most_asking: int = ASKING, **settings) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors whose ids are in the one column of ``anchors``.

    ``vectors``: vec_id LONG, label, embedding ARRAY; see ``scaled`` for the rows that take part. Scores are integer inner products of the
    scaled vectors. An anchor's positives are its first other rows of its label; for each of them its negatives are the first rows of other labels with
    ``least * positive_score <= 100 * negative_score <= most * positive_score``. Higher scores come first, ties by smaller vec_id. Fewer
    rows than asked for: all. Anchors that ``vectors`` lacks, repeated anchors and empty tables add nothing. Other columns are not read.
    """
    rows = stored(scaled(vectors, scale), "index-vectors")
    own = rows.join(anchors.toDF("vec_id").distinct(), "vec_id")
    own = stored(own, "index-anchors")
    asked = own.count()
    dealt, books = indexed(rows, most_held=most_held, **settings)
    width = books.halves[0].shape[1] + books.halves[1].shape[1]
    chunks = max(1, -(-asked * width // most_asking))

    def sides(held: pa.Table, asking: pa.Table):
        return Part(matrix(held.column("v")), held.column("vec_id").to_numpy(), held.column("label").to_numpy(), books), matrix(asking.column("v")), asking.column("vec_id").to_numpy(), asking.column("label").to_numpy()

    def search_positives(held: pa.Table, asking: pa.Table) -> pa.Table:
        if not held.num_rows or not asking.num_rows:
            return _HIT.empty_table()
        return _table(positives_of(*sides(held, asking), asking.column("floor").to_numpy(), positives), _HIT)

    def search_negatives(held: pa.Table, asking: pa.Table) -> pa.Table:
        if not held.num_rows or not asking.num_rows:
            return _FOUND.empty_table()
        windows = [[tuple(w.values()) for w in ws] for ws in asking.column("windows").to_pylist()]
        return _table(negatives_of(*sides(held, asking), windows, negatives), _FOUND)

    nothing = F.lit(float("-inf"))
    ranked = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))

    def best(hits):
        return hits.withColumn("_r", ranked).where(F.col("_r") <= positives)

    home = stored(met(dealt, dispatched(own.withColumn("floor", nothing), books, True), chunks, search_positives, _HIT_DDL), "index-home")
    floors = home.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("_n"), F.min("positive_score").cast("double").alias("_low"))
    floored = own.join(floors.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left")
    floored = floored.select("vec_id", "label", "v", F.when(F.col("_n") >= positives, F.col("_low")).otherwise(nothing).alias("floor"))
    away = met(dealt, dispatched(floored, books, False), chunks, search_positives, _HIT_DDL)
    found = stored(best(home.unionByName(away)).drop("_r"), "index-positives")

    score = F.col("positive_score")
    low, high = (F.expr(f"-((-{least} * positive_score - pmod(-{least} * positive_score, 100)) div 100)"), F.expr(f"({most} * positive_score - pmod({most} * positive_score, 100)) div 100"))
    windows = found.withColumn("low", low).withColumn("high", high).where("low <= high")
    windows = windows.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("positive"), score.alias("score"), "low", "high")).alias("windows"), F.min("low").cast("double").alias("floor"))  # at most ``positives``
    asking = own.join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select("vec_id", "label", "v", "floor", "windows")
    hits = met(dealt, dispatched(asking, books, None), chunks, search_negatives, _FOUND_DDL)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    rows = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
