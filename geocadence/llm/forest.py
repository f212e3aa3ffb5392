"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees.

* Equal vectors are one: only the ids of the ``k + 1`` smallest rows of a vector can ever be among the k nearest of a row, so
  the others are left out exactly (a ranked window that Spark prunes before its shuffle).
* The trees are grown on a bounded sample of the vectors (``SAMPLE``): a node projects onto the difference of two of its vectors
  and splits at the median. Every vector is then routed to its leaf in every tree.
* A query has one priority queue for all trees: the leaf behind the smallest margin comes next, whichever tree it
  is in. How many leaves a query opens is measured, not guessed: for ``TRIAL`` vectors the exact neighbours among all
  rows are computed, and the count is the least that finds the wanted share of them.
* Leaves are compared in blocks of neighbouring leaves of a tree: inner products of the queries that opened a leaf with its
  vectors, in double precision; the lists of the best of each block are merged per query. All scores are exact. A block's
  vectors are dealt to parts and the queries to chunks, by hash, and each part meets each chunk in a group of its own: neither
  side of a group grows with the table, and a leaf of any size is split.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geocadence.llm.tables import Batches
from geocadence.session import stored

TREES, LEAF, SAMPLE, TRIAL, RECALL, BLOCK = 8, 128, 40_000, 128, 0.95, 128
HELD, ASKING = 1 << 21, 1 << 19  # numbers in the vectors on either side of a group: 16 MB and 4 MB


@dataclass
class Forest:
    """Nodes of all trees in arrays; a child below 0 is leaf ``-child - 1``. Leaves are numbered through, those of a tree in order."""

    normals: np.ndarray
    cuts: np.ndarray
    near: np.ndarray      # child where the projection is at most the cut
    far: np.ndarray
    roots: np.ndarray
    first_leaf: np.ndarray  # per tree, and the number of leaves
    sizes: np.ndarray | None = None  # vectors in each leaf

    def route(self, x: np.ndarray, tree: int) -> np.ndarray:
        """Leaf of every row of x in one tree."""
        at = np.full(len(x), self.roots[tree], np.int64)
        while (moving := np.flatnonzero(at >= 0)).size:
            nodes = at[moving]
            side = np.einsum("ij,ij->i", x[moving], self.normals[nodes]) <= self.cuts[nodes]
            at[moving] = np.where(side, self.near[nodes], self.far[nodes])
        return -at - 1

    def opened(self, q: np.ndarray):
        """(leaf, tree) by smallest margin over all trees, one after another."""
        queue = [(0.0, i, int(root), i) for i, root in enumerate(self.roots)]
        made = len(queue)
        while queue:
            margin, _, node, tree = heapq.heappop(queue)
            while node >= 0:
                side = float(self.normals[node] @ q) - float(self.cuts[node])
                here, there = (self.near, self.far) if side <= 0 else (self.far, self.near)
                heapq.heappush(queue, (max(margin, abs(side)), made, int(there[node]), tree))
                made, node = made + 1, int(here[node])
            yield -node - 1, tree

    def leaves(self, q: np.ndarray, count: int, rows: int) -> list[int]:
        """The first ``count`` leaves, and more until those of one tree hold ``rows`` vectors."""
        out, held = [], [0] * len(self.roots)
        for leaf, tree in self.opened(q):
            out.append(leaf)
            held[tree] += int(self.sizes[leaf])
            if len(out) >= count and max(held) >= rows:
                break
        return out


def grown(sample: np.ndarray, trees: int, leaf: int, seed: int = 8) -> Forest:
    """A forest whose leaves hold at most about ``leaf`` rows of the sample; leaves of equal rows may hold more."""
    rng = np.random.default_rng(seed)
    normals, cuts, near, far, roots, first = [], [], [], [], [], [0]
    leaves = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        for _ in range(4 if len(rows) > leaf else 0):
            a, b = sample[rng.choice(rows, 2, replace=False)]
            length = np.linalg.norm(a - b)
            if not 0 < length < np.inf:
                continue
            normal = ((a - b) / length).astype(np.float32)
            at = sample[rows] @ normal
            cut = np.float32(np.median(at))
            low = at <= cut
            if low.all():
                continue
            node = len(cuts)
            normals.append(normal), cuts.append(cut), near.append(0), far.append(0)
            near[node], far[node] = grow(rows[low]), grow(rows[~low])
            return node
        leaves += 1
        return -leaves

    for _ in range(trees):
        roots.append(grow(np.arange(len(sample))))
        first.append(leaves)
    width = sample.shape[1] if sample.ndim == 2 else 0
    return Forest(np.array(normals, np.float32).reshape(len(normals), width), np.array(cuts, np.float32), np.array(near, np.int64), np.array(far, np.int64), np.array(roots), np.array(first))


def matrix(column) -> np.ndarray:
    """Rows of equal length from an Arrow list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best different vectors of every query, ties to the smaller vec."""
    order = np.lexsort((vec, query))
    query, vec, score = query[order], vec[order], score[order]
    new = np.concatenate([[True], (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])])[:len(query)]
    query, vec, score = query[new], vec[new], score[new]
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], vec[place < k], score[place < k]


_HIT = pa.schema([("query", pa.int64()), ("vec", pa.int64()), ("score", pa.float64())])
_HIT_DDL = "query long, vec long, score double"
_LIST = pa.schema([("query", pa.int64()), ("vecs", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])
_LIST_DDL = "query long, vecs array<long>, scores array<double>"


def as_lists(query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.Table:
    """A row per query from sorted hits."""
    first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))[:len(query)]
    ends = pa.array(np.append(first, len(query)).astype(np.int32))
    return pa.table([pa.array(query[first]), pa.ListArray.from_arrays(ends, pa.array(vec)), pa.ListArray.from_arrays(ends, pa.array(score))], schema=_LIST)


def merged_lists(k: int):
    """The k best of each query from its lists; the rows of a query come one after another."""
    def run(batches: Batches) -> Batches:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for b in batches:
            n = b.column("vecs").value_lengths().to_numpy()
            new = np.repeat(b.column("query").to_numpy(), n), *(b.column(c).flatten().to_numpy() for c in ("vecs", "scores"))
            rows = [np.concatenate(x) for x in zip(held, new)]
            if not len(rows[0]):
                continue
            done = rows[0] != rows[0][-1]  # more of the last query may follow
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in best(*(x[done] for x in rows), k)], schema=_HIT)
            held = best(*(x[~done] for x in rows), k)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best(*held, k)], schema=_HIT)
    return run


def in_groups(held: DataFrame, opened: DataFrame, chunks: int) -> tuple[DataFrame, DataFrame]:
    """Both with ``part`` and ``chunk``: every vec of a block and every query of it meet in one (block, part, chunk).

    ``held``: (block, parts, vec, ...), ``opened``: (block, parts, query, ...), parts the number of parts of the block.
    """
    part, chunk = F.pmod(F.xxhash64("vec", F.lit("part")), F.col("parts")), F.pmod(F.xxhash64("query", F.lit("chunk")), F.lit(chunks))
    held = held.select("*", part.cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    opened = opened.select("*", chunk.cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return held.drop("parts"), opened.drop("parts")


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors that take part. Null ids, null or zero vectors, null or non-finite components do not, nor do lengths other than the most frequent."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    widths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("v") == (widths.n if widths else 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, recall: float = RECALL,
            most_held: int = HELD, most_asking: int = ASKING) -> DataFrame:
    """(query_id, rank, vec_id, score): for every id of ``queries`` (one column) the k nearest other rows of ``vectors`` (vec_id LONG, embedding ARRAY).

    Score is the inner product in double precision, ties go to the smaller vec_id. Fewer candidates than k: all of them. Rows
    that repeat a vec_id count once per vector. Ids that ``vectors`` lacks give no rows. Other columns are not read.
    ``most_held`` and ``most_asking``: numbers in the vectors that meet in a group, about.
    """
    rows = usable(vectors).withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64("v", F.lit(2)))
    rows = stored(rows, "forest-rows")
    same = Window.partitionBy("k1", "k2").orderBy("vec_id")
    few = rows.withColumn("n", F.dense_rank().over(same)).where(F.col("n") <= k + 1).distinct()
    few = stored(few, "forest-vectors")
    vectors = stored(few.where("n = 1").select(F.col("vec_id").alias("vec"), "v", "k1", "k2"), "forest-distinct")
    members = few.select("vec_id", "k1", "k2").join(vectors.select("vec", "k1", "k2"), ["k1", "k2"]).select("vec", "vec_id")
    asked = stored(rows.join(queries.toDF("vec_id").distinct(), "vec_id").select("vec_id", "k1", "k2").distinct().join(vectors.select("vec", "k1", "k2"), ["k1", "k2"]).select("vec_id", F.col("vec").alias("query")), "forest-queries")

    total = vectors.count()
    share = min(1.0, sample / max(total, 1))
    place = F.pmod(F.xxhash64("vec", F.lit("sample")), F.lit(1 << 20)) / (1 << 20)
    own = matrix(vectors.where(place < share).orderBy("vec").select("v").toArrow().column("v"))  # bounded by ``sample``
    forest = grown(own.astype(np.float32), trees if total else 0, max(1, int(leaf * share)))
    count = leaves_for(vectors, forest, k, recall, total)

    wide = int(forest.first_leaf[-1])
    blocks = np.arange(wide) // BLOCK

    def count_rows(batches: Batches) -> Batches:
        sizes = np.zeros(wide, np.int64)
        for b in batches:
            x = matrix(b.column("v")).astype(np.float32)
            for tree in range(len(forest.roots)):
                sizes += np.bincount(forest.route(x, tree), minlength=wide)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(sizes)), pa.array(sizes[sizes > 0])], ["leaf", "n"])

    forest.sizes = np.zeros(wide, np.int64)
    for r in vectors.select("v").mapInArrow(count_rows, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect():  # a row per leaf
        forest.sizes[r.leaf] = r.n
    width = own.shape[1] if len(own) else 1
    parts = np.maximum(1, -(-np.bincount(blocks, weights=forest.sizes).astype(np.int64) * width // most_held))
    probes = stored(vectors.join(asked.select(F.col("query").alias("vec")).distinct(), "vec").select("vec", "v"), "forest-probes")
    chunks = max(1, -(-probes.count() * width // most_asking))

    def place_rows(batches: Batches) -> Batches:
        for b in batches:
            x = matrix(b.column("v"))
            for tree in range(len(forest.roots)):
                at = forest.route(x.astype(np.float32), tree)
                yield pa.RecordBatch.from_arrays([pa.array(blocks[at], pa.int32()), pa.array(parts[blocks[at]], pa.int32()), pa.array(at, pa.int32()), b.column("vec"), b.column("v")], ["block", "parts", "leaf", "vec", "v"])

    def open_leaves(batches: Batches) -> Batches:
        for b in batches:
            x = matrix(b.column("v"))
            for i, (query, q) in enumerate(zip(b.column("vec").to_pylist(), x.astype(np.float32))):
                opened = np.sort(forest.leaves(q, count, k + 1))
                which, start = np.unique(blocks[opened], return_index=True)
                lists = [part.tolist() for part in np.split(opened, start[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(parts[which], pa.int32()), pa.array([query] * len(which), pa.int64()), pa.array(lists, pa.list_(pa.int32())), b.column("v").slice(i, 1).take(pa.array([0] * len(which)))],
                                                 ["block", "parts", "query", "leaves", "v"])

    def compare(held: pa.Table, asking: pa.Table) -> pa.Table:
        if not held.num_rows or not asking.num_rows:
            return _LIST.empty_table()
        x, q = matrix(held.column("v")), matrix(asking.column("v"))
        vec, query = held.column("vec").to_numpy(), asking.column("query").to_numpy()
        lists = asking.column("leaves").combine_chunks()
        wanted, by = lists.flatten().to_numpy(), np.repeat(np.arange(len(query)), lists.value_lengths().to_numpy())
        order = np.argsort(held.column("leaf").to_numpy(), kind="stable")
        leaf_sorted = held.column("leaf").to_numpy()[order]
        ask = np.argsort(wanted, kind="stable")
        found, size = [], 0
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for at in np.unique(wanted):
            own = order[np.searchsorted(leaf_sorted, at):np.searchsorted(leaf_sorted, at, "right")]
            who = by[ask[np.searchsorted(wanted[ask], at):np.searchsorted(wanted[ask], at, "right")]]
            step = max(1, 1_000_000 // max(len(own), 1))
            for i in range(0, len(who) if len(own) else 0, step):
                some = who[i:i + step]
                found.append((np.repeat(query[some], len(own)), np.tile(vec[own], len(some)), (q[some] @ x[own].T).ravel()))
                size += len(found[-1][0])
                if size > 2_000_000:
                    out, found, size = [best(*map(np.concatenate, zip(*out, *found)), k + 1)], [], 0
        return as_lists(*best(*map(np.concatenate, zip(*out, *found)), k + 1))

    held = vectors.select("vec", "v").mapInArrow(place_rows, "block int, parts int, leaf int, vec long, v array<double>")
    opened = probes.mapInArrow(open_leaves, "block int, parts int, query long, leaves array<int>, v array<double>")
    held, opened = in_groups(held, opened, chunks)
    group = ["block", "part", "chunk"]
    lists = held.groupBy(*group).cogroup(opened.groupBy(*group)).applyInArrow(compare, _LIST_DDL)
    # a vector is found in several trees, with the same score: it counts once
    hits = lists.repartition("query").sortWithinPartitions("query").mapInArrow(merged_lists(k + 1), _HIT_DDL)
    rows = hits.join(members, "vec").select("query", "vec_id", "score")
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    rows = stored(rows.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1).drop("r"), "forest-hits")
    pairs = asked.withColumnRenamed("vec_id", "query_id").join(rows, "query").where("query_id <> vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def leaves_for(vectors: DataFrame, forest: Forest, k: int, recall: float, total: int, trial: int = TRIAL) -> int:
    """The least number of leaves that finds ``recall`` of the exact neighbours of ``trial`` vectors among all rows."""
    if not total:
        return 0
    tried = vectors.orderBy(F.xxhash64("vec", F.lit("trial")), "vec").limit(trial).select("vec", "v").toArrow()
    ids, x = tried.column("vec").to_numpy(), matrix(tried.column("v"))
    schema = _HIT.append(pa.field("v", pa.list_(pa.float64())))

    def scan(batches: Batches) -> Batches:
        for b in batches:
            vec, v = b.column("vec").to_numpy(), matrix(b.column("v"))
            score = x @ v.T
            query, row = np.repeat(np.arange(len(ids)), len(vec)), np.tile(np.arange(len(vec)), len(ids))
            other = ids[query] != vec[row]  # vectors are distinct, so a row stands for its vector
            query, row, score = best(query[other], row[other], score.ravel()[other], k)
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec[row]), pa.array(score), b.column("v").take(pa.array(row))], schema=schema)

    near = vectors.select("vec", "v").mapInArrow(scan, _HIT_DDL + ", v array<double>")
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec"))).where(F.col("r") <= k).toArrow()
    query, v = near.column("query").to_numpy(), matrix(near.column("v")).astype(np.float32)
    if not len(query):
        return len(forest.roots)
    at = np.stack([forest.route(v, t) for t in range(len(forest.roots))], axis=1)
    needed = np.zeros(len(query))
    for i in range(len(ids)):
        mine, owners = np.flatnonzero(query == i), {}
        for row in mine.tolist():
            for leaf in at[row].tolist():
                owners.setdefault(leaf, []).append(row)
        missing = set(mine.tolist())
        for rank, (leaf, _) in enumerate(forest.opened(x[i].astype(np.float32)), 1):
            for row in missing.intersection(owners.get(leaf, ())):
                needed[row] = rank
                missing.discard(row)
            if not missing:
                break
    return int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])
