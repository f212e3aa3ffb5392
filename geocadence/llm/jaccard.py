"""Similarity join of documents on word shingles: size-aware, heavy and light sets apart.

Two sets link when ``100 * intersection >= percent * union``. Steps, all on classes of equal sets (a copy never meets its
copies; the class id is the smallest doc_id that has the set):

1. One pass over the texts gives set size, a 128-bit signature of the set, and the smallest shingle hashes of the set, a
   quarter more than its prefix (see below) is long. Shingles that occur in more than ``common`` such windows set bits of
   a bitmap. Sets that have too few others in their window to fill the prefix (large groups of near copies, texts made of
   common passages) are then counted whole, and their common shingles set bits too. The order of all shingles is: bit not set before bit set, then by hash. Any order gives exact results; this
   one keeps lines and passages that many documents share out of the prefixes.
2. Linked sets share at least k shingles among the first ``n - need(n) + k`` of each. A *light* set (n at most ``boundary``)
   enumerates the 2-subsets of its prefix for k = 2, a *heavy* one lists the shingles of its prefix for k = 1 in inverted
   lists; light sets near the boundary do both. The boundary minimises the rows emitted plus the list entries scanned,
   computed from the histogram of set sizes and the measured list lengths. Keys are first counted in sorted blocks; only entries of
   keys that more than one set may have become rows.
3. Of every list its smallest class is compared with each other member whose size and position allow a link: a
   star, not all pairs. Verified links give components. Members of one list that are still in different components are
   then compared pair by pair, so no link between components is lost; the inside of a component needs no more links.
4. A pair first meets in sketches, the counts of a set in 128 parts of the hash range: the sum of the smaller counts is an upper bound
   of the intersection. What passes is verified on whole shingle sets, which are recomputed for the documents concerned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geocadence.llm.counts import counted, united
from geocadence.llm.tables import Batches, batch, bitmap, components, in_bitmap, shard_bits
from geocadence.llm.words import as_bytes, mix, portions, shingle_sets
from geocadence.session import discard, stored

PERCENT, WIDTH, COMMON, SCAN_COST, PARTS, BITS = 90, 3, 30, 0.2, 128, 26
FLUSH = 1_000_000  # keys a task adds up at a time
SMALL = 100  # sets up to this size are described by all their shingles
_META = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig_a", pa.int64()), ("sig_b", pa.int64()), ("low", pa.binary()), ("sketch", pa.binary())])
_META_DDL = "doc_id long, n long, sig_a long, sig_b long, low binary, sketch binary"
_ENTRY = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("single", pa.int32()), ("keys", pa.binary())])
_ENTRY_DDL = "doc_id long, n int, single int, keys binary"
_LIST = pa.schema([("class", pa.int64()), ("n", pa.int32()), ("key", pa.int64()), ("at", pa.int32())])
_LIST_DDL = "class long, n int, key long, at int"


def need(n, percent: int = PERCENT):
    """Smallest intersection a set of n can link with: 100 i >= percent * n."""
    return (n * percent + 99) // 100


def prefix_length(n, k: int, percent: int = PERCENT):
    return np.minimum(n, n - need(n, percent) + k)


def least_linking(percent: int = PERCENT) -> int:
    """Smallest set that can link with a set other than itself: n / (n + 1) reaches the threshold."""
    return -(-percent // (100 - percent))


def signature(s: np.ndarray) -> tuple[int, int]:
    a = s.sum(dtype=np.uint64) + np.uint64(len(s))
    b = (mix(s ^ np.uint64(0x5851F42D4C957F2D))).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def sketch(s: np.ndarray) -> bytes:
    """How many shingles fall in each part of the hash range, as 16-bit counts; a full one stands for any number."""
    edges = np.searchsorted(s, np.arange(1, PARTS, dtype=np.uint64) << np.uint64(64 - (PARTS - 1).bit_length()))
    return np.minimum(np.diff(edges, prepend=0, append=len(s)), 0xFFFF).astype("<u2").tobytes()


def _describe(percent: int, width: int):
    def run(batches: Batches) -> Batches:
        for b in portions(batches):
            n, sig_a, sig_b, lows, sketches = [], [], [], [], []
            for s in shingle_sets(as_bytes(b.column("text"), lower=True), width):
                x, y = signature(s)
                n.append(len(s)), sig_a.append(x), sig_b.append(y), sketches.append(sketch(s))
                lows.append(s[:_window(len(s), percent)].tobytes() if len(s) >= least_linking(percent) else b"")
            yield batch(_META, doc_id=b.column("doc_id"), n=n, sig_a=sig_a, sig_b=sig_b, low=lows, sketch=sketches)
    return run


def _window(n: int, percent: int) -> int:
    p = int(prefix_length(n, 1, percent))
    return n if n <= SMALL else p + p // 4 + 8


def _crowded(percent: int, width: int, common: np.ndarray):
    """Whole sets, once in a task, whose window has too few shingles that are not common to fill the prefix."""
    seen: set[tuple[int, int]] = set()  # every task has its own

    def keys_of(b: pa.RecordBatch) -> np.ndarray:
        rows = [np.zeros(0, np.uint64)]
        for s in shingle_sets(as_bytes(b.column(0), lower=True), width):
            n = len(s)
            if n > SMALL and (~in_bitmap(common, s[:_window(n, percent)].view(np.int64))).sum() < prefix_length(n, 1, percent):
                sig = signature(s)
                if sig not in seen:
                    seen.add(sig)
                    rows.append(s)
        return np.concatenate(rows)
    return keys_of


def _keys_of(b: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(x or b"" for x in b.column(0).to_pylist()), np.uint64)


def _entries(percent: int, width: int, boundary: int, common: np.ndarray):
    """Keys of every set in order: the ``single`` shingles of its prefix if it is heavy, the 2-subsets if it is light, both near the boundary."""
    def run(batches: Batches) -> Batches:
        for b in portions(batches):
            rows = []
            for doc, s in zip(b.column("doc_id").to_pylist(), shingle_sets(as_bytes(b.column("text"), lower=True), width)):
                n, single, keys = len(s), 0, b""
                if n < least_linking(percent) or doc is None:
                    continue
                late = in_bitmap(common, s.view(np.int64))
                s = np.concatenate([s[~late], s[late]])
                if n > boundary or 100 * n >= percent * boundary:
                    single = int(prefix_length(n, 1, percent))
                    keys = s[:single].tobytes()
                if n <= boundary:
                    i, j = np.triu_indices(int(prefix_length(n, 2, percent)), 1)
                    keys += mix(s[i] * np.uint64(3) + mix(s[j])).tobytes()
                rows.append((doc, n, single, keys))
            yield batch(_ENTRY, **dict(zip(_ENTRY.names, zip(*rows) if rows else [[]] * 4)))
    return run


def _listed(percent: int, several: np.ndarray):
    """Entries whose key several sets may have, a row each."""
    def run(batches: Batches) -> Batches:
        for b in portions(batches, "keys"):
            out = [[np.zeros(0, np.int64)] for _ in _LIST]
            for doc, n, single, keys in zip(*(c.to_pylist() for c in b.columns)):
                keys = np.frombuffer(keys, np.int64)
                at = np.arange(len(keys))
                if len(keys) > single:
                    at[single:] = np.triu_indices(int(prefix_length(n, 2, percent)), 1)[0]
                keep = in_bitmap(several, keys)
                for o, x in zip(out, (np.full(keep.sum(), doc), np.full(keep.sum(), n), keys[keep], at[keep])):
                    o.append(x)
            yield batch(_LIST, **{f.name: np.concatenate(o).astype(f.type.to_pandas_dtype()) for f, o in zip(_LIST, out)})
    return run


def counted_keys(rows: DataFrame, more_than: int, label: str, keys_of=_keys_of) -> tuple[np.ndarray, int, int]:
    """Of the keys that ``keys_of`` takes from the rows: (bitmap of those that occur more than so often, and over the other keys that occur more than once the sum of counts and of their squares)."""
    bits = shard_bits(rows.sparkSession)
    schema = pa.schema([("keys", pa.binary()), ("n", pa.int64()), ("nn", pa.int64())])

    def merge(group: pa.Table) -> pa.Table:
        keys, counts = united(group)
        some = counts[(counts > 1) & (counts <= more_than)]
        return pa.table({"keys": pa.array([keys[counts > more_than].tobytes()], pa.binary()), "n": [int(some.sum())], "nn": [int((some**2).sum())]}, schema=schema)

    blocks = counted(rows, keys_of, lambda keys: (mix(keys) >> np.uint64(64 - bits)).astype(np.int32), FLUSH)
    found = stored(blocks.groupBy("shard").applyInArrow(merge, "keys binary, n long, nn long"), label)
    sums = found.agg(F.sum("n").alias("n"), F.sum("nn").alias("nn")).first()
    bits = bitmap(found.select("keys"), BITS, lambda b: _keys_of(b).view(np.int64))
    discard(found)
    return bits, sums.n or 0, sums.nn or 0


def _sets(width: int, wanted: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Batches) -> Batches:
        for b in portions(batches):
            b = b.filter(pa.array(in_bitmap(wanted, b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))))
            if b.num_rows:
                sets = [s.view(np.int64) for s in shingle_sets(as_bytes(b.column("text"), lower=True), width)]
                yield batch(schema, doc_id=b.column("doc_id"), shingles=sets)
    return run


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _promising(percent: int):
    """Pairs whose sketches allow a link."""
    def run(batches: Batches) -> Batches:
        for t in batches:
            x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), "<u2").reshape(t.num_rows, -1) for c in ("sketch_a", "sketch_b"))
            most, full = np.minimum(x, y).sum(axis=1, dtype=np.int64), ((x == 0xFFFF) & (y == 0xFFFF)).any(axis=1)
            n = t.column("n_a").to_numpy() + t.column("n_b").to_numpy()
            keep = pa.array(full | ((100 + percent) * most >= percent * n))
            yield pa.RecordBatch.from_arrays([t.column("a").filter(keep), t.column("b").filter(keep)], schema=_PAIR)
    return run


def boundary_by_cost(sizes: DataFrame, lists: float, percent: int = PERCENT, scan_cost: float = SCAN_COST) -> int:
    """Largest size that enumerates subsets. ``sizes``: (n, classes) histogram; ``lists``: mean length of the lists that a prefix shingle is in.

    A set costs C(p2, 2) rows when light, p1 rows and the scanned entries of its lists when heavy. Sizes are gathered in
    steps of a twelfth, so the driver sees a few hundred rows at most.
    """
    step = F.floor(F.log2(F.col("n")) * 12)
    found = sizes.where(F.col("n") >= least_linking(percent)).groupBy(step.alias("step")).agg(F.max("n").alias("n"), F.sum("classes").alias("c")).orderBy("step").collect()
    if not found:
        return 0
    n, c = np.array([r.n for r in found]), np.array([r.c for r in found], float)
    p1, p2 = prefix_length(n, 1, percent).astype(float), prefix_length(n, 2, percent).astype(float)
    light, heavy = c * p2 * (p2 - 1) / 2, c * p1 * (1 + scan_cost * lists)
    totals = np.concatenate([[0], np.cumsum(light)]) + heavy.sum() - np.concatenate([[0], np.cumsum(heavy)])
    best = int(np.argmin(totals))
    return int(n[best - 1]) if best else 0


def could_link(n: Column, i: Column, m: Column, j: Column, percent: int = PERCENT) -> Column:
    """Whether sets of n and m shingles can link if the first shingle they share stands at i and j (from 0).

    A linked pair passes in the list of its first common shingle (or first two); its other lists need not find it.
    """
    n, m = n.cast("long"), m.cast("long")
    most = 1 + F.least(n - i - 1, m - j - 1)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))


def verified(pairs: DataFrame, meta: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) that link, stored: by their sketches, then by their whole sets."""
    own = meta.where("doc_id IS NOT NULL").select("doc_id", "n", "sketch")
    near = pairs.join(own.toDF("a", "n_a", "sketch_a"), "a").join(own.toDF("b", "n_b", "sketch_b"), "b")
    near = stored(near.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(_promising(percent), "a long, b long").distinct(), "jaccard-near")
    wanted = bitmap(near.select(F.explode(F.array("a", "b")).alias("id")))
    sets = stored(texts.mapInArrow(_sets(width, wanted), "doc_id long, shingles array<long>"), "jaccard-sets")
    both = near.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    both = both.withColumn("_shared", F.size(F.array_intersect("set_a", "set_b")))
    links = both.where(100 * F.col("_shared") >= percent * (F.size("set_a") + F.size("set_b") - F.col("_shared"))).select("a", "b").distinct()
    links = stored(links, "jaccard-links")
    discard(near, sets)
    return links


def with_rows(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` with _row: the doc_id, or a hash of it and the text where rows of that doc_id differ in their texts (``repeated``: _id)."""
    rows = docs.join(repeated.withColumn("_several", F.lit(True)), F.col("doc_id") == F.col("_id"), "left")
    return rows.withColumn("_row", F.when(F.col("_several"), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id").cast("long"))).drop("_id", "_several")


def repeated_ids(docs: DataFrame) -> DataFrame:
    """_id: doc_ids of rows that differ in their texts."""
    h = F.xxhash64("text")
    ids = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min(h).alias("a"), F.max(h).alias("b"))
    return stored(ids.where("a <> b").select("_id"), "jaccard-repeated")


def similar_classes(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, common: int = COMMON, boundary: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id LONG, text STRING).

    component_id is the smallest doc_id reachable by links. Texts without a word have an empty set: size 0, linked with
    nothing, their own component. A row with a null doc_id takes part in nothing and has a null component_id. Rows that
    repeat a doc_id with another text are documents of their own. Other columns of ``docs`` are not read. ``boundary``: instead of the
    one chosen by cost.
    """
    own = with_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), repeated_ids(docs))
    rows = _components(own.select(F.col("_row").alias("doc_id"), "text"), percent, width, common, boundary)
    return _named(own, rows).select("doc_id", "n_shingles", "component_id")


def _named(own: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` of _components with the real doc_id, component_id (the smallest of the component) and keep (whether the row stands for it).

    Where no doc_id is repeated the ids are the rows; only components that hold a hashed row are looked at again.
    """
    hashed = own.where("_row <> doc_id").select(F.col("_row").alias("id"), F.col("doc_id").alias("real")).distinct()
    rows = rows.join(hashed, F.col("doc_id") == F.col("id"), "left")
    rows = stored(rows.select(F.coalesce("real", "doc_id").alias("doc_id"), F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("component")), "jaccard-rows")
    mixed = rows.join(rows.where("row <> doc_id").select("component").distinct().toDF("component"), "component", "left_semi")
    names = mixed.groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    rows = rows.join(stored(names, "jaccard-names"), "component", "left")
    return rows.select("doc_id", "row", "n_shingles", F.coalesce("first.doc_id", "component").alias("component_id"), (F.col("row") == F.coalesce("first.row", "component")).alias("keep"))


def _components(texts: DataFrame, percent: int, width: int, common: int, boundary: int | None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of ``texts`` (doc_id LONG, text), where equal doc_ids have equal texts."""
    meta = stored(texts.mapInArrow(_describe(percent, width), _META_DDL), "jaccard-meta")
    own = meta.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(own.groupBy("n", "sig_a", "sig_b").agg(F.min("doc_id").alias("class")), "jaccard-classes")

    late, n, nn = counted_keys(meta.select("low"), common, "jaccard-windows")
    crowded, _, _ = counted_keys(texts.select("text"), common, "jaccard-crowded", _crowded(percent, width, late))
    late = late | crowded
    if boundary is None:
        boundary = boundary_by_cost(classes.groupBy("n").agg(F.count(F.lit(1)).alias("classes")), nn / n if n else 1.0, percent)

    entries = stored(texts.mapInArrow(_entries(percent, width, boundary, late), _ENTRY_DDL), "jaccard-entries")
    several, _, _ = counted_keys(entries.select("keys"), 1, "jaccard-keys")
    lists = entries.mapInArrow(_listed(percent, several), _LIST_DDL)
    lists = stored(lists.join(classes.select("class").distinct(), "class"), "jaccard-lists")
    discard(entries)

    heads = lists.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("class").alias("head"), F.min_by("n", "class").alias("head_n"), F.min_by("at", "class").alias("head_at"))
    heads = stored(heads.where("c > 1").drop("c"), "jaccard-heads")
    shared = stored(lists.join(heads, "key"), "jaccard-shared")
    discard(lists, heads)
    star = shared.where("class <> head").where(could_link(F.col("n"), F.col("at"), F.col("head_n"), F.col("head_at"), percent))
    star = stored(star.select(F.col("head").alias("a"), F.col("class").alias("b")).distinct(), "jaccard-star")
    links = verified(star, meta, texts, percent, width)

    part = stored(components(links, "jaccard-parts"), "jaccard-part")
    placed = shared.select("key", "class", "n", "at").join(part.withColumnRenamed("id", "class"), "class", "left")
    placed = stored(placed.withColumn("component", F.coalesce("component", "class")), "jaccard-placed")
    mixed = stored(placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key"), "jaccard-mixed")
    rest = stored(placed.join(mixed, "key"), "jaccard-rest")
    discard(shared, placed, mixed)
    x, y = rest.toDF(*[f"{c}_x" for c in rest.columns]), rest.toDF(*[f"{c}_y" for c in rest.columns])
    cross = x.join(y, (F.col("key_x") == F.col("key_y")) & (F.col("class_x") < F.col("class_y")) & (F.col("component_x") != F.col("component_y"))
                   & could_link(F.col("n_x"), F.col("at_x"), F.col("n_y"), F.col("at_y"), percent))
    cross = cross.select(F.col("class_x").alias("a"), F.col("class_y").alias("b")).distinct()
    cross = stored(cross.join(star, ["a", "b"], "left_anti"), "jaccard-cross")
    discard(rest)
    if not cross.isEmpty():
        links = stored(links.unionByName(verified(cross, meta, texts, percent, width)), "jaccard-links")
        part = stored(components(links, "jaccard-parts"), "jaccard-part")

    rows = meta.select("doc_id", "n", "sig_a", "sig_b").join(classes, ["n", "sig_a", "sig_b"], "left").join(part.withColumnRenamed("id", "class"), "class", "left")
    known = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), known.alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 80, width: int = 5, **settings) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of similar documents, with all their columns.

    It is the row with the group's smallest doc_id (of several texts under that id one by hash; of equal rows one). Rows without
    words or without a doc_id stay all. Texts that are not similar never stand for each other, even under one doc_id.
    """
    repeated = repeated_ids(docs)
    own = with_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), repeated)
    settings = {"common": COMMON, "boundary": None} | settings
    groups = _named(own, _components(own.select(F.col("_row").alias("doc_id"), "text"), percent, width, **settings))
    keep = groups.where("n_shingles > 0 AND keep").select(F.col("row").alias("_id")).distinct()
    rows = with_rows(docs, repeated).withColumn("_words", F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)) & F.col("doc_id").isNotNull())
    alone = rows.where("NOT _words").select(*docs.columns)
    plain = [F.to_json(c) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in docs.dtypes]
    first = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64(*plain), F.xxhash64(F.lit(1), *plain)))
    kept = rows.where("_words").join(stored(keep, "jaccard-keep"), F.col("_row") == F.col("_id")).withColumn("_at", first).where("_at = 1")
    return kept.select(*docs.columns).unionByName(alone)
