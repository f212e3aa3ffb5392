"""Exact duplicate removal with a sharded cuckoo-filter index of live digests.

The index lives in shards by digest. A shard holds the stored keys, 32-byte SHA-256 digests of the normalised texts in
buckets of the filter, and a cuckoo filter with 16-bit fingerprints, four to a bucket. A digest the filter has not seen is
new; a hit is verified against the stored keys of its two buckets, so false positives cost a comparison and
nothing else. When an insertion finds no place the filter is rebuilt with twice the buckets from the stored keys.
A digest is live while one of its rows is; deleting its last row removes its fingerprint.

Rows reach a shard combined: a task sums the rows of an equal text in its Arrow batches first, so a text that a third of
all rows share is a row per batch. Shards are as many as the shuffle partitions.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geocadence.llm.tables import Batches, batch, shards_of
from geocadence.llm.words import SPACES, as_bytes, portions
from geocadence.session import stored

SLOTS, KICKS, START = 4, 200, 64
_RUN = re.compile(rb"[\x20\x09-\x0d]+")


def normalise(text: bytes) -> bytes:
    """Every run of white space becomes one space; runs at the ends stay, as one space."""
    if not text or len(text) > 1 << 22:
        return _RUN.sub(b" ", text)
    body = b" ".join(text.split())
    head = b" " if text[0] in SPACES else b""
    return head + body + (b" " if body and text[-1] in SPACES else b"")


class CuckooFilter:
    """Fingerprints of 64-bit keys with insertion, deletion and lookup; the places of a key follow from the key alone."""

    def __init__(self, buckets: int = START, table: bytes | None = None):
        self.mask = buckets - 1
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else np.frombuffer(table, np.uint16).reshape(buckets, SLOTS).copy()

    @property
    def buckets(self) -> int:
        return self.mask + 1

    def places(self, key: int) -> tuple[int, int, int]:
        print_ = (key >> 48) % 0xFFFF + 1  # 0 marks a free slot
        first = key & self.mask
        return print_, first, first ^ self._jump(print_)

    def _jump(self, print_: int) -> int:
        return (print_ * 0x5BD1E995 >> 7) & self.mask

    def __contains__(self, key: int) -> bool:
        print_, i, j = self.places(key)
        return print_ in self.table[i] or print_ in self.table[j]

    def insert(self, key: int) -> bool:
        """False when no place was found; the filter then lacks one fingerprint and must be rebuilt."""
        print_, i, j = self.places(key)
        for at in (i, j):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = print_
                return True
        at = j
        for kick in range(KICKS):
            slot = (print_ + kick) % SLOTS
            print_, self.table[at, slot] = int(self.table[at, slot]), print_
            at ^= self._jump(print_)
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = print_
                return True
        return False

    def delete(self, key: int) -> bool:
        print_, i, j = self.places(key)
        for at in (i, j):
            held = np.flatnonzero(self.table[at] == print_)
            if len(held):
                self.table[at, held[0]] = 0
                return True
        return False


class Shard:
    """One shard: the filter, and per bucket the live digests with what is kept of them (smallest id, rows)."""

    def __init__(self):
        self.filter = CuckooFilter()
        self.stored: dict[int, dict[bytes, list]] = {}
        self.live = 0

    @staticmethod
    def key(digest: bytes) -> int:
        return int.from_bytes(digest[8:16], "little")  # the shard uses other bytes

    def _bucket(self, key: int) -> dict[bytes, list]:
        return self.stored.setdefault(key & 0xFFFF, {})

    def find(self, digest: bytes) -> list | None:
        key = self.key(digest)
        return self._bucket(key).get(digest) if key in self.filter else None

    def add(self, digest: bytes, doc: int | None, rows: int) -> None:
        found = self.find(digest)
        if found is not None:
            found[0] = doc if found[0] is None else found[0] if doc is None else min(found[0], doc)
            found[1] += rows
            return
        key = self.key(digest)
        self._bucket(key)[digest] = [doc, rows]
        self.live += 1
        if not self.filter.insert(key):
            self.resize()

    def remove(self, digest: bytes, rows: int) -> bool:
        """Takes rows from a live digest; the last one takes the digest out of the filter and the stored keys."""
        found = self.find(digest)
        if found is None:
            return False
        found[1] -= rows
        if found[1] <= 0:
            key = self.key(digest)
            del self._bucket(key)[digest]
            self.filter.delete(key)
            self.live -= 1
        return True

    def resize(self) -> None:
        buckets = self.filter.buckets
        while True:
            buckets *= 2
            grown = CuckooFilter(buckets)
            if all(grown.insert(self.key(d)) for bucket in self.stored.values() for d in bucket):
                self.filter = grown
                return

    def entries(self):
        for bucket in self.stored.values():
            for digest, (doc, rows) in bucket.items():
                yield digest, doc, rows


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary())])
_CHANGES = pa.schema([("shard", pa.int32()), ("digest", pa.binary()), ("doc_id", pa.int64()), ("rows", pa.int64())])
_CHANGES_DDL = "shard int, digest binary, doc_id long, rows long"


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) per row: SHA-256 of the normalised text, null as empty."""
    def run(batches: Batches) -> Batches:
        for b in portions(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([hashlib.sha256(normalise(t)).digest() for t in as_bytes(b.column("text"))], pa.binary())], schema=_DIGESTS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, digest binary")


def combined(rows: DataFrame, shards: int, sign: int = 1) -> DataFrame:
    """Changes to the index: (shard, digest, smallest doc_id, rows), equal digests of a batch summed. Rows to delete count negative."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            held: dict[bytes, list] = {}
            for doc, digest in zip(b.column("doc_id").to_pylist(), b.column("digest").to_pylist()):
                own = held.setdefault(digest, [doc, 0])
                own[0] = doc if own[0] is None else own[0] if doc is None else min(own[0], doc)
                own[1] += sign
            yield batch(_CHANGES, shard=[int.from_bytes(d[:4], "little") % shards for d in held], digest=list(held), doc_id=[x[0] for x in held.values()], rows=[x[1] for x in held.values()])
    return rows.mapInArrow(run, _CHANGES_DDL)


def updated(changes: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The index after ``changes``: its live digests as (shard, digest, doc_id, rows), a table that can be given back as ``index``.

    Every shard is one task at a time: it loads its stored keys, then inserts (rows > 0), then deletes (rows < 0).
    Deleting what is not there changes nothing. doc_id is the smallest id ever inserted while the digest was live.
    """
    def run(batches: Batches) -> Batches:
        shard, at, late = Shard(), None, []

        def finish():
            for digest, rows in late:
                shard.remove(digest, -rows)
            found = list(shard.entries())
            for i in range(0, len(found), 10_000):
                part = found[i:i + 10_000]
                yield batch(_CHANGES, shard=[at] * len(part), digest=[x[0] for x in part], doc_id=[x[1] for x in part], rows=[x[2] for x in part])

        for b in batches:
            for number, digest, doc, rows in zip(*(c.to_pylist() for c in b.columns)):
                if number != at:
                    if at is not None:
                        yield from finish()
                    shard, at, late = Shard(), number, []
                if rows > 0:
                    shard.add(digest, doc, rows)
                else:
                    late.append((digest, rows))
        if at is not None:
            yield from finish()

    rows = changes if index is None else index.unionByName(changes)
    return rows.repartition(shards_of(rows.sparkSession), "shard").sortWithinPartitions("shard").mapInArrow(run, _CHANGES_DDL)


def duplicates(docs: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) per row of ``docs`` (doc_id LONG, text STRING).

    Equal texts are identical after normalisation; null counts as empty. keep_id is the smallest doc_id of the group (null only if
    all are), group_size counts rows, kept marks the rows with that id: rows that repeat a doc_id and text are one
    document and are marked alike. With ``index``, texts that are live in it count as earlier rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = stored(digests(docs), "cuckoo-digests")
    live = stored(updated(combined(rows, shards_of(spark)), index), "cuckoo-index")
    groups = live.select("digest", F.col("doc_id").alias("keep_id"), F.col("rows").alias("group_size"))
    return rows.join(groups, "digest").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns; of rows alike in doc_id and text one, by a hash of the rest."""
    keep = duplicates(docs).where("kept").select(_key(F.col("digest")).alias("_key")).distinct()
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    rows = docs.withColumn("_key", _key(F.unhex(F.sha2(text.cast("binary"), 256)))).join(stored(keep, "cuckoo-keep"), "_key")
    plain = [F.to_json(c) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in docs.dtypes]
    repeats = Window.partitionBy("_key").orderBy(F.xxhash64(*plain), F.xxhash64(F.lit(1), *plain))
    return rows.withColumn("_at", F.row_number().over(repeats)).where("_at = 1").select(*docs.columns)


def _key(digest: Column) -> Column:
    """A digest with the doc_id behind it: one join key that also holds for null ids."""
    return F.concat(digest, F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
