"""Packing without padding: every document is split into pieces whose lengths are powers of two.

The pieces of a document of n tokens are its full sequences of ``capacity`` tokens (a power of two) and then the binary digits of the
rest, the largest first. A piece is a sequence of its own: none crosses documents and none is padded. Sequences of equal length
form a bucket; in a bucket they are numbered by a fixed hash order of their documents, and buckets follow each other by length, so the numbers are
dense and any run of them in a bucket is a batch of equal rows. The work is one pass over the texts; only lengths and ids are shuffled, and
a bucket, however large, is numbered in salted groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geocadence.llm.byte_tokens import ByteTokenizer, default_tokenizer
from geocadence.llm.tables import Batches, numbered
from geocadence.llm.words import as_bytes, portions
from geocadence.session import stored

CAPACITY, END, BATCH = 2048, 1, 1 << 16
_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
_PIECE_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def lengths(n: int, capacity: int = CAPACITY) -> Iterator[int]:
    """Lengths of the pieces of n tokens in order."""
    for _ in range(n // capacity):
        yield capacity
    rest = n % capacity
    while rest:
        top = 1 << (rest.bit_length() - 1)
        yield top
        rest -= top


def decomposed(docs: DataFrame, capacity: int = CAPACITY, end: int = END, tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece of every row of ``docs`` (doc_id LONG, text STRING); with ``ids`` also them.

    ``ids`` are little-endian unsigned 32-bit numbers. A null or empty text is the single end token. Null or repeated doc_ids are
    split like any others. An empty table gives no rows. Other columns are not read.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path, last = tokenizer or default_tokenizer(), int(end).to_bytes(4, "little")
    schema = _PIECE.append(pa.field("ids", pa.binary())) if ids else _PIECE

    def run(batches: Batches) -> Batches:
        model = ByteTokenizer.of(path)
        for b in portions(batches):
            rows = []
            for doc, found in zip(b.column("doc_id").to_pylist(), model.many(as_bytes(b.column("text")))):
                whole, at = memoryview(found + last), 0
                for n in lengths(len(whole) // 4, capacity):
                    piece = whole[4 * at:4 * (at + n)]
                    rows.append((doc, at, n, zlib.crc32(piece), len(whole) // 4, *([bytes(piece)] if ids else [])))
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECE_DDL + (", ids binary" if ids else ""))


def bucketed(docs: DataFrame, capacity: int = CAPACITY, end: int = END, tokenizer: str | None = None, ids: bool = False, batch_tokens: int = BATCH) -> DataFrame:
    """``decomposed`` with (sequence_id, offset, bucket, batch): the sequence of a piece, 0, the binary logarithm of its length, and its batch in the bucket.

    Batches of a bucket hold ``batch_tokens`` tokens, the last one the rest. Rows that repeat are sequences of their own.
    """
    pieces = stored(decomposed(docs, capacity, end, tokenizer, ids), "binary-pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per power of two
    sizes = sorted(counts)
    before = np.cumsum([0] + [counts[n] for n in sizes])
    first = F.element_at(F.create_map(*[F.lit(int(x)) for n, a in zip(sizes, before) for x in (n, a)]), F.col("length")) if sizes else F.lit(0)
    ranked = numbered(pieces, ["length"], ["doc_id", "start", "ids_crc32"], name="_rank")
    each = F.greatest(F.lit(1), F.lit(batch_tokens) / F.col("length"))
    return ranked.select(*pieces.columns, (first + F.col("_rank")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                         F.log2("length").cast("int").alias("bucket"), F.floor(F.col("_rank") / each).cast("long").alias("batch"))
