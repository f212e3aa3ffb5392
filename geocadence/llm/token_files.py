"""Packed token ids as binary files: best-fit-decreasing packing with a segment tree over the room that sequences have left.

Every task packs its own documents, ``SHARD_TOKENS`` tokens at a time, and writes one shard of five ``.npy`` files to the
shared folder:

    <shard>.ids          rows x capacity, unsigned 16-bit ids (32-bit if the vocabulary needs it), padded with ``pad``
    <shard>.cu_seqlens   cumulative segment lengths of all rows one after another, each row from 0 to its used length
    <shard>.rows         where each row begins in cu_seqlens, and its end
    <shard>.resets       rows x capacity bits, set where the position restarts at 0 (the first token of a segment)
    <shard>.pieces       per segment: document, whether it has an id, piece, start in the document, length, row, offset

Documents longer than ``capacity`` are cut without loss; nothing is shuffled. A file appears whole or not at all, and a
repeated task writes the same files again.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geocadence.llm.kneser_ney import local_folder
from geocadence.llm.tables import Batches, batch
from geocadence.llm.tokens import WordTokenizer, default_tokenizer
from geocadence.llm.words import as_bytes, portions
from geocadence.session import scratch, stored

CAPACITY, END, PAD, SHARD_TOKENS = 2048, 0, 0, 4_000_000
_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("shard", pa.string()), ("row", pa.int32()), ("offset", pa.int32())])
_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, shard string, row int, offset int"


class Rooms:
    """A segment tree over the rooms 0 to ``capacity``; a node counts the open sequences below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.held: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.held[room].append(sequence)
        self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, sequence) of the smallest room that is at least ``length``."""
        node = length + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):  # up until a subtree to the right has sequences
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node <<= 1
                if not self.count[node]:
                    node += 1
        room = node - self.size
        self._add(room, -1)
        return room, self.held[room].pop()

    def _add(self, room: int, n: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += n
            node >>= 1


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of every piece, and the number of sequences."""
    rooms, sequences = Rooms(capacity), 0
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = rooms.take(length)
        if found is None:
            found, sequences = (capacity, sequences), sequences + 1
        room, sequence[i] = found
        offset[i] = capacity - room
        if room > length:
            rooms.put(room - length, int(sequence[i]))
    return sequence, offset, sequences


def pack_shard(documents: list[tuple[int | None, np.ndarray]], capacity: int = CAPACITY, pad: int = PAD, kind=np.uint16) -> dict[str, np.ndarray]:
    """The five arrays of a shard; ``documents``: (doc_id, ids with the end id)."""
    pieces = [(doc, n, at, ids[at:at + capacity]) for doc, ids in documents for n, at in enumerate(range(0, len(ids), capacity))]
    lengths = np.array([len(p[3]) for p in pieces], np.int64)
    row, offset, rows = best_fit_decreasing(lengths, capacity)
    ids, resets = np.full((rows, capacity), pad, kind), np.zeros((rows, capacity), bool)
    for (_, _, _, part), r, at in zip(pieces, row.tolist(), offset.tolist()):
        ids[r, at:at + len(part)] = part
        resets[r, at] = True
    order = np.lexsort((offset, row))
    ends = np.bincount(row, minlength=rows) + 1  # entries of cu_seqlens per row
    first = np.concatenate([[0], np.cumsum(ends)]).astype(np.int64)
    seqlens = np.zeros(int(first[-1]), np.int32)
    place = first[row[order]] + 1 + np.arange(len(order)) - np.searchsorted(row[order], row[order])
    seqlens[place] = (offset + lengths)[order]
    table = np.array([(p[0] or 0, p[0] is not None, p[1], p[2], len(p[3]), r, at) for p, r, at in zip(pieces, row.tolist(), offset.tolist())], np.int64).reshape(-1, 7)
    return {"ids": ids, "cu_seqlens": seqlens, "rows": first, "resets": np.packbits(resets, axis=1), "pieces": table}


def write_shard(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    os.makedirs(folder, exist_ok=True)
    for kind, array in arrays.items():
        part = f"{folder}/.{name}.{kind}-{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            np.save(f, array)
        os.replace(part, f"{folder}/{name}.{kind}.npy")


def read_shard(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a shard, mapped into memory."""
    return {kind: np.load(f"{folder}/{name}.{kind}.npy", mmap_mode="r") for kind in ("ids", "cu_seqlens", "rows", "resets", "pieces")}


def written(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, capacity: int = CAPACITY, shard_tokens: int = SHARD_TOKENS, pad: int = PAD) -> DataFrame:
    """Packs and writes all rows of ``docs`` (doc_id LONG, text STRING); (doc_id, piece, start, length, ids_crc32, shard, row, offset) per piece.

    ids_crc32 is taken from the file's mapped matrix after it was written. A null or empty text is the single end id. doc_id may be
    null or repeat; an empty table writes nothing and gives no rows. Other columns are not read.
    """
    folder = local_folder(folder or scratch(docs.sparkSession, "token-files"))
    path = tokenizer or default_tokenizer()

    def run(batches: Batches) -> Batches:
        words = WordTokenizer.of(path)
        kind = np.uint16 if words.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        task, shards, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal shards, held, size
            name = f"{task:06d}-{shards:05d}"
            write_shard(folder, name, pack_shard(held, capacity, pad, kind))
            arrays = read_shard(folder, name)
            shards, held, size = shards + 1, [], 0
            table, ids = arrays["pieces"], arrays["ids"]
            crc = [zlib.crc32(ids[r, at:at + n].astype("<u4").tobytes()) for n, r, at in table[:, 4:].tolist()]
            known = pa.array(table[:, 1] == 0)
            doc = pa.array(np.asarray(table[:, 0]), mask=known.to_numpy(zero_copy_only=False))
            return batch(_PIECE, doc_id=doc, piece=table[:, 2].astype(np.int32), start=np.asarray(table[:, 3]), length=np.asarray(table[:, 4]), ids_crc32=crc, shard=[name] * len(table), row=table[:, 5].astype(np.int32), offset=table[:, 6].astype(np.int32))

        for b in portions(batches):
            for doc, text in zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text"))):
                ids = np.append(np.frombuffer(words.ids(text), "<u4"), np.uint32(END)).astype(kind)
                held.append((doc, ids))
                size += len(ids)
                if size >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DDL), "token-files-pieces")
