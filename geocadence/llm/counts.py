"""Counts of 64-bit keys, summed by hash shard in blocks of sorted keys instead of row by row."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from geocadence.llm.tables import Batches, batch
from geocadence.llm.words import portions, released

_FLUSH = 4_000_000
_BLOCK = pa.schema([("shard", pa.int32()), ("once", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])
_BLOCK_DDL = "shard int, once binary, keys binary, counts binary"


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def blocks(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """Sorted keys by shard; keys counted once carry no count."""
    order = np.argsort(shard, kind="stable")
    keys, counts, shard = keys[order], counts[order], shard[order]
    numbers, start = np.unique(shard, return_index=True)
    rows = []
    for number, a, b in zip(numbers.tolist(), start, np.append(start[1:], len(shard))):
        once = counts[a:b] == 1
        rows.append((number, keys[a:b][once].tobytes(), keys[a:b][~once].tobytes(), counts[a:b][~once].tobytes()))
    columns = zip(*rows) if rows else [[]] * 4
    return batch(_BLOCK, **dict(zip(_BLOCK.names, columns)))


def united(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    def joined(name, kind):
        return np.concatenate([np.frombuffer(x, kind) for x in group.column(name).to_pylist()])
    once, keys, counts = joined("once", np.uint64), joined("keys", np.uint64), joined("counts", np.int64)
    out = summed(np.concatenate([once, keys]), np.concatenate([np.ones(len(once), np.int64), counts]))
    del once, keys, counts
    released()
    return out


def counted(rows: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], shard_of: Callable[[np.ndarray], np.ndarray], flush: int = _FLUSH) -> DataFrame:
    """Blocks of the counts of ``keys_of`` the rows (one column, text or binary), summed per task in parts of about ``flush`` keys.

    ``groupBy("shard").applyInArrow`` with ``united`` then adds the blocks of a shard.
    """
    def run(batches: Batches) -> Batches:
        held, size = [], 0

        def block():
            keys, counts = summed(*map(np.concatenate, zip(*held)))
            return blocks(keys, counts, shard_of(keys))

        for b in portions(batches, 0):
            keys = keys_of(b)
            held.append(summed(keys, np.ones(len(keys), np.int64)))
            size += len(held[-1][0])
            if size > flush:
                yield block()
                held, size = [], 0
        if held:
            yield block()
    return rows.mapInArrow(run, _BLOCK_DDL)
