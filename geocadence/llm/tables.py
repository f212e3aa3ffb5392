"""Spark helpers the text operators share: Arrow batches, bitmaps of bounded size, prefix sums, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geocadence.session import stored

Batches = Iterator[pa.RecordBatch]


def text_hash_key(c: str = "doc_id") -> Column:
    """crc32 of an id written as text; null stays null."""
    return F.crc32(F.col(c).cast("string"))


def shards_of(spark: SparkSession) -> int:
    """Number of hash shards: the session's shuffle partitions, which the cluster sizes with its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shard_bits(spark: SparkSession) -> int:
    """Shards as the highest bits of a hash: at least as many as the shuffle partitions."""
    return max(1, (shards_of(spark) - 1).bit_length())


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


# --- bitmaps ----------------------------------------------------------------------------------------
_BLOCK_BITS = 16


def bitmap(keys: DataFrame, bits: int = 24, keys_of=lambda b: b.column(0).to_numpy(zero_copy_only=False)) -> np.ndarray:
    """2**bits bits, set where a LONG key of the one-column table (or what ``keys_of`` takes from its batches) falls; its size (2 MB) does not depend on the data.

    A set of keys with false positives and no false negatives, small enough to travel with every task. Tasks build the
    blocks they touch, blocks are united by key, and only the bitmap reaches the driver.
    """
    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])

    def build(batches: Batches) -> Batches:
        seen: dict[int, np.ndarray] = {}
        for b in batches:
            at = bitmap_places(keys_of(b), bits)
            for block in np.unique(at >> _BLOCK_BITS).tolist():
                own = np.zeros(1 << _BLOCK_BITS, bool)
                own[at[at >> _BLOCK_BITS == block] & ((1 << _BLOCK_BITS) - 1)] = True
                packed = np.packbits(own)
                seen[block] = seen[block] | packed if block in seen else packed
        if seen:
            yield batch(schema, block=list(seen), bits=[x.tobytes() for x in seen.values()])

    def unite(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint8) for x in group.column("bits").to_pylist()]
        return pa.table({"block": group.column("block")[:1], "bits": pa.array([np.bitwise_or.reduce(parts).tobytes()], pa.binary())}, schema=schema)

    rows = keys.mapInArrow(build, "block int, bits binary").groupBy("block").applyInArrow(unite, "block int, bits binary").collect()
    size = 1 << _BLOCK_BITS >> 3
    out = np.zeros(1 << bits >> 3, np.uint8)
    for block, packed in rows:
        out[block * size:(block + 1) * size] = np.frombuffer(packed, np.uint8)
    return out


def bitmap_places(keys: np.ndarray, bits: int) -> np.ndarray:
    mixed = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def in_bitmap(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = bitmap_places(keys, int(len(packed) * 8).bit_length() - 1)
    return (packed[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)


# --- running sums without one big window -------------------------------------------------------------
def numbered(df: DataFrame, key: list[str], order: list[str], value: str | None = None, name: str = "before", salts: int | None = None) -> DataFrame:
    """Adds ``name``: the sum of ``value`` (default: the count) over the rows of the same key that come earlier.

    The order is by hash of ``order``, then by ``order`` itself: arbitrary but fixed. Rows are dealt to (key, salt) groups,
    so a key with a third of all rows is many tasks; only sums by (key, salt) meet per key.
    """
    salts = salts or 4 * shards_of(df.sparkSession)
    keys = [F.col(c) for c in key]
    one = F.col(value) if value else F.lit(1)
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sums = rows.groupBy(*key, "_salt").agg(F.sum(one).cast("long").alias("_sum"))
    earlier = F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], F.col("_salt").alias("_s"), F.coalesce(earlier, F.lit(0)).alias("_start"))
    same = F.col("_salt") == F.col("_s")
    for i, c in enumerate(key):
        same &= F.col(c).eqNullSafe(F.col(f"_k{i}"))
    inner = F.sum(one).over(Window.partitionBy(*keys, "_salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_inner", F.coalesce(inner, F.lit(0)))
    return rows.join(starts, same).withColumn(name, (F.col("_start") + F.col("_inner")).cast("long")).drop(
        "_salt", "_s", "_start", "_inner", *[f"_k{i}" for i in range(len(key))])


# --- components -------------------------------------------------------------------------------------
def components(links: DataFrame, label: str = "components", rounds: int = 64) -> DataFrame:
    """(id, component): smallest id reachable from each end of ``links`` (a, b), two LONG columns.

    Alternating large-star and small-star steps on a table of links; every round is written to the shared folder, so the
    plan stays short, a lost executor costs one round, and both sides of a join are plain shuffles, which Spark can split
    at a hub. Only a count and a hash of the links reach the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = stored(edges, label), None
    for _ in range(rounds):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), label)
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(large.where("u <> v").distinct(), label)
        low = stored(edges.groupBy("u").agg(F.min("v").alias("m")), label)
        small = edges.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = stored(small.where("u <> v").distinct(), label)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
