"""Best-fit packing by linear grouping: as few sequences of ``capacity`` tokens as it can.

Pieces of equal length are interchangeable, so the plan needs only how many pieces there are of each length: at most
``capacity`` numbers, whatever the corpus. From them the driver makes, in this order:

1. large lengths (more than a share of the capacity) are sorted and cut into groups of equal cardinality, and every
   length is rounded up to the largest of its group: a few sizes remain;
2. configurations (how many of each size a sequence takes) are optimised by column generation: a linear programme over the
   configurations found so far, and a knapsack that finds the one with the most value; the whole parts of its solution are
   used, what they leave over is packed by best fit;
3. actual lengths take the places of the rounded ones, longest first;
4. small lengths, longest first, go to the fullest sequence that still has room, by the room the actual lengths leave.

The number of groups and the share are tried in a few combinations, and the plan with the fewest sequences is used.

The plan is a list of runs (length, rank from, rank to, first sequence, step, offset); its size is bounded by the lengths and
configurations, not by the pieces. Spark numbers the pieces within each length and every piece finds its place by binary search.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geocadence.llm.tables import Batches, numbered
from geocadence.llm.tokens import token_pieces
from geocadence.session import stored

CAPACITY, END = 2048, 0
SCHEMES = ((64, 1 / 4), (64, 1 / 3), (64, 1 / 2))  # groups of the large lengths, largest share of the capacity that is small
_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- the plan, from the number of pieces of each length ---------------------------------------------
def grouped(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Lengths from the longest down, cut into groups of equal cardinality: (largest length, [(length, count)]); groups of one size are one."""
    if len(counts) <= groups:  # nothing to round
        return [(length, [(length, counts[length])]) for length in sorted(counts, reverse=True)]
    total = sum(counts.values())
    size, out, room = -(-total // max(1, groups)), [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if room == 0:
                room = size
                if not out or out[-1][0] != length:
                    out.append((length, []))
            n = min(left, room)
            out[-1][1].append((length, n))
            left, room = left - n, room - n
    return out


def best_configuration(sizes: list[int], value: np.ndarray, limits: list[int], capacity: int) -> tuple[float, np.ndarray]:
    """The configuration worth most (a bounded knapsack over the few sizes)."""
    best = np.zeros(capacity + 1)
    took = []
    for size, worth, limit in zip(sizes, value, limits):
        used = np.zeros(capacity + 1, np.int64)
        if worth > 1e-12:
            base = best.copy()
            for n in range(1, min(limit, capacity // size) + 1):
                shifted = np.full(capacity + 1, -1.0)
                shifted[n * size:] = base[:capacity + 1 - n * size] + n * worth
                better = shifted > best + 1e-12
                best[better], used[better] = shifted[better], n
        took.append(used)
    out, room = np.zeros(len(sizes), np.int64), capacity
    for k in range(len(sizes) - 1, -1, -1):
        out[k] = took[k][room]
        room -= out[k] * sizes[k]
    return float(best[capacity]), out


def optimised(sizes: list[int], demand: list[int], capacity: int, steps: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations with whole multiplicities that together need no more than ``demand``: column generation, rounded down.

    The simplex basis is a square matrix over the few sizes; a step swaps in the configuration with the best price.
    """
    k = len(sizes)
    basis = np.diag([capacity // s for s in sizes]).astype(float)
    need = np.array(demand, float)
    for _ in range(steps):
        price = np.linalg.solve(basis.T, np.ones(k))
        worth, column = best_configuration(sizes, price, demand, capacity)
        if worth <= 1 + 1e-9:
            break
        x, d = np.linalg.solve(basis, need), np.linalg.solve(basis, column.astype(float))
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    x = np.maximum(np.linalg.solve(basis, need), 0)
    left, out = list(demand), []
    for j in range(k):
        column = np.rint(basis[:, j]).astype(int)
        times = min([int(x[j] + 1e-6)] + [left[i] // column[i] for i in range(k) if column[i]])
        if times > 0 and column.any():
            out.append((column, times))
            left = [a - int(c) * times for a, c in zip(left, column)]
    return out


class Plan:
    """Runs of sequences that are filled alike, (first sequence, how many, lengths in order), by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.by_room: list[list[tuple[int, int, list[int]]]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r: some run has room r

    def open(self, count: int, lengths: list[int]) -> None:
        self._keep(self.sequences, count, lengths)
        self.sequences += count

    def _keep(self, first: int, count: int, lengths: list[int]) -> None:
        room = self.capacity - sum(lengths)
        self.by_room[room].append((first, count, lengths))
        self.rooms |= 1 << room

    def _fullest(self, length: int) -> tuple[int, int, list[int]] | None:
        fits = self.rooms >> length << length
        if not fits:
            return None
        room = (fits & -fits).bit_length() - 1
        run = self.by_room[room].pop()
        if not self.by_room[room]:
            self.rooms ^= 1 << room
        return run

    def best_fit(self, length: int, count: int) -> None:
        """``count`` pieces of one length, each to the fullest sequence with room; new sequences when none has."""
        while count:
            run = self._fullest(length)
            if run is None:
                each = self.capacity // length
                full, rest = divmod(count, each)
                for times, n in ((full, each), (1, rest)):
                    if times and n:
                        self.open(times, [length] * n)
                return
            first, n, lengths = run
            each = min((self.capacity - sum(lengths)) // length, count)
            used = min(n, count // each)
            if used < n:
                self._keep(first + used, n - used, lengths)
            self._keep(first, used, lengths + [length] * each)
            count -= used * each

    def places(self) -> list[tuple[int, int, int, int]]:
        """(length, first sequence, sequences, offset) of every position of every run."""
        return [(length, first, count, sum(lengths[:i])) for runs in self.by_room for first, count, lengths in runs for i, length in enumerate(lengths)]


def take(queue: list[list[int]], n: int) -> list[tuple[int, int]]:
    """The next n lengths of a group, as (length, count)."""
    out = []
    while n:
        length, held = queue[0]
        k = min(held, n)
        out.append((length, k))
        queue[0][1] -= k
        n -= k
        if not queue[0][1]:
            queue.pop(0)
    return out


def alike(lanes: list[list[tuple[int, int]]]) -> list[tuple[int, list[int]]]:
    """Lanes of equal total count, cut where any lane changes its length: (count, length in each lane)."""
    ends = [np.cumsum([n for _, n in lane]) for lane in lanes]
    cuts = np.unique(np.concatenate(ends))
    return [(int(b - a), [lane[int(np.searchsorted(e, b))][0] for lane, e in zip(lanes, ends)]) for a, b in zip(np.concatenate([[0], cuts[:-1]]), cuts)]


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY, schemes=SCHEMES) -> dict[str, np.ndarray]:
    """Places for ``counts`` pieces of each length (1 to capacity), by the scheme that needs the fewest sequences.

    Arrays of equal size: length, from (rank of the first piece within its length), count, first (sequence), offset.
    """
    plan = min((scheme_plan(counts, capacity, *scheme) for scheme in schemes), key=lambda p: p.sequences)
    places = np.array(sorted(plan.places()), np.int64).reshape(-1, 4)
    out = {name: places[:, i] for i, name in enumerate(("length", "first", "count", "offset"))}
    before = np.cumsum(out["count"]) - out["count"]
    out["from"] = before - before[np.searchsorted(out["length"], out["length"])] if len(before) else before
    return out


def scheme_plan(counts: dict[int, int], capacity: int, groups: int, small: float) -> Plan:
    plan = Plan(capacity)
    counts = {length: n for length, n in counts.items() if n}
    if counts.get(capacity):
        plan.open(counts.pop(capacity), [capacity])
    parts = grouped({length: n for length, n in counts.items() if length > capacity * small}, groups)
    rest = {length: n for length, n in counts.items() if length <= capacity * small}
    queues = [[list(x) for x in members] for _, members in parts]
    for column, times in optimised([s for s, _ in parts], [sum(n for _, n in m) for _, m in parts], capacity) if parts else []:
        lanes = [take(queues[g], times) for g in np.flatnonzero(column) for _ in range(column[g])]
        for count, lengths in alike(lanes):
            plan.open(count, lengths)
    for length, n in (x for queue in queues for x in queue):
        rest[length] = rest.get(length, 0) + n
    for length in sorted(rest, reverse=True):
        plan.best_fit(length, rest[length])
    return plan


# --- on tables --------------------------------------------------------------------------------------
def cut(doc, ids: bytes, capacity: int = CAPACITY, end: int = END):
    """Pieces (doc_id, piece, start, length, ids_crc32) of a document: its ids and then ``end``, cut every ``capacity``."""
    whole = ids + int(end).to_bytes(4, "little")
    for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
        part = whole[at:at + 4 * capacity]
        yield doc, piece, at // 4, len(part) // 4, zlib.crc32(part)


def packed(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, schemes=SCHEMES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row of ``docs`` (doc_id LONG, text STRING).

    A null or empty text is the single end token. Rows with null or repeated doc_id are packed like any others. An
    empty table gives no rows. Other columns are not read.
    """
    pieces = stored(token_pieces(docs, _PIECE_DDL, _PIECE, lambda doc, ids: cut(doc, ids, capacity), tokenizer), "packing-pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    plan = packing_plan(counts, capacity, schemes)
    order = (plan["length"] << 40) + plan["from"]
    schema = _PIECE.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64()))

    def place(batches: Batches) -> Batches:
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(order, (length << 40) + rank, "right") - 1
            sequence = plan["first"][at] + rank - plan["from"][at]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in _PIECE), pa.array(sequence), pa.array(plan["offset"][at])], schema=schema)

    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], name="rank")
    return ranked.select(*_PIECE.names, "rank").mapInArrow(place, _PIECE_DDL + ", sequence_id long, offset long")
