"""Words, 64-bit word hashes and word shingles of whole texts, computed per Arrow batch with numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D. All work is done on slices of about half a megabyte, cut
at white space, so memory does not depend on the length of a text (only on that of its longest word).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

SPACES = b" \t\n\x0b\x0c\r"
SLICE = 1 << 19
_GAP = re.compile(rb"[\x20\x09-\x0d]")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


_BASE = 0x9E3779B97F4A7C13  # odd, 3 modulo 8
_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
_STEP = mix(np.arange(101, 117, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)  # one odd factor per word of a shingle
_tables = [_powers(_BASE, 2), _powers(pow(_BASE, -1, 1 << 64), 2)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_tables[0]) < n:
        size = max(n, SLICE + (SLICE >> 3))
        _tables[:] = [_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)]
    return _tables


def slices(text: bytes) -> Iterator[bytes]:
    """The text in order, cut at white space into parts of about SLICE bytes."""
    at = 0
    while len(text) - at > SLICE:
        cut = max(text.rfind(c, at, at + SLICE) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= at:
            gap = _GAP.search(text, at + SLICE)
            if gap is None:
                break
            cut = gap.start()
        yield text[at:cut]
        at = cut
    yield text[at:]


def spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a byte array."""
    inside = np.zeros(len(buf) + 2, np.int8)
    np.logical_not(_IS_SPACE[buf], out=inside[1:-1].view(bool))
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans of a byte array."""
    power, inverse = _power_tables(len(buf))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * power[:len(buf)], out=total[1:])
    value = (total[end] - total[start]) * inverse[start]
    return mix(value + (end - start).astype(np.uint64))


def word_buffers(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, word starts, word ends, text of each word) for about SLICE bytes of texts at a time; a long text spans several."""
    held, owner, size = [], [], 0

    def joined():
        buf = np.frombuffer(b" ".join(held), np.uint8)
        start, end = spans(buf)
        begins = np.cumsum([0] + [len(p) + 1 for p in held[:-1]])
        return buf, start, end, np.asarray(owner)[np.searchsorted(begins, start, "right") - 1]

    for i, text in enumerate(texts):
        for part in slices(text):
            if held and size + len(part) > SLICE:
                yield joined()
                held, owner, size = [], [], 0
            held.append(part)
            owner.append(i)
            size += len(part) + 1
    if held:
        yield joined()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, first) with the words of text i at first[i]:first[i + 1]."""
    counts = np.zeros(len(texts) + 1, np.int64)
    parts = [np.zeros(0, np.uint64)]
    for buf, start, end, text in word_buffers(texts):
        parts.append(hash_spans(buf, start, end))
        counts[1:] += np.bincount(text, minlength=len(texts))
    return np.concatenate(parts), np.cumsum(counts)


def shingle_sets(texts: list[bytes], width: int = 3) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles; a shorter text is one shingle of all its words."""
    hashes, first = word_hashes(texts)
    if width > len(_STEP):
        raise ValueError(f"shingles have at most {len(_STEP)} words")
    n = len(hashes) - width + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        rolled += hashes[k:k + len(rolled)] * _STEP[k]
    rolled = mix(rolled)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            yield np.unique(rolled[a:b - width + 1])
        elif b > a:
            short = hashes[a:b] * _STEP[:b - a]
            yield mix(np.array([short.sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def as_bytes(column, lower: bool = False) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; null counts as empty. ``lower`` lower-cases A-Z."""
    import pyarrow as pa
    import pyarrow.compute as pc
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    out = pc.fill_null(column.cast(kind), b"").to_pylist()
    return [t.lower() for t in out] if lower else out


def released() -> None:
    """Gives memory that Arrow and numpy have freed back to the system: idle workers of earlier stages would keep it."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def portions(batches, column: str | int = "text", limit: int = 2 << 20):
    """The rows of Arrow batches in order, in parts whose ``column`` holds about ``limit`` bytes or is one row: bounds a worker's memory."""
    import pyarrow.compute as pc
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            past = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, past + limit, "right")))
            yield b.slice(at, end - at)
            at = end
        released()
