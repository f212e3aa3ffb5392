"""Token ids of whole texts by a public byte-level tokenizer file, a chunk at a time.

A byte-level tokenizer of this kind never joins a character that is no white space with white space behind it, so a text may be cut
before any white space that follows such a character, and the ids of the text are the ids of the chunks in order. Nearly
all chunks are one space and a word: a worker keeps the ids of those it has met, the newer ones when it holds twice ``HELD``.
New ones are encoded many at a time; a chunk begins at its only id whose bytes begin with a space.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

from geocadence.llm.words import SLICE

HELD = 600_000
TAIL = b".,;:!?*#$%&"  # behind letters these are a unit of their own
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_ODD = re.compile(rb"\A[\t-\r]|[\t-\r]\Z|\A\Z|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")  # words that may belong to a longer run of white space
_SAFE = re.compile(rb"(?<=[!-~]) (?=[!-~])")
_known: dict[str, "ByteTokenizer"] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def parts(text: bytes) -> Iterator[bytes]:
    """The text in order, cut before single spaces between words into parts of at least SLICE bytes."""
    at = 0
    while len(text) - at > SLICE:
        gap = _SAFE.search(text, at + SLICE)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:]


class ByteTokenizer:
    """ids(text) as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.first = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.first[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True  # how such files write a space
        self.spaced: dict[bytes, bytes] = {}  # by the word behind one space
        self.older: dict[bytes, bytes] = {}
        self.other: dict[bytes, bytes] = {}   # by the whole chunk

    @classmethod
    def of(cls, path: str) -> "ByteTokenizer":
        """The worker's own, with the words it has met."""
        if path not in _known:
            _known[path] = cls(path)
        return _known[path]

    def ids(self, text: bytes) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text; words that are new are encoded together."""
        split = [[part.split(b" ") for part in parts(text)] for text in texts]
        words = set()
        for chunks in split:
            for _, *rest in chunks:
                words.update(rest)
        missing = words.difference(self.spaced)
        if missing:
            if len(self.spaced) > HELD:
                self.older, self.spaced, missing = self.spaced, {}, words
            self._learn([w for w in missing if w in self.older or _ODD.search(w) is None])
        return [b"".join(map(self._found, chunks)) for chunks in split]

    def _found(self, words: list[bytes]) -> bytes:
        """Ids of a part that is split at spaces."""
        first, *rest = words
        if first and _ODD.search(first):
            return self._runs(words)
        try:
            return (self._one(first) if first else b"") + b"".join(map(self.spaced.__getitem__, rest))
        except KeyError:  # a run of white space that is not one space
            return self._runs(words)

    def _runs(self, words: list[bytes]) -> bytes:
        chunks = [c.encode() for c in _CHUNK.findall(b" ".join(words).decode())]
        return b"".join(self.spaced[c[1:]] if c[:1] == b" " and c[1:] in self.spaced else self._one(c) for c in chunks)

    def _one(self, chunk: bytes) -> bytes:
        if chunk not in self.other:
            if len(self.other) > HELD // 4:
                self.other.clear()
            self.other[chunk] = np.array(self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return self.other[chunk]

    def _learn(self, words) -> None:
        held, older, tails, new = self.spaced, self.older, [], {}
        for w in words:
            ids = older.get(w)
            if ids is not None:
                held[w] = ids
                continue
            stem = w.rstrip(TAIL)
            if len(stem) < len(w) and stem.decode().isalpha():
                tails.append((w, stem, w[len(stem):]))
                w = stem
                if w in held:
                    continue
            new[w] = None
        new = [w for w in new if w not in held]
        for i in range(0, len(new), 4000):
            some = new[i:i + 4000]
            ids = np.array(self.tokenizer.encode_batch_fast([(b" " + b" ".join(some)).decode()], add_special_tokens=False)[0].ids, "<u4")
            starts = (4 * np.flatnonzero(self.first[ids])).tolist()
            if len(starts) == len(some) and starts[0] == 0:
                whole = ids.tobytes()
                held.update(zip(some, map(whole.__getitem__, map(slice, starts, starts[1:] + [len(whole)]))))
            else:
                for w, found in zip(some, self.tokenizer.encode_batch_fast([" " + w.decode() for w in some], add_special_tokens=False)):
                    held[w] = np.array(found.ids, "<u4").tobytes()
        for w, stem, tail in tails:
            held[w] = held[stem] + self._one(tail)
