"""Token ids of whole texts by a public tokenizer file, a word at a time.

The tokenizer splits at white space, so the ids of a text are the ids of its words in order. Words repeat, so a worker
keeps the ids of words it has met, the newer ones when it holds twice ``HELD``, so its memory is bounded. New words of letters
are encoded many at a time: such a word is one unit of the tokenizer and ends with its only id that has the end-of-word mark; a
tail of sentence marks is a unit of its own.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geocadence.llm.tables import Batches
from geocadence.llm.words import as_bytes, portions, slices

HELD = 450_000
TAIL = ".,;:!?*#$%&"  # may follow the letters of a word without changing their ids
_known: dict[str, "WordTokenizer"] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def letters(word: str) -> bool:
    """Whether a word stays letters only when it is normalised."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class WordTokenizer:
    """ids(text) as little-endian unsigned 32-bit bytes, for a tokenizer whose words do not reach over white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.held: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab() if mark else {}
        self.last = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.last[[i for word, i in vocabulary.items() if word.endswith(mark)]] = True

    @classmethod
    def of(cls, path: str) -> "WordTokenizer":
        """The worker's own, with the words it has met."""
        if path not in _known:
            _known[path] = cls(path)
        return _known[path]

    def ids(self, text: bytes) -> bytes:
        out = []
        for part in slices(text):
            words = part.split()
            held = self.held
            missing = {w for w in words if w not in held}
            if missing:
                if len(held) > HELD:
                    self.older, self.held = held, {}
                    missing = set(words)
                held = self.held
                new = []
                for w in missing:
                    ids = self.older.get(w)
                    if ids is None:
                        new.append(w)
                    else:
                        held[w] = ids
                self._encode(new)
            out.append(b"".join(map(held.__getitem__, words)))
        return b"".join(out)

    def _encode(self, words: list[bytes]) -> None:
        plain, spelled, stems = [], [], {}
        for w in words:
            word = w.decode()
            stem = word.rstrip(TAIL)
            if len(self.last) and letters(stem):
                tail = word[len(stem):]
                stem = stem.lower() if stem.isascii() else stem
                spelled.append((w, stem, tail))
                if stem not in stems:
                    stems[stem] = self.held.get(stem.encode())
            else:
                plain.append((w, word))
        new = [stem for stem, ids in stems.items() if ids is None]
        for i in range(0, len(new), 2000):
            some = new[i:i + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
            whole, start = ids.tobytes(), 0
            if len(ends) == len(some):
                for stem, end in zip(some, ends):
                    stems[stem] = whole[start:end]
                    start = end
        for w, stem, tail in spelled:
            ids = stems[stem]
            if ids is None:
                plain.append((w, w.decode()))
            else:
                self.held[w] = ids + self._tail(tail) if tail else ids
        if plain:
            for (w, _), found in zip(plain, self.tokenizer.encode_batch_fast([word for _, word in plain], add_special_tokens=False)):
                self.held[w] = np.array(found.ids, "<u4").tobytes()

    def _tail(self, tail: str) -> bytes:
        key = tail.encode()
        if key not in self.held:
            self.held[key] = np.array(self.tokenizer.encode(tail, add_special_tokens=False).ids, "<u4").tobytes()
        return self.held[key]


def token_pieces(docs: DataFrame, ddl: str, schema: pa.Schema, emit, path: str | None = None) -> DataFrame:
    """Runs ``emit(doc_id, ids)`` per document (ids: bytes, 4 per token), which yields rows of ``schema``; null texts are empty."""
    path = path or default_tokenizer()

    def run(batches: Batches) -> Batches:
        tokenizer = WordTokenizer.of(path)
        for b in portions(batches):
            rows = [r for doc, text in zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text"))) for r in emit(doc, tokenizer.ids(text))]
            columns = zip(*rows) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ddl)
