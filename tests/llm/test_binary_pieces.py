"""Binary pieces and byte-level ids against the tokenizer itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import documents, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from geocadence.llm import byte_tokens
from geocadence.llm.binary_pieces import bucketed, decomposed, lengths
from geocadence.llm.byte_tokens import ByteTokenizer, default_tokenizer

ODD = ["a", "word", "The", "é", "日本", " ", " ", " ", "  ", "\n", "\t", "\r\n", "\xa0", "\u3000", "\u2003", "\x85", "\x1c", "\x00", "'s", "'", ".", "!?", "12", "<|endoftext|>", "<|endo",
       "ﬁ", "Ġ", "_", "x9", "\u180e", "\u200b", "\ufeff", "\x0b", "²", "ª", "end.", "end.)", "(" , "’s"]


@pytest.fixture(scope="module")
def model():
    return ByteTokenizer(default_tokenizer())


def whole(model, text):
    return model.tokenizer.encode(text or "", add_special_tokens=False).ids


def mine(model, text):
    return np.frombuffer(model.ids(text.encode()), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=3)), max_size=14).map("".join).filter(lambda t: not any("\ud800" <= c <= "\udfff" for c in t)))
def test_ids_equal_the_whole_text(model, text):
    assert mine(model, text) == whole(model, text)


def test_texts_cut_and_words_forgotten(model, monkeypatch):
    rnd = random.Random(4)
    monkeypatch.setattr(byte_tokens, "SLICE", 16)
    monkeypatch.setattr(byte_tokens, "HELD", 20)
    small = ByteTokenizer(default_tokenizer())
    texts = ["".join(rnd.choices(ODD, k=rnd.randint(5, 60))) for _ in range(1500)]
    for i in range(0, len(texts), 50):
        for text, ids in zip(texts[i:i + 50], small.many([t.encode() for t in texts[i:i + 50]])):
            assert np.frombuffer(ids, "<u4").tolist() == whole(model, text)
    assert len(small.other) < 40


def test_lengths():
    for capacity in (1, 8, 2048):
        for n in [0, 1, 7, 8, 9, 2047, 2048, 2049, 5000]:
            out = list(lengths(n, capacity))
            assert sum(out) == n and all(x & (x - 1) == 0 and x <= capacity for x in out)
            assert out == sorted(out, reverse=True) and len([x for x in out if x < capacity]) == bin(n % capacity).count("1")


@pytest.mark.parametrize("capacity", [16, 2048])
def test_every_id_once_and_no_padding(spark, model, capacity):
    rows = documents() + [(903, "<|endoftext|> two\xa0 spaces \n x", None, None, 1, None, -1, "k", 0, "x")]
    got = bucketed(frame(spark, rows), capacity, ids=True, batch_tokens=64).collect()
    ids = defaultdict(list)
    for doc, text, *_ in rows:
        ids[doc].append([*whole(model, text), 1])
    pieces = defaultdict(list)
    for r in got:
        data = np.frombuffer(r.ids, "<u4").tolist()
        assert len(data) == r.length and r.length & (r.length - 1) == 0 and r.length <= capacity and 1 << r.bucket == r.length
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.offset == 0
        pieces[r.doc_id].append((r.start, data, r.doc_tokens))
    for doc, texts in ids.items():
        want = sorted((at, t[at:at + n], len(t)) for t in texts for at, n in zip(np.cumsum([0, *lengths(len(t), capacity)]).tolist(), lengths(len(t), capacity)))
        assert sorted(pieces[doc]) == want
    numbers = sorted(r.sequence_id for r in got)
    assert numbers == list(range(len(got))) and pieces.keys() == ids.keys()
    batches = defaultdict(list)
    for r in got:
        batches[r.bucket, r.batch].append(r.sequence_id)
    for (bucket, _), members in batches.items():
        assert max(members) - min(members) == len(members) - 1 and len(members) <= max(1, 64 >> bucket)


def test_empty_table_and_wrong_capacity(spark):
    assert bucketed(frame(spark, [])).count() == 0 == decomposed(frame(spark, [])).count()
    with pytest.raises(ValueError):
        decomposed(frame(spark, []), 100)
