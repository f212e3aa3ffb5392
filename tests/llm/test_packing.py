"""Packing, tokens and token files: exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cases import documents, frame
from geocadence.llm.packing import alike, packed, packing_plan, take
from geocadence.llm.token_files import best_fit_decreasing, pack_shard, read_shard, written
from geocadence.llm.tokens import WordTokenizer, default_tokenizer


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_by_word_equal_ids_of_the_text(whole):
    rnd, own = random.Random(1), WordTokenizer(default_tokenizer())
    marks = [*"aAbE'sé́   \t\n\x1c\x85ß1.!<|>ΣςİŀȺ中", "<|endoftext|>", "<|startoftext|>", "'re", "'LL", "　", "\x0b"]
    for text in [r[1] or "" for r in documents()] + ["".join(rnd.choices(marks, k=rnd.randint(0, 14))) for _ in range(3000)]:
        assert np.frombuffer(own.ids(text.encode()), "<u4").tolist() == whole(text)


def pieces(rows, whole, capacity):
    out = []
    for r in rows:
        ids = np.array(whole(r[1]) + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.append((r[0], k, at, len(part), zlib.crc32(part.tobytes())))
    return out


@pytest.mark.parametrize("capacity", [32, 2048])
def test_every_piece_has_its_place(spark, whole, capacity):
    rows = documents()
    got = packed(frame(spark), capacity).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(pieces(rows, whole, capacity), key=repr)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in got)
    assert len(by) <= 1.15 * total / capacity + 2
    assert packed(frame(spark, []), capacity).count() == 0


def test_plans_hold_all_pieces():
    rnd = random.Random(3)
    for _ in range(60):
        capacity = rnd.choice([16, 64, 300])
        counts = {rnd.randint(1, capacity): rnd.choice([1, 2, 3, 7, 100, 100000]) for _ in range(rnd.randint(0, 40))}
        p = packing_plan(counts, capacity)
        seen = defaultdict(int)
        for length, start, n in zip(p["length"], p["from"], p["count"]):
            assert start == seen[length]
            seen[length] += n
        assert dict(seen) == counts
        if sum(counts.values()) < 5000:
            rows = defaultdict(list)
            for length, first, n, at in zip(p["length"], p["first"], p["count"], p["offset"]):
                for s in range(first, first + n):
                    rows[s].append((at, length))
            for places in rows.values():
                at = 0
                for offset, length in sorted(places):
                    assert offset == at
                    at += length
                assert at <= capacity


def test_plan_is_close_to_the_least():
    g = np.random.default_rng(1)
    lengths = np.minimum(2048, np.exp(g.normal(6.3, 1.0, 50_000)).astype(int) + 1)
    p = packing_plan(dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)))))
    assert (p["first"] + p["count"]).max() <= 1.002 * lengths.sum() / 2048
    thirds = packing_plan({600: 3000, 700: 3000, 740: 3000}, 2048)  # best fit decreasing wastes room here
    assert (thirds["first"] + thirds["count"]).max() <= 3000


def test_lanes():
    queue = [[9, 2], [7, 5]]
    assert take(queue, 4) == [(9, 2), (7, 2)] and queue == [[7, 3]]
    assert alike([[(9, 2), (7, 2)], [(5, 3), (4, 1)]]) == [(2, [9, 5]), (1, [7, 5]), (1, [7, 4])]


def test_best_fit_decreasing_takes_the_smallest_room():
    rnd = random.Random(4)
    for _ in range(50):
        capacity = rnd.choice([10, 50, 2048])
        lengths = np.array([rnd.randint(1, capacity) for _ in range(rnd.randint(0, 80))])
        rooms, n = [], 0
        for x in sorted(lengths.tolist(), reverse=True):
            fit = [r for r in rooms if r >= x]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - x)
            else:
                rooms.append(capacity - x)
                n += 1
        row, offset, count = best_fit_decreasing(lengths, capacity)
        assert count == n
        used = defaultdict(list)
        for r, at, x in zip(row, offset, lengths):
            used[r].append((at, x))
        assert all(at == sum(x for _, x in sorted(v)[:i]) for v in used.values() for i, (at, _) in enumerate(sorted(v)))


@pytest.mark.parametrize("shard_tokens", [500, 4_000_000])
def test_files_give_back_all_documents(spark, whole, tmp_path, shard_tokens):
    rows = documents()
    got = written(frame(spark), str(tmp_path / "out"), capacity=64, shard_tokens=shard_tokens).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(pieces(rows, whole, 64), key=repr)
    texts = defaultdict(list)
    for name in {r.shard for r in got}:
        a = read_shard(str(tmp_path / "out"), name)
        assert a["ids"].dtype == np.uint16 and a["ids"].shape[1] == 64
        resets = np.unpackbits(a["resets"], axis=1).astype(bool)
        for r in range(len(a["ids"])):
            lengths = a["cu_seqlens"][a["rows"][r]:a["rows"][r + 1]]
            assert lengths[0] == 0 and (np.diff(lengths) > 0).all() and lengths[-1] <= 64
            assert np.flatnonzero(resets[r]).tolist() == lengths[:-1].tolist()
            assert (a["ids"][r, lengths[-1]:] == 0).all()
        for doc, known, piece, start, n, r, at in a["pieces"].tolist():
            texts[doc if known else None, start].append(a["ids"][r, at:at + n].tolist())
    firsts = sorted(x[0] for (_, start), v in texts.items() if start == 0 for x in [w for w in v])
    assert len(firsts) == len(rows)
    for r in rows:
        ids = whole(r[1]) + [0]
        for at in range(0, len(ids), 64):
            texts[r[0], at].remove(ids[at:at + 64])
    assert not any(texts.values())


def test_no_documents_no_files(spark, tmp_path):
    assert written(frame(spark, []), str(tmp_path / "none")).count() == 0
    empty = pack_shard([])
    assert empty["ids"].shape == (0, 2048) and empty["rows"].tolist() == [0]
