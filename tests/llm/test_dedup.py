"""Cuckoo index and exact duplicates."""

import hashlib
import random
import re
from collections import defaultdict

from cases import documents, frame
from geocadence.llm.cuckoo import CuckooFilter, Shard, combined, digests, duplicates, normalise, updated, without_duplicates


def norm(t):
    return re.sub(rb"[\x20\x09-\x0d]+", b" ", (t or "").encode())


def test_normalise():
    for t in ["", " ", "a", " a", "a ", "\t a \n\n b\x0c", "\x85a", "a b"]:
        assert normalise(t.encode()) == norm(t)


def test_groups_equal_brute_force(spark):
    rows = documents()
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    want = []
    for r in rows:
        ids = groups[norm(r[1])]
        keep = min((i for i in ids if i is not None), default=None)
        want.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256(norm(r[1])).digest()))
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in duplicates(frame(spark)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_one_row_of_each_text_stays(spark):
    rows = documents()
    best = {}
    for r in rows:
        k = norm(r[1])
        if k not in best or (r[0] is not None and (best[k][0] is None or r[0] < best[k][0])):
            best[k] = r
    out = without_duplicates(frame(spark))
    assert out.columns == frame(spark).columns
    assert sorted(((r.doc_id, norm(r.text)) for r in out.collect()), key=repr) == sorted(((r[0], k) for k, r in best.items()), key=repr)
    assert without_duplicates(frame(spark, [])).count() == 0 == duplicates(frame(spark, [])).count()


def test_filter_inserts_deletes_and_overflows():
    rnd = random.Random(1)
    keys = [rnd.getrandbits(64) for _ in range(400)]
    f = CuckooFilter(128)
    held = [k for k in keys if f.insert(k)]
    assert len(held) > 380 and all(k in f for k in held)
    for k in held[:200]:
        assert f.delete(k)
    assert all(k in f for k in held[200:]) and sum(k in f for k in held[:200]) < 10
    full = CuckooFilter(2)
    assert not all(full.insert(k) for k in keys[:20])


def test_shard_grows_and_survives_false_positives():
    shard, digest = Shard(), [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, d in enumerate(digest):
        shard.add(d, i, 1)
        shard.add(d, i + 5000, 1)
    assert shard.live == 3000 and shard.filter.buckets * 4 >= 3000
    assert all(shard.find(d) == [i, 2] for i, d in enumerate(digest))
    same = digest[0][:8] + digest[0][8:16] + b"\0" * 16  # same shard, bucket and fingerprint, other text
    assert shard.find(same) is None
    assert shard.remove(digest[0], 1) and shard.find(digest[0]) == [0, 1] and shard.remove(digest[0], 1)
    assert shard.find(digest[0]) is None and not shard.remove(digest[0], 1) and shard.live == 2999


def test_index_over_batches(spark):
    one = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "a  b")], "doc_id long, text string")
    two = spark.createDataFrame([(4, "c"), (5, "d")], "doc_id long, text string")
    index = updated(combined(digests(one), 8))
    assert {(r.doc_id, r.rows) for r in index.collect()} == {(1, 2), (2, 1)}
    assert [(r.doc_id, r.keep_id, r.kept) for r in duplicates(two, updated(combined(digests(one), 8))).orderBy("doc_id").collect()] == [(4, 2, False), (5, 5, True)]
    gone = updated(combined(digests(one.where("doc_id <> 1")), 8, sign=-1), index)
    assert {(r.doc_id, r.rows) for r in gone.collect()} == {(1, 1)}
