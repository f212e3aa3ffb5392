"""The pipeline stage by stage against brute force on what each stage was given, and the queries against their SQL."""

import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from geocadence.catalog.compare import compare, connect
from geocadence.llm import toxicity
from geocadence.llm.queries import LLM_ORACLES, LLM_QUERIES, held_out
from test_jaccard import brute as similar
from test_mixing import filled, words
from test_packing import pieces, whole  # noqa: F401

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The documents, what each stage made of them, and the result of run()."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_columns(tables):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_duplicates", "source_mixing", "packing"]
    assert all(t.columns == COLUMNS and t.dtypes == tables[0].dtypes for t in tables[:-1])


def test_toxic_documents_go(spark, tables):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~held_out(3, 1))
    scores = toxicity.scored(tables[0], toxicity.trained(tables[0], labels))
    keep = {r.doc_id for r in scores.where("score < 0.7").collect()}
    assert Counter(rows(tables[1])) == Counter(r for r in rows(tables[0]) if r[0] in keep) and 0.8 < len(keep) / tables[0].count() < 1


def test_one_of_equal_texts_stays(tables):
    best = {}
    for r in rows(tables[1]):
        k = re.sub(r"[\x20\x09-\x0d]+", " ", r[1] or "")
        best[k] = min(best.get(k, r), r, key=lambda x: x[0])
    assert Counter(rows(tables[2])) == Counter(best.values())


def test_one_of_similar_texts_stays(tables):
    given = rows(tables[2])
    keep = {i for i, n, c in similar(given, 80, 5) if i == c or not n}
    assert Counter(rows(tables[3])) == Counter(r for r in given if r[0] in keep)


def test_sources_meet_their_targets(tables):
    given, sizes, got = {r[0]: r for r in rows(tables[3])}, Counter(), Counter()
    for r in given.values():
        sizes[r[3]] += len(words(r[1]))
    times = Counter()
    for r in rows(tables[4]):
        own = given[r[0]]
        got[r[3]] += len(words(r[1]))
        times[r[0]] += 1
        assert r[2:4] == own[2:4] and r[4] == len(r[1]) and (r[1] == own[1] or set(words(r[1])) <= set(words(own[1])))
    assert all(abs(got[s] - t) <= 1 for s, t in filled(sizes).items()) and max(times.values()) <= 3


def test_every_piece_is_packed(tables, whole):  # noqa: F811
    got = tables[5].collect()
    want = pieces(rows(tables[4]), whole, 2048)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    used = defaultdict(int)
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048


def test_run_gives_what_the_stages_give(spark, tables):
    some = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).select(*some).collect())) == Counter(map(tuple, tables[5].select(*some).collect()))


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_queries_return_their_columns(spark, name):
    ok, message = compare(spark, connect(SF), name, LLM_QUERIES[name], LLM_ORACLES.get(name), SF)
    assert ok, message
    have = LLM_QUERIES[name](spark, SF).dtypes
    want = {
        "op1": "doc_id held_out score predicted", "op3": "doc_id size source_size target taken", "op4": "doc_id keep_id group_size kept text_sha256",
        "op5": "doc_id held_out n_tokens n_known train_tokens base_score score", "op6": "doc_id piece start length ids_crc32 sequence_id offset",
        "op7": "doc_id n_shingles component_id", "op8": "query_id rank vec_id score", "op10": "doc_id held_out score predicted",
    }.get(name.split("_")[0], "").split()
    kinds = {"held_out": "boolean", "kept": "boolean", "score": "double", "base_score": "double", "target": "double", "predicted": "int", "rank": "int", "piece": "int", "text_sha256": "string"}
    assert [c for c, _ in have[:len(want)]] == want and all(kinds.get(c, "bigint") == t for c, t in have[:len(want)])


def test_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries()) and set(LLM_ORACLES) <= set(entry.oracle_sql())
