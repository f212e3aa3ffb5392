"""Versioned tables: merges of parts, repeated steps, readers and clean-up."""

import os

import pytest
from pyspark.sql import functions as F

from geocadence.sources.versions import Versions, merge
from geocadence.streaming import jobs as J


def put(spark, path, rows, step, writer="w"):
    df = spark.createDataFrame(rows, "day string, k int, run int, v string")
    merge(Versions(spark, path), df, F.col("day"), ["day", "k"], ["run"], writer, step)


def table(spark, path):
    return sorted((tuple(r) for r in Versions(spark, path).read().collect()), key=repr)


def folders(path):
    return {os.path.join(os.path.basename(d), n) for d, names, _ in os.walk(path) for n in names if n.startswith("_part=")}


def test_only_touched_parts_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    assert Versions(spark, path).read() is None
    put(spark, path, [("d1", 1, 1, "a"), ("d1", 2, 1, "b"), ("d 2/é", 1, 1, "c"), (None, 1, 1, "n")], 0)
    first = Versions(spark, path).manifest()["parts"]
    put(spark, path, [("d1", 1, 2, "A"), ("d1", 2, 0, "old"), ("d3", 1, 1, "d")], 1)
    assert table(spark, path) == sorted([("d1", 1, 2, "A"), ("d1", 2, 1, "b"), ("d 2/é", 1, 1, "c"), (None, 1, 1, "n"), ("d3", 1, 1, "d")], key=repr)
    second = Versions(spark, path).manifest()["parts"]
    assert set(first) == {"d1", "d 2/é", "none"} and {p for p in first if second[p] == first[p]} == {"d 2/é", "none"}
    read = Versions(spark, path).read(["d1"])
    assert read.count() == 2 and all("d1" in f for f in read.inputFiles())


def test_a_repeated_step_changes_nothing_and_another_writer_counts_for_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("d1", 1, 1, "a")], 0)
    put(spark, path, [("d1", 1, 9, "again")], 0)
    assert table(spark, path) == [("d1", 1, 1, "a")]
    put(spark, path, [("d1", 1, 9, "other")], 0, "second")
    assert table(spark, path) == [("d1", 1, 9, "other")]


def test_folders_stay_bounded_and_a_broken_change_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    for step in range(6):
        put(spark, path, [("d1", 1, step, f"v{step}"), (f"own{step % 2}", 1, step, "x")], step)
    assert len(folders(path)) <= 2 * 3 and len(Versions(spark, path).numbers()) == 2
    before = table(spark, path)
    spark.createDataFrame([(1,)], "k int").write.parquet(f"{path}/v-unfinished")  # a writer that was lost before its manifest
    (tmp_path / "t" / "_manifests" / ".half").write_text("{")
    assert table(spark, path) == before
    put(spark, path, [("d1", 1, 99, "last")], 6)
    assert ("d1", 1, 99, "last") in table(spark, path) and not os.path.exists(f"{path}/v-unfinished")


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(spark, path, [("d1", 1, 1, "a")], 0)
    monkeypatch.setattr(Versions, "numbers", lambda self: [])  # looked before the other one was done
    monkeypatch.setattr(Versions, "manifest", lambda self, number=None: {"parts": {}, "steps": {}, "schema": None})
    with pytest.raises(RuntimeError):
        put(spark, path, [("d1", 1, 2, "b")], 1)


def test_no_rows_and_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [], 0)
    assert Versions(spark, path).read() is None
    with pytest.raises(FileNotFoundError):
        J.read_newest_rows(spark, path)
    assert J.read_newest_rows(spark, path, "k int").count() == 0
