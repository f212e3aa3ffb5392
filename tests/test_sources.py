"""Readers and writers on real files."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from geocadence.sources import grids as GR
from geocadence.sources import runs as RU
from geocadence.sources import tables as TB


def test_catalogue_in_latin(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_bytes("id_frana;data;lon;comune\n7;31/12/2023;8,5;Forlì\n".encode("latin-1"))
    out = TB.read_delimited(spark, str(p), "id_frana string, data string, lon string, comune string", {"id": "id_frana", "town": "comune", "lat": "lat", "lon": None})
    assert rows(out) == [("7", "Forlì")]
    more = TB.read_delimited(spark, str(p), "id_frana long, lon double, absent int", {"id": "id_frana", "x": "lon", "y": "absent", "town": "comune"})
    assert rows(more) == [(7, None, "Forlì")] and more.columns == ["id", "x", "town"]  # an unreadable number is NULL


def test_prefixes(spark, tmp_path):
    assert TB.prefixed_fields({"time": "t", ":": "p", "rain_x": "x", "{:}_y": "y", "junk": None}, "rain") == {
        "time": "t", "rain_p": "p", "rain_x": "x", "rain_y": "y", "junk": None}
    with pytest.raises(ValueError):
        TB.prefixed_fields({"time": "t", "peak": "p"}, "rain")
    with pytest.raises(ValueError):
        TB.check_prefixes(["time", "wind"], ("rain",))
    with pytest.raises(ValueError):
        TB.check_prefixes(["rain_a"], ("rain",))
    p = tmp_path / "e.csv"
    p.write_text("time;a\n")
    assert TB.read_indicator_rows(spark, str(p), "time string, a double", {"time": "time", ":": "a"}, "rain") is None


def test_csv_sink_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    d = spark.createDataFrame([("a", "t1", 1.005), ("b", "t1", None)], "area string, time string, v double")
    TB.write_csv(d, path, ["area"])
    TB.write_csv(d.filter("area = 'a'").withColumn("v", F.lit(2.0)), path, ["area"], decimals=3)
    back = spark.read.schema("time string, v string, area string").csv(path, sep=";", header=True)
    assert rows(back, "area", "v") == [("a", "2.000"), ("b", None)]


def test_ascii_grid(spark, tmp_path):
    (tmp_path / "g.txt").write_text("NCOLS 3\nNROWS 2\nXLLCORNER 8.0\nYLLCORNER 44\nCELLSIZE 0.5\nNODATA_VALUE -9999\n1 2 -9999\n 4.5 -5 6e1\n")
    out = GR.ascii_cells(GR.read_ascii_files(spark, str(tmp_path / "g.txt")))
    assert rows(out, "row", "col", "lon", "lat", "value") == [
        (0, 0, 8.25, 44.75, 1.0), (0, 1, 8.75, 44.75, 2.0), (0, 2, 9.25, 44.75, None),
        (1, 0, 8.25, 44.25, 4.5), (1, 1, 8.75, 44.25, -5.0), (1, 2, 9.25, 44.25, 60.0)]


def test_binary_grid(spark, tmp_path):
    grid = np.arange(24).reshape(2, 3, 4)  # two steps of 3 x 4
    (tmp_path / "g.bin").write_bytes(b"".join(g.astype("<i4").tobytes(order="F") for g in grid))
    out = GR.binary_cells(GR.read_binary_files(spark, str(tmp_path), "*.bin"), 3, 4, 10.0, no_data=2.3)
    got = {(r["step"], r["row"], r["col"]): r["value"] for r in out.collect()}
    assert all(got[s, r, c] == (None if grid[s, r, c] == 23 else grid[s, r, c] / 10) for s in range(2) for r in range(3) for c in range(4))
    (tmp_path / "g.bad").write_bytes(b"\0" * 20)
    with pytest.raises(Exception):
        GR.binary_cells(GR.read_binary_files(spark, str(tmp_path), "*.bad"), 3, 4).collect()


def test_robust_json(spark, tmp_path):
    for name, txt in {"a.json": json.dumps({"run": "1400", "n": {"x": 1}}, indent=1), "b.json": 'noise {"run": "1500"} tail', "c.json": "{broken", "d.json": ""}.items():
        (tmp_path / name).write_text(txt)
    out = RU.parse_documents(RU.read_json_documents(spark, str(tmp_path)))
    got = {r["path"][-6]: (r["run"], r["parsed_strict"], r["parse_error"] is None) for r in out.select(
        "path", F.try_variant_get("doc", "$.run", "string").alias("run"), "parsed_strict", "parse_error").collect()}
    assert got["a"] == ("1400", True, True) and got["b"] == ("1500", False, True) and got["c"][2] is False


def test_inventory_and_single_file(spark, tmp_path):
    for n in ("a_1.csv", "a_2.csv", "b.csv"):
        (tmp_path / n).write_text("xx")
    files = RU.list_files(spark, str(tmp_path), "*.csv")
    assert files.filter("length = 2").count() == 3
    assert RU.find_one(files, "b.*").endswith("/b.csv") and RU.find_one(files, "z*") is None
    with pytest.raises(ValueError):
        RU.find_one(files, "a_?.csv")


def test_step_policy(spark):
    spine = spark.createDataFrame([(p, t) for p in "xyz" for t in range(3)], "p string, time int")
    data = spark.createDataFrame([("x", 0), ("x", 1), ("x", 2), ("y", 0), ("z", 1), ("z", 2)], "p string, time int")
    assert rows(GR.step_policy(spine, data, ["p"], "skip"), "p", "missing") == [("x", 0), ("z", 1)]
    with pytest.raises(Exception):
        GR.step_policy(spine, data, ["p"], "fail").collect()
    assert GR.step_policy(spine.filter("p = 'x'"), data, ["p"], "fail").count() == 1


def test_training_matrix_pairs_by_stored_number(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,0.1,0.2,5\n0,0.3,0.4,6\n")
    assert rows(TB.read_training(spark, str(tmp_path / "x.csv"), 2)) == [(0, [0.3, 0.4], 6.0), (1, [0.1, 0.2], 5.0)]


def test_one_match_per_group(spark):
    files = spark.createDataFrame([("a", "/d/x_1.csv"), ("a", "/d/x_1.csv"), ("a", "/d/y.csv"), ("b", "/d/x_1.csv"), ("b", "/e/x_2.csv"), ("c", "/d/x.txt")], "g string, path string")
    groups = files.select("g").distinct().union(spark.createDataFrame([("d",)], "g string"))
    out = RU.find_each(groups, files, "x_?.csv", ["g"])
    assert rows(out, "g", "path", "found") == [("a", "/d/x_1.csv", "one"), ("b", None, "several"), ("c", None, "none"), ("d", None, "none")]


def test_a_failed_text_is_kept_whole(spark):
    long = "{" + "x" * 5000 + "}"
    out = RU.parse_documents(spark.createDataFrame([(1, "log " + long), (2, "y" * 3000), (3, "{}"), (4, None)], "id int, text string"))
    assert [(r["id"], r["raw_text"]) for r in out.orderBy("id").collect()] == [(1, long), (2, "y" * 3000), (3, None), (4, None)]
