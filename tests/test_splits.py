"""Grid files read by byte ranges against whole reads."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from geocadence.sources import grids as GR
from geocadence.sources.splits import Range, _LineReader, _PushedReader, grid_lines, packed_cells, write_packed


@pytest.fixture
def packed(tmp_path):
    rng = np.random.default_rng(5)
    for name, steps in (("a.bin", 3), ("b/c.bin", 2), ("b/_hidden.bin", 1), ("d.txt", 1)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        rng.integers(-50, 50, 7 * 11 * steps).astype("<i4").tofile(tmp_path / name)
    return str(tmp_path)


@pytest.mark.parametrize("range_bytes", [1, 28, 100, 1 << 20])
def test_packed_ranges(spark, packed, range_bytes):
    whole = GR.binary_cells(GR.read_binary_files(spark, [f"{packed}/a.bin", f"{packed}/b/c.bin"]), 7, 11)
    same = lambda df: rows(df.withColumn("path", F.regexp_extract("path", "([^/]+)$", 1)))
    split = packed_cells(spark, packed, 7, 11, glob="*.bin", range_bytes=range_bytes)
    assert same(split) == same(whole)
    assert split.rdd.getNumPartitions() == {1: 55, 28: 55, 100: 19, 1 << 20: 1}[range_bytes]
    for condition in ("step = 1", "col BETWEEN 3 AND 5", "row > 4 AND col < 2", "step IN (1, 2) AND row = 0 AND col >= 9", "step = 9", "col IS NULL"):
        assert same(split.where(condition)) == same(whole.where(condition)), condition


def test_packed_pushdown_reads_less(packed):
    from pyspark.sql.datasource import EqualTo, GreaterThan
    reader = _PushedReader({"path": packed, "glob": "a.bin", "nrows": "7", "ncols": "11", "scale": "10", "range": "28"})
    assert len(reader.partitions()) == 33
    assert len(list(reader.pushFilters([EqualTo(("step",), 2), GreaterThan(("col",), 8)]))) == 2  # Spark applies them again
    ranges = reader.partitions()
    assert len(ranges) == 2 and [len(r.parts) for r in ranges] == [1, 1]
    cells = [c for r in ranges for b in reader.read(r) for c in zip(*(b.column(n).to_pylist() for n in ("step", "col")))]
    assert sorted(set(cells)) == [(2, 9), (2, 10)] and len(cells) == 14


def test_packed_refuses_and_round_trip(spark, packed, tmp_path):
    with pytest.raises(Exception, match="do not fill grids"):
        packed_cells(spark, packed, 5, 13, glob="*.bin").collect()
    with pytest.raises(Exception, match="FileNotFound"):
        packed_cells(spark, packed + "/none", 7, 11).collect()
    assert packed_cells(spark, packed, 7, 11, glob="*.none").count() == 0
    out = str(tmp_path / "out")
    write_packed(spark.createDataFrame([("x/1", bytearray(b"\x01\x00\x00\x00" * 6)), ("x/2", bytearray(b"\xff\xff\xff\xff" * 6))], "path string, content binary"), out)
    assert rows(packed_cells(spark, out, 3, 2, 1.0).groupBy(F.substring("path", -1, 1)).agg(F.sum("value"), F.count("value"))) == [("1", 6.0, 6), ("2", -6.0, 6)]


@pytest.fixture
def grids(tmp_path):
    head = "NCOLS 4\nnrows {}\nxllcorner 8.0\nyllcorner 44\ncellsize 0.5\nNODATA_value -9999\n"
    rng = np.random.default_rng(7)
    for name, n, end in (("a.txt", 40, "\n"), ("b.txt", 9, "\r\n"), ("c.txt", 1, "\n")):
        body = [" ".join(str(v) if v > 5 else "-9999" for v in rng.integers(0, 5000, 4)) for _ in range(n)]
        (tmp_path / name).write_bytes((head.format(n) + "\n".join(body) + ("" if name == "b.txt" else "\n\n")).replace("\n", end).encode())
    return str(tmp_path)


@pytest.mark.parametrize("range_bytes", [30, 113, 1000, 1 << 20])
def test_text_ranges(spark, grids, range_bytes):
    whole = GR.ascii_cells(GR.read_ascii_files(spark, f"{grids}/*.txt"))
    same = lambda df: rows(df.withColumn("path", F.regexp_extract("path", "([^/]+)$", 1)))
    assert same(GR.split_ascii_cells(spark, grids, "*.txt", range_bytes)) == same(whole)
    lines, _ = grid_lines(spark, grids, "*.txt", range_bytes)
    assert lines.count() == 50


def test_ranges_share_no_line(grids):
    """Every line is in exactly one range, whatever the cut."""
    whole = [line.strip() for line in open(f"{grids}/a.txt", "rb")]
    size = len(open(f"{grids}/a.txt", "rb").read())
    reader = _LineReader({"path": grids})
    for step in (1, 2, 3, 17, 64, size - 1, size):
        parts = [Range(f"{grids}/a.txt", b, min(b + step, size)) for b in range(0, size, step)]
        assert [line for p in parts for line in reader._lines(p)] == whole, step
