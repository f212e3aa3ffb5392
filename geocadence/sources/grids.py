"""Gridded readings: partitioned cell tables, ASCII grids, packed binary grids."""

from __future__ import annotations

import datetime
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from geocadence.functions.cells import missing_to_null
from geocadence.sources.splits import RANGE, grid_lines


# --- S11: layout and log of tiles -----------------------------------------------------------------
TILE = 16  # rows and columns of a tile
LOG = "_tiles"  # readers of the cells do not see folders whose names begin with _


def _spread(c: Column) -> Column:
    """The lower 16 bits of a number, a zero between any two of them."""
    for shift, keep in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = F.shiftleft(c, shift).bitwiseOR(c).bitwiseAND(F.lit(keep).cast("bigint"))
    return c


def tile_code(row: Column, col: Column) -> Column:
    """Z-order code of a cell's tile: the bits of tile row and tile column by turns, so near tiles mostly have near codes."""
    part = lambda c: _spread(F.floor(c / TILE).cast("bigint").bitwiseAND(F.lit(0xFFFF).cast("bigint")))
    return F.shiftleft(part(row), 1).bitwiseOR(part(col))


def write_cells(df: DataFrame, path: str, mask: DataFrame | None = None, time: str = "time", rows_per_file: int = 4_000_000) -> None:
    """S11. Cells by date; with a mask the region layer is stored beside the value.

    Rows are ranged by date and tile along a Z-order curve: a file holds neighbouring tiles, a hot date is written by many tasks, and
    adaptive execution joins small ranges, so the number of files follows the data. No file has more than ``rows_per_file``
    rows. Afterwards the log of tiles is written for the dates touched: per file and tile its rows and its steps.
    """
    if mask is not None:
        df = df.join(mask.select("row", "col", F.col("mask").alias("region_mask")), ["row", "col"], "left")
    order = ["date", "_tile", "row", "col", time]
    dated = df.withColumns({"date": F.col(time).cast("date"), "_tile": tile_code(F.col("row"), F.col("col"))})
    touched = Observation()
    laid = dated.repartitionByRange(*order).observe(touched, F.min("date").alias("first"), F.max("date").alias("last"))
    (laid.sortWithinPartitions(*order).drop("_tile").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", rows_per_file).partitionBy("date").parquet(path))
    dates = touched.get
    if dates.get("first") is not None:
        _log_tiles(df.sparkSession, path, dates["first"], dates["last"], time)


def _log_tiles(spark: SparkSession, path: str, first, last, time: str) -> None:
    """Writes the log of the dates in [first, last] whose files are not those of the log; only their times and positions are read."""
    _, stale = _logged_files(spark, path, first, last)
    if not stale:
        return
    cells = spark.read.parquet(path).filter(F.col("date").isin(sorted(stale)))
    log = cells.groupBy("date", F.col("_metadata.file_name").alias("file"), tile_code(F.col("row"), F.col("col")).alias("tile")).agg(
        F.count(F.lit(1)).alias("n"), F.collect_set(time).alias("steps"))  # a day has as many steps as its calendar
    log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{path.rstrip('/')}/{LOG}")


def _listed(spark: SparkSession, path: str, first, last) -> dict:
    """{date: names of its files} of the table's folders in [first, last]."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for folder in fs.listStatus(at):
        name = folder.getPath().getName()
        if name.startswith("date=") and name[5:9].isdigit() and first <= (day := datetime.date.fromisoformat(name[5:])) <= last:
            found[day] = {f for s in fs.listStatus(folder.getPath()) if (f := s.getPath().getName())[0] not in "._"}
    return found


def _read_log(spark: SparkSession, path: str, first, last) -> DataFrame | None:
    at = f"{path.rstrip('/')}/{LOG}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(at)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.parquet(at).filter(F.col("date").between(F.lit(first), F.lit(last)))


def _logged_files(spark: SparkSession, path: str, first, last) -> tuple[dict, set]:
    """The listed files by date, and the dates whose log names other files than the folder has (a write that did not end, or none)."""
    listed, log = _listed(spark, path, first, last), _read_log(spark, path, first, last)
    named: dict = {}
    for day, file in () if log is None else log.select("date", "file").distinct().collect():  # the names a scan would list
        named.setdefault(day, set()).add(file)
    return listed, {day for day, files in listed.items() if files != named.get(day, set())}


def _bounds(spark: SparkSession, start: Column, end: Column):
    return spark.sql("SELECT 1").select(start.alias("a"), end.alias("b")).first()


def written_steps(spark: SparkSession, path: str, start: Column, end: Column, time: str = "time") -> DataFrame:
    """S5b. Distinct times of [start, end] that the table holds, from its log of tiles.

    Cells are read of those dates only whose log is missing or not that of their files.
    """
    a, b = _bounds(spark, start, end)
    _, stale = _logged_files(spark, path, a.date(), b.date())
    log = _read_log(spark, path, a.date(), b.date())
    parts = []
    if log is not None:
        good = log.filter(~F.col("date").isin(sorted(stale))) if stale else log
        parts.append(good.select(F.explode("steps").alias(time)))
    if stale or not parts:
        parts.append(spark.read.parquet(path).filter(F.col("date").isin(sorted(stale))).select(time))
    return reduce(DataFrame.unionByName, parts).filter(F.col(time).between(start, end)).distinct()


# --- S5 / S6 -------------------------------------------------------------------------------------
def masked_files(spark: SparkSession, path: str, start: Column, end: Column, mask: DataFrame) -> list[str] | None:
    """Files of the table that may hold cells of the mask within [start, end]; None where no log says so.

    Dates whose log is not that of their files give all their files.
    """
    a, b = _bounds(spark, start, end)
    log = _read_log(spark, path, a.date(), b.date())
    if log is None:
        return None
    listed, stale = _logged_files(spark, path, a.date(), b.date())
    tiles = mask.filter("mask = 1").select(tile_code(F.col("row"), F.col("col")).alias("tile")).distinct()
    inside = (F.array_max("steps") >= start) & (F.array_min("steps") <= end)
    hit = log.filter(inside).join(tiles, "tile", "left_semi").select("date", "file").distinct().collect()  # names of files to scan
    named = [(day, file) for day, file in hit if day in listed and day not in stale]
    named += [(day, file) for day in stale for file in listed[day]]
    return [f"{path.rstrip('/')}/date={day}/{file}" for day, file in sorted(named)]


def scan_cells(spark: SparkSession, paths, start: Column, end: Column, mask: DataFrame | None = None,
               columns: tuple[str, ...] = ("time", "row", "col", "value")) -> DataFrame:
    """Cells of [start, end] from one or several tables partitioned by ``date``.

    The date bounds prune folders, the time bounds reach the scan. A region mask is a semi join; where the table has a log of tiles
    only files with tiles of the mask are opened.
    """
    parts = []
    for path in [paths] if isinstance(paths, str) else list(paths):  # each table has its own partition root
        files = None if mask is None else masked_files(spark, path, start, end, mask)
        whole = spark.read.parquet(path) if not files else spark.read.option("basePath", path).parquet(*files)
        parts.append(whole.filter(F.lit(False)) if files == [] else whole)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    df = df.filter(F.col("date").between(start.cast("date"), end.cast("date"))).filter(F.col("time").between(start, end))
    df = df.select(*columns)
    if mask is not None:
        df = df.join(mask.filter("mask = 1").select("row", "col"), ["row", "col"], "left_semi")
    return df.withColumn("value", missing_to_null(F.col("value")))


# --- S5b -----------------------------------------------------------------------------------------
def step_policy(spine: DataFrame, df: DataFrame, keys: list[str], policy: str) -> DataFrame:
    """Completeness of each group against its expected steps.

    ``fail``: any missing step, or a group with a single step, stops the query. ``skip``: missing steps
    are tolerated and a group with a single step gives no row.
    """
    steps = [*keys, "time"]
    got = df.select(*steps).distinct().withColumn("_hit", F.lit(1))
    c = spine.select(*steps).distinct().join(got, steps, "left").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("expected"), F.count("_hit").alias("present"))
    c = c.withColumn("missing", F.col("expected") - F.col("present"))
    if policy == "fail":
        bad = (F.col("missing") > 0) | (F.col("present") < 2)
        text = F.concat(F.lit("incomplete steps: "), F.to_json(F.struct(*keys, "expected", "present")))
        return c.withColumn("missing", F.when(bad, F.raise_error(text).cast("bigint")).otherwise(F.col("missing")))
    if policy == "skip":
        return c.filter(F.col("present") > 1)
    raise ValueError('policy must be "fail" or "skip"')


# --- S7 ------------------------------------------------------------------------------------------
def read_ascii_files(spark: SparkSession, path) -> DataFrame:
    """Whole ASCII grid files as (path, text)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _header(name: str) -> Column:
    """A number of the header by its name, in any case."""
    return F.regexp_extract(F.col("text"), rf"(?im)^\s*{name}\s+([-+.\deE]+)", 1).cast("double")


def _headers(keep: tuple[str, ...]) -> list:
    return [*keep, _header("ncols").cast("int").alias("ncols"), _header("nrows").cast("int").alias("nrows"), _header("xllcorner").alias("xll"),
            _header("yllcorner").alias("yll"), _header("cellsize").alias("cellsize"), _header("nodata_value").alias("nodata")]


def _line_cells(lines: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Cells of lines (row, _line) that carry their grid's header."""
    res, v = F.col("cellsize"), F.col("_v").cast("double")
    return lines.select("*", F.posexplode(F.split("_line", r"\s+")).alias("col", "_v")).select(
        *keep, "row", "col",
        (F.col("xll") + res / 2 + F.col("col") * res).alias("lon"),
        (F.col("yll") + res / 2 + (F.col("nrows") - 1 - F.col("row")) * res).alias("lat"),
        F.when(F.col("nodata").isNull() | (v != F.col("nodata")), v).alias("value"))


def ascii_cells(files: DataFrame, keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """Cells of ASCII grids: six header lines, then rows from north to south; the marker becomes NULL."""
    lines = F.filter(F.transform(F.split("text", r"\r?\n"), lambda s: F.trim(s)), lambda s: s.rlike(r"^[-+.\d]"))
    rows = files.select(*_headers(keep), lines.alias("_lines")).select("*", F.posexplode("_lines").alias("row", "_line"))
    return _line_cells(rows, keep)


def split_ascii_cells(spark: SparkSession, path: str, glob: str = "*", range_bytes: int = RANGE) -> DataFrame:
    """The cells of ``ascii_cells`` from files of any size: a task per range of bytes.

    A first pass counts the rows that begin in each range; their running sum per file numbers the lines of the second.
    """
    lines, ranges = grid_lines(spark, path, glob, range_bytes)
    file = Window.partitionBy("path")
    before = F.coalesce(F.sum("n").over(file.orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = F.array_sort(F.collect_list(F.when(F.col("header").isNotNull(), F.struct("begin", "header"))).over(file))
    text = F.array_join(F.transform(heads, lambda h: h["header"]), "\n")
    numbered = ranges.select("path", "begin", before.alias("_before"), text.alias("text")).select(
        *_headers(("path", "begin", "_before")))
    rows = lines.withColumnRenamed("text", "_line").join(numbered, ["path", "begin"]).withColumn(
        "row", (F.col("_before") + F.col("line")).cast("int"))
    return _line_cells(rows, ("path",))


# --- S8 ------------------------------------------------------------------------------------------
def read_binary_files(spark: SparkSession, path, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")


def binary_cells(files: DataFrame, nrows: int, ncols: int, scale: float = 10.0, no_data: float | None = None) -> DataFrame:
    """Cells of packed int32 grids stored column by column, divided by the scale factor.

    ``files`` has (path, content). A file must hold a whole number of grids; ``step`` counts them.
    """
    size = nrows * ncols

    def unpack(batches):
        import pandas as pd
        cell = np.arange(size)
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                flat = np.frombuffer(content, dtype="<i4")
                if len(flat) % size or not len(flat):
                    raise ValueError(f"{path}: {len(flat)} values do not fill grids of {nrows}x{ncols}")
                for step in range(len(flat) // size):
                    yield pd.DataFrame({
                        "path": path, "step": step, "row": cell % nrows, "col": cell // nrows,
                        "value": flat[step * size:(step + 1) * size] / scale})

    out = files.select("path", "content").mapInPandas(unpack, "path string, step int, row int, col int, value double")
    return out if no_data is None else out.withColumn("value", missing_to_null(F.col("value"), no_data))
