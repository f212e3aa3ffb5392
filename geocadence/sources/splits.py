"""Grid files read by byte ranges, a task for each: a large file is many tasks in bounded memory.

Paths are local, mounted or URIs that Arrow's file systems open (file, hdfs, s3, gs). A range holds what begins inside it, so
ranges depend on the file alone, never on the cluster.
"""

from __future__ import annotations

import fnmatch
import io
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
    WriterCommitMessage)

RANGE = 32 << 20  # bytes of a task
PIECE = 1 << 17  # values of an Arrow batch
TEXT_PIECE = 1 << 20  # bytes of lines of an Arrow batch
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _opened(path: str):
    """File system, path within it, and what to put before such a path to get its URI."""
    local = re.fullmatch(r"(?:file:)?/*(/.*)", path)
    if local:
        return fs.LocalFileSystem(), local[1], "file://"
    system, root = fs.FileSystem.from_uri(path)
    return system, root, path[:-len(root)] if path.endswith(root) else ""


def _files(path: str, glob: str):
    """URIs and sizes of the files at or below ``path`` whose name matches; hidden names are left out."""
    system, root, prefix = _opened(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
    for i in sorted(found, key=lambda i: i.path):
        below = i.path[len(root):].split("/")
        if i.type == fs.FileType.File and fnmatch.fnmatch(i.base_name, glob) and not any(p[:1] in ("_", ".") for p in below):
            yield prefix + i.path, i.size


@dataclass
class Range:
    path: str
    first: int
    last: int  # excluded


@dataclass
class Ranges(InputPartition):
    parts: list


def _tasks(ranges, unit: int, limit: int) -> list[Ranges]:
    """Ranges of small files together in a task, up to ``limit`` bytes; ``unit`` is the size of what a range counts."""
    out, size = [], limit
    for r in ranges:
        n = (r.last - r.first) * unit
        if size + n > limit:
            out.append(Ranges([]))
            size = 0
        out[-1].parts.append(r)
        size += n
    return out or [Ranges([])]


# --- S8: packed grids -----------------------------------------------------------------------------
class PackedGrid(DataSource):
    """Little-endian int32 grids stored column by column, one after the other; written from rows (path, content)."""

    @classmethod
    def name(cls):
        return "packed_grid"

    def schema(self):
        return "path string, step int, row int, col int, value double"

    def reader(self, schema):
        return (_PushedReader if self.options.get("pushdown") == "true" else _PackedReader)(self.options)

    def writer(self, schema, overwrite):
        return _FileWriter(self.options["path"])


class _PackedReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.nrows, self.ncols, self.scale = int(options["nrows"]), int(options["ncols"]), float(options["scale"])
        self.range = int(options.get("range", RANGE))
        self.low, self.high = {"step": 0, "row": 0, "col": 0}, {"step": 2**31 - 1, "row": self.nrows - 1, "col": self.ncols - 1}

    def partitions(self):
        """Ranges of wanted columns: those of the wanted steps and columns, counted through the file."""
        column, wide = 4 * self.nrows, self.high["col"] - self.low["col"] + 1
        per = max(1, self.range // column)
        out = []
        for path, size in _files(self.path, self.glob):
            if not size or size % (column * self.ncols):
                raise ValueError(f"{path}: {size} bytes do not fill grids of {self.nrows}x{self.ncols}")
            steps = min(size // (column * self.ncols) - 1, self.high["step"]) - self.low["step"] + 1
            out += [Range(path, k, min(k + per, steps * wide)) for k in range(0, max(steps, 0) * max(wide, 0), per)]
        return _tasks(out, column, max(self.range, column))

    def read(self, partition):
        for part in partition.parts:
            yield from self._cells(part)

    def _cells(self, partition):
        system, root, _ = _opened(partition.path)
        wide = self.high["col"] - self.low["col"] + 1
        grid = self.nrows * self.ncols
        with system.open_input_file(root) as f:
            k = partition.first
            while k < partition.last:
                step, col = self.low["step"] + k // wide, self.low["col"] + k % wide
                run = partition.last - k if wide == self.ncols else min(partition.last - k, wide - k % wide)
                start = step * grid + col * self.nrows
                for e in range(start, start + run * self.nrows, PIECE):
                    n = min(PIECE, start + run * self.nrows - e)
                    raw = f.read_at(4 * n, 4 * e)
                    if len(raw) != 4 * n:
                        raise ValueError(f"{partition.path}: shorter than when it was listed")
                    yield self._batch(partition.path, e, np.frombuffer(raw, "<i4"))
                k += run

    def _batch(self, path: str, e: int, values: np.ndarray) -> pa.RecordBatch:
        at = np.arange(e, e + len(values), dtype=np.int64)
        row = at % self.nrows
        if self.low["row"] > 0 or self.high["row"] < self.nrows - 1:
            keep = (row >= self.low["row"]) & (row <= self.high["row"])
            at, row, values = at[keep], row[keep], values[keep]
        column = at // self.nrows
        return pa.RecordBatch.from_arrays([
            pa.array([path]).take(pa.array(np.zeros(len(at), np.int32))), pa.array((column // self.ncols).astype(np.int32)),
            pa.array(row.astype(np.int32)), pa.array((column % self.ncols).astype(np.int32)), pa.array(values / self.scale)],
            names=["path", "step", "row", "col", "value"])


class _PushedReader(_PackedReader):
    """Bounds on step, row and col narrow the bytes that are read; Spark still applies every filter itself."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In)) and f.attribute[0] in self.low:
                self._narrow(f.attribute[0], f)
            yield f

    def _narrow(self, name, f):
        values = list(f.value) if isinstance(f, In) else [f.value]
        if not values or not all(isinstance(v, int) for v in values):
            return
        if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual)):
            self.low[name] = max(self.low[name], min(values) + isinstance(f, GreaterThan))
        if isinstance(f, (EqualTo, In, LessThan, LessThanOrEqual)):
            self.high[name] = min(self.high[name], max(values) - isinstance(f, LessThan))


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _FileWriter(DataSourceWriter):
    """A file per row (path below the folder, content); files get their names when all tasks are done."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, rows):
        system, root, _ = _opened(self.folder)
        done = []
        for r in rows:
            name = f"{root}/{r['path']}"
            part = f"{name.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
            system.create_dir(name.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(part) as f:
                f.write(bytes(r["content"]))
            done.append((part, name))
        return _Written(done)

    def commit(self, messages):
        system, _, _ = _opened(self.folder)
        for part, name in (f for m in messages if m for f in m.files):
            system.move(part, name)

    def abort(self, messages):
        system, _, _ = _opened(self.folder)
        for part, _ in (f for m in messages if m for f in m.files):
            system.delete_file(part)


def packed_cells(spark: SparkSession, path: str, nrows: int, ncols: int, scale: float = 10.0, glob: str = "*", range_bytes: int = RANGE) -> DataFrame:
    """Cells (path, step, row, col, value) of packed grids, a task per range of columns.

    Where ``spark.sql.python.filterPushdown.enabled`` is on, filters on step, row and col narrow the bytes read. A file that
    is empty or no whole number of grids is an error.
    """
    spark.dataSource.register(PackedGrid)
    pushdown = spark.conf.get(PUSHDOWN, "false").lower()
    return spark.read.format("packed_grid").options(
        nrows=nrows, ncols=ncols, scale=scale, glob=glob, range=range_bytes, pushdown=pushdown).load(path)


def write_packed(files: DataFrame, path: str) -> None:
    """Writes rows (path, content) as files below ``path``; ``path`` is relative and unique."""
    files.sparkSession.dataSource.register(PackedGrid)
    files.select("path", "content").write.format("packed_grid").mode("append").save(path)


# --- S7: text grids -------------------------------------------------------------------------------
class GridLines(DataSource):
    """Lines of text grids by byte range, or (``what`` = ranges) how many rows and which header lines begin in each range."""

    @classmethod
    def name(cls):
        return "grid_lines"

    def schema(self):
        counts = self.options.get("what") == "ranges"
        return "path string, begin bigint, n bigint, header string" if counts else "path string, begin bigint, line bigint, text string"

    def reader(self, schema):
        return _LineReader(self.options)


class _LineReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.range, self.counts = int(options.get("range", RANGE)), options.get("what") == "ranges"

    def partitions(self):
        return _tasks((Range(path, b, min(b + self.range, size)) for path, size in _files(self.path, self.glob)
                       for b in range(0, size, self.range)), 1, self.range)

    def _lines(self, partition):
        """Lines that begin in the range; a line cut by its start belongs to the range before."""
        system, root, _ = _opened(partition.path)
        with io.BufferedReader(system.open_input_file(root), TEXT_PIECE) as f:
            at = partition.first
            if at:
                f.seek(at - 1)
                at += len(f.readline()) - 1
            while at < partition.last:
                line = f.readline()
                if not line:
                    break
                at += len(line)
                yield line.strip()

    def read(self, partition):
        for part in partition.parts:
            yield from self._rows(part)

    def _rows(self, partition):
        row, lines, size, header = 0, [], 0, []
        for line in self._lines(partition):
            if not line:
                continue
            if line[:1] not in b"+-.0123456789":
                header.append(line)
                continue
            if not self.counts:
                lines.append(line)
                size += len(line)
                if size >= TEXT_PIECE:
                    yield self._batch(partition, row + 1 - len(lines), lines)
                    lines, size = [], 0
            row += 1
        if self.counts:
            yield pa.RecordBatch.from_pydict({
                "path": [partition.path], "begin": pa.array([partition.first], pa.int64()), "n": pa.array([row], pa.int64()),
                "header": pa.array([b"\n".join(header).decode() if header else None], pa.string())})
        elif lines:
            yield self._batch(partition, row - len(lines), lines)

    def _batch(self, partition, first: int, lines: list) -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_pydict({
            "path": [partition.path] * n, "begin": pa.array([partition.first] * n, pa.int64()),
            "line": pa.array(range(first, first + n), pa.int64()), "text": [line.decode() for line in lines]})


def grid_lines(spark: SparkSession, path: str, glob: str = "*", range_bytes: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """Lines (path, begin, line, text) of text grids, and (path, begin, n, header) of their ranges."""
    spark.dataSource.register(GridLines)
    read = spark.read.format("grid_lines").options(glob=glob, range=range_bytes)
    return read.load(path), read.option("what", "ranges").load(path)
