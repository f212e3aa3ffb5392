"""Tables of one folder per part and version, with a manifest that names the folders that count.

A change writes new folders for the parts it touches and then one manifest file, under a hidden name first and renamed when it is
whole. Readers take the newest manifest, so they see all of a change or nothing of it. The manifest also remembers the last step of
every writer, so a step that is run again changes nothing. The two newest manifests and the folders they name are kept; others are
deleted after a change. One writer at a time: a second one finds its version taken and fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT = 2
_PART = "_part"


class Versions:
    """The versions below ``path``, on any store that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("_manifests") if n.endswith(".json") and n[0] not in "._"]

    def manifest(self, number: int | None = None) -> dict:
        """{"parts": {part: folder}, "steps": {writer: step}, "schema": ...}; empty before the first change."""
        numbers = self.numbers()
        if not numbers:
            return {"parts": {}, "steps": {}, "schema": None}
        at = self._at(f"_manifests/{numbers[-1] if number is None else number:020d}.json")
        stream = self._fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, parts: list[str] | None = None) -> DataFrame | None:
        """The rows of the newest version, or of some of its parts; None before the first change."""
        found = self.manifest()
        if found["schema"] is None:
            return None
        schema = T.StructType.fromJson(found["schema"])
        folders = [f"{self.path}/{f}" for p, f in found["parts"].items() if parts is None or p in parts]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def done(self, writer: str, step: int) -> bool:
        return self.manifest()["steps"].get(writer, -1) >= step

    def replace(self, df: DataFrame, part: str, writer: str, step: int, gone: tuple[str, ...] = ()) -> None:
        """Makes the rows of ``df`` the parts that its column ``part`` (STRING, not null) names; other parts stay.

        Parts in ``gone`` end with this version unless ``df`` has rows of them.
        """
        old, numbers = self.manifest(), self.numbers()
        folder = f"v-{uuid.uuid4().hex[:12]}"
        columns = [c for c in df.columns if c != part]
        # rows of a part stand together; a large part is split between tasks
        df.withColumnRenamed(part, _PART).hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{self.path}/{folder}")
        new = {self.spark._jvm.java.net.URLDecoder.decode(n.split("=", 1)[1], "UTF-8"): f"{folder}/{n}" for n in self._names(folder) if n.startswith(f"{_PART}=")}
        kept = {p: f for p, f in old["parts"].items() if p not in gone}
        found = {"parts": kept | new, "steps": old["steps"] | {writer: step}, "schema": json.loads(df.select(*columns).schema.json())}
        self._commit((numbers[-1] if numbers else 0) + 1, found)
        self._clean()

    def _commit(self, number: int, found: dict) -> None:
        hidden, final = self._at(f"_manifests/.{uuid.uuid4().hex}"), self._at(f"_manifests/{number:020d}.json")
        out = self._fs.create(hidden, True)
        out.write(bytearray(json.dumps(found).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(hidden, final):
            self._fs.delete(hidden, False)
            raise RuntimeError(f"another writer made version {number} of {self.path}")

    def _clean(self) -> None:
        numbers = self.numbers()
        used = {f for n in numbers[-KEPT:] for f in self.manifest(n)["parts"].values()}
        for n in numbers[:-KEPT]:
            self._fs.delete(self._at(f"_manifests/{n:020d}.json"), False)
        for folder in [n for n in self._names("") if n.startswith("v-")]:
            parts = [n for n in self._names(folder) if n.startswith(f"{_PART}=")]
            gone = [n for n in parts if f"{folder}/{n}" not in used]
            for name in [folder] if len(gone) == len(parts) else [f"{folder}/{n}" for n in gone]:
                self._fs.delete(self._at(name), True)


def merge(versions: Versions, changes: DataFrame, part: Column, keys: list[str], order: list[str], writer: str, step: int) -> None:
    """Adds rows to a table of the newest row per key: only the parts they touch are read and written again.

    ``part``: a STRING expression over the keys, the part a row belongs to (null is a part of its own). Of rows alike in keys the
    largest by ``order`` stays. A step that ``writer`` has done before changes nothing.
    """
    if versions.done(writer, step):
        return
    name = F.coalesce(part, F.lit("none"))
    touched = [r[0] for r in changes.select(name).distinct().collect()]  # the parts of one delivery
    if not touched:
        return
    before = versions.read(touched)
    rows = changes if before is None else changes.unionByName(before.select(*changes.columns))
    rest = [c for c in changes.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")
    versions.replace(newest.withColumn("_of", name), "_of", writer, step)
