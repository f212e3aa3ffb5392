"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", name: str = "geocadence", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench. A cluster job brings its own session."""
    return (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .config("spark.driver.memory", os.environ.get("GEOCADENCE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


_own: dict[str, str] = {}  # the folder of this process that stands in for a shared one


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only on a one-process master (tests, a laptop) may the setting be missing; a folder of this process stands in for it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if "root" not in _own:
        _own["root"] = tempfile.mkdtemp(prefix="geocadence-")
    return _own["root"]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name below the shared folder; nothing is created here."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a stage result to the shared folder and reads it back.

    For small tables that several later steps use: the plan is cut there, and a lost executor costs a
    re-read instead of a recomputation.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` returned, once all that reads them is itself stored: the shared folder holds only what is needed."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
