"""Run summaries and file inventories."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


# --- S13 -----------------------------------------------------------------------------------------
def read_json_documents(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def parse_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """JSON texts to VARIANT. A bad text is tried again from its first ``{`` to its last ``}``.

    Adds ``doc``, ``parsed_strict``, ``parse_error`` and, for the unparsable, the whole text that failed as ``raw_text``.
    """
    t = F.col(text)
    sliced = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    strict = F.try_parse_json(t)
    loose = F.when(sliced != "", F.try_parse_json(sliced))
    failed = F.col("doc").isNull()
    return (
        df.withColumns({"_strict": strict, "_loose": loose})
        .withColumn("doc", F.coalesce("_strict", "_loose"))
        .withColumns({
            "parsed_strict": F.col("_strict").isNotNull(),
            "parse_error": F.when(failed & (sliced == ""), F.lit("no_json_braces_found"))
            .when(failed, F.lit("strict and sliced parse failed")),
            "raw_text": F.when(failed, F.when(sliced != "", sliced).otherwise(t)),
        }).drop("_strict", "_loose")
    )


# --- S14 -----------------------------------------------------------------------------------------
def list_files(spark: SparkSession, path, glob: str = "*", recursive: bool = True) -> DataFrame:
    """File inventory (path, modificationTime, length); the contents are never read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower()).load(path)
        .select("path", "modificationTime", "length")
    )


def find_one(files: DataFrame, pattern: str, path: str = "path") -> str | None:
    """S14b. The one path whose name matches a wildcard; none warns and gives None, several is an error."""
    hits = match_names(files, pattern, path).select(path).distinct().limit(2).collect()
    if not hits:
        log.warning("no file matches %s", pattern)
        return None
    if len(hits) > 1:
        raise ValueError(f"several files match {pattern!r}")
    return hits[0][0]


def find_each(groups: DataFrame, files: DataFrame, pattern: str, keys: list[str], path: str = "path") -> DataFrame:
    """S14b for many groups at once: the path of each group whose name matches, with ``found`` none, one or several.

    Only one match is a path; a path listed twice is one.
    """
    hits = match_names(files, pattern, path).groupBy(*keys).agg(F.min(path).alias(path), F.max(path).alias("_last"))
    several = F.col(path) != F.col("_last")
    return groups.join(hits, keys, "left").withColumn("found", F.when(F.col(path).isNull(), "none").when(several, "several").otherwise("one")).withColumn(
        path, F.when(F.col("found") == "one", F.col(path))).drop("_last")


def match_names(files: DataFrame, pattern: str, path: str = "path") -> DataFrame:
    """Paths whose name matches a ``*``/``?`` wildcard."""
    import re
    regex = "^" + "".join(".*" if ch == "*" else "." if ch == "?" else re.escape(ch) for ch in pattern) + "$"
    return files.filter(F.element_at(F.split(path, "/"), -1).rlike(regex))
