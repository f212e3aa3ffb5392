"""Delimited tables, keyed look-ups, indicator files, training matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geocadence.functions.geo import once
from geocadence.functions.projection import projection
from geocadence.functions.text import stamp12
from geocadence.operators.project import drop_out_of_range, select_fields


# --- S1 ------------------------------------------------------------------------------------------
def read_delimited(spark: SparkSession, path, schema: T.StructType | str, fields: dict[str, str | None] | None = None,
                   delimiter: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """CSV with header, then only the mapped columns under their new names.

    Columns are found by the names in the header. Those of ``schema`` take its types (what cannot be read is NULL), others stay text;
    columns that the file lacks are left out.
    """
    kinds = {f.name: f.dataType for f in (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields}
    raw = spark.read.csv(path, sep=delimiter, header=True, encoding=encoding)
    df = raw.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in raw.columns])
    return select_fields(df, fields) if fields else df


# --- S2 ------------------------------------------------------------------------------------------
def prefixed_fields(fields: dict[str, str | None], prefix: str | None, free: tuple[str, ...] = ("time", "domain")) -> dict:
    """Output names with the source prefix: ``{:}`` marks its place, ``:`` alone stands for the prefix and the input name.

    Any other name must be free or begin with the prefix.
    """
    if prefix is None:
        return dict(fields)
    named = [(f"{prefix}_{src}" if name == ":" else name.replace("{:}", prefix), src) for name, src in fields.items()]
    wrong = [name for name, src in named if src is not None and name not in free and not name.startswith(prefix)]
    if wrong:
        raise ValueError(f"names without the prefix {prefix!r}: {wrong}")
    return dict(named)


def check_prefixes(columns: list[str], allowed: tuple[str, ...], free: tuple[str, ...] = ("time", "domain"),
                   required: tuple[str, ...] = ("time",)) -> None:
    absent = [c for c in required if c not in columns]
    if absent:
        raise ValueError(f"mandatory columns are missing: {absent}")
    wrong = [c for c in columns if c not in free and not c.startswith(tuple(allowed))]
    if wrong:
        raise ValueError(f"columns without an allowed prefix {allowed}: {wrong}")


def read_indicator_rows(spark: SparkSession, path, schema, fields: dict[str, str | None], prefix: str | None = None,
                        allowed: tuple[str, ...] | None = None, extra: dict[str, object] | None = None,
                        required: tuple[str, ...] = ("time",), delimiter: str = ";") -> DataFrame | None:
    """S2. Mapped, prefixed and checked rows; constants are added only where absent. No rows: None."""
    df = read_delimited(spark, path, schema, prefixed_fields(fields, prefix), delimiter, "UTF-8")
    for name, value in (extra or {}).items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    if allowed is not None:
        check_prefixes(df.columns, allowed, required=required)
    return None if df.isEmpty() else df


# --- S3 ------------------------------------------------------------------------------------------
def read_lookup(spark: SparkSession, path, schema, key: str, delimiter: str = ",") -> DataFrame:
    """Look-up table with one row per key; of a repeated key the row with the largest values stays."""
    df = spark.read.schema(schema).csv(path, sep=delimiter, header=True)
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max(F.struct(*rest)).alias("_r")).select(key, "_r.*")


# --- S4 ------------------------------------------------------------------------------------------
def csv_layout(df: DataFrame, time: str = "time", decimals: int = 2) -> DataFrame:
    """Time first; fractional numbers as text with fixed decimals."""
    order = [time, *[c for c in df.columns if c != time]] if time in df.columns else df.columns
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    cols = []
    for c in order:
        col = F.col(f"`{c}`")
        if kinds[c] in ("double", "float", "decimal"):
            col = F.format_string(f"%.{decimals}f", col.cast("double"))
            col = F.when(F.col(f"`{c}`").isNotNull(), col)
        cols.append(col.alias(c))
    return df.select(*cols)


def quantised(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Fractional numbers as a CSV with fixed decimals would hand them to the next stage."""
    return df.withColumns({
        f.name: F.format_string(f"%.{decimals}f", F.col(f"`{f.name}`").cast("double")).try_cast("double")
        for f in df.schema.fields if f.dataType.typeName() in ("double", "float")})


def write_csv(df: DataFrame, path: str, partition: list[str], time: str = "time", decimals: int = 2) -> None:
    """Partitioned ``;`` CSV; a rerun replaces only the partitions it holds.

    Rows are dealt by partition first, so a partition is one file (more only where adaptive execution splits a large one), not one of each task.
    """
    csv_layout(df, time, decimals).hint("rebalance", *partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*partition).csv(path, sep=";", header=True)


def transposed(df: DataFrame, keys: list[str], decimals: int = 2) -> DataFrame:
    """One (name, value) row per column."""
    laid = csv_layout(df, decimals=decimals)
    values = [c for c in laid.columns if c not in keys]
    return laid.select(*keys, *[F.col(f"`{c}`").cast("string").alias(c) for c in values]).unpivot(keys, values, "name", "value")


# --- S9 ------------------------------------------------------------------------------------------
def parse_stations(raw: DataFrame, scale: float = 10.0, at: Column | None = None, lo: float | None = None,
                   hi: float | None = None) -> DataFrame:
    """Station readings: decimal comma, coordinates divided by ``scale``, yyyyMMddHHmm time, one time selected."""
    number = lambda c: F.regexp_replace(F.col(c).cast("string"), ",", ".").try_cast("double")
    out = raw.select(
        "code", "name", (number("longitude") / scale).alias("longitude"), (number("latitude") / scale).alias("latitude"),
        stamp12(F.col("time").cast("string")).alias("time"), number("data").alias("data"))
    if at is not None:
        out = out.filter(F.col("time") == at)
    return drop_out_of_range(out, "data", lo, hi)


# --- S10 -----------------------------------------------------------------------------------------
def parse_polygons(raw: DataFrame, code: str, wkt: str = "wkt", out_code: str = "alert_area_code", epsg: int = 4326) -> DataFrame:
    """(code, rings) from POLYGON or MULTIPOLYGON text in the coordinate system ``epsg`` (see ``projection``).

    ``rings`` holds every outline and hole of every part as array<struct<x,y>> in degrees, without the closing vertex.
    A text costs far more to read than to move, and a file of many polygons is small: texts are dealt to all shuffle partitions.
    """
    system = projection(epsg)

    def in_degrees(v):
        lon, lat = system.inverse(v["x"], v["y"])
        return F.struct(lon.alias("x"), lat.alias("y"))

    def vertex(s):
        return once(F.split(F.trim(s), " "), lambda xy: F.struct(F.get(xy, F.lit(0)).cast("double").alias("x"), F.get(xy, F.lit(1)).cast("double").alias("y")))

    def opened(ring):
        closed = (F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
        return F.when(closed, F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)

    # one blank for all white space: splits by a single character need no pattern, which would be compiled for every text
    texts = F.regexp_extract_all(F.regexp_replace(F.col(wkt), r"\s+", " "), F.lit(r"\(([^()]+)\)"), F.lit(1))
    rings = F.transform(texts, lambda t: once(F.transform(F.split(t, ","), vertex), opened))
    if system is not None:
        rings = F.transform(rings, lambda ring: F.transform(ring, in_degrees))
    many = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return raw.select(code, wkt).repartition(many, code, wkt).select(F.col(code).alias(out_code), rings.alias("rings"))


# --- S15 -----------------------------------------------------------------------------------------
def read_training(spark: SparkSession, path, features: int, delimiter: str = ",") -> DataFrame:
    """Headerless matrix with a stored row number first and the coefficient last: (i, x, c)."""
    names = ["i", *[f"x{k}" for k in range(features)], "c"]
    schema = T.StructType([T.StructField("i", T.IntegerType())] + [T.StructField(n, T.DoubleType()) for n in names[1:]])
    df = spark.read.schema(schema).csv(path, sep=delimiter, header=False)
    return df.select("i", F.array(*names[1:-1]).alias("x"), "c")
