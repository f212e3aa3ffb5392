"""Scenario operators: merges on the daily spine, coverage, newest-run-wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geocadence.model import NO_DATA_FLOAT, NO_DATA_NUMBER, NO_DATA_TEXT
from geocadence.functions.times import hour_index

_NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")
_TIMES = ("date", "timestamp", "timestamp_ntz")
_FIXED_WIDTH = (*_NUMERIC[:-1], *_TIMES, "boolean")


# --- J4 ------------------------------------------------------------------------------------------
def collision_names(sources: list[tuple[str, list[str]]], keys: list[str]) -> dict[str, dict[str, str]]:
    """New names per source: a name belongs to the first source that has it, in others it gets ``{source}_``."""
    owner = dict.fromkeys(keys, "")

    def name_for(source: str, column: str) -> str:
        new = column if owner.setdefault(column, source) == source else f"{source}_{column}"
        owner.setdefault(new, source)
        return new

    return {source: {c: name_for(source, c) for c in columns if c not in keys} for source, columns in sources}


def merge_on_spine(spine: DataFrame, sources: list[tuple[str, DataFrame]], keys: list[str],
                   required: tuple[str, ...] = (), domain: str | None = None, area: str = "area") -> DataFrame:
    """Spine left-joined with each source in turn.

    Sources named in ``required`` must hold at least one row, else the query fails; the others may be empty.
    """
    names = collision_names([(n, d.columns) for n, d in sources], keys)
    out = spine
    for name, df in sources:
        if name in required and df.isEmpty():
            raise ValueError(f"source {name!r} is empty")
        renamed = df.select(*keys, *[F.col(f"`{a}`").alias(b) for a, b in names[name].items()])
        out = out.join(renamed, keys, "left")
    return out.withColumn("domain", F.lit(domain) if domain else F.col(area))


# --- J5 / J7 / U3 --------------------------------------------------------------------------------
def keep_common_times(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """J5. Both sides reduced to the keys found in the other."""
    return left.join(right.select(*keys), keys, "left_semi"), right.join(left.select(*keys), keys, "left_semi")


def common_times(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """J7. Keys present in every frame: one shuffle for any number of frames instead of a join chain."""
    tagged = [f.select(*keys).distinct().withColumn("_i", F.lit(i)) for i, f in enumerate(frames)]
    return (
        reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") == len(frames)).drop("_n")
    )


def time_set(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    """U3. Union, intersection or difference of two key sets, each key once."""
    a, b = a.select(*keys), b.select(*keys)
    if how == "union":
        return a.unionByName(b).distinct()
    if how == "intersection":
        return a.join(b, keys, "left_semi").distinct()
    if how == "difference":
        return a.join(b, keys, "left_anti").distinct()
    raise ValueError("how must be union, intersection or difference")


# --- J6 / W6 -------------------------------------------------------------------------------------
def newest_run_wins(df: DataFrame, keys: list[str], run: str = "run_time", tie: list[str] | None = None,
                    tag: str | None = "latest_from", tag_keys: tuple[str, ...] = ("area",)) -> DataFrame:
    """One row per key from its newest run: an aggregate, so a key with many runs is combined map-side.

    ``tag`` marks rows of the newest run of their ``tag_keys`` group ``latest`` and the others ``db``.
    """
    rest = [c for c in df.columns if c not in keys]
    kind = df.schema[run].dataType
    if not tie and kind.typeName() in _TIMES and all(df.schema[c].dataType.typeName() in _FIXED_WIDTH for c in rest):
        # values of a fixed width are kept in a hash aggregate; one order, so all of them come from the same row; no run is before all
        at = F.coalesce(F.col(run), F.lit("0001-01-01").cast(kind))
        out = df.groupBy(*keys).agg(*[F.max_by(F.col(f"`{c}`"), at).alias(c) for c in rest])
    else:
        order = F.struct(F.col(run), *[F.col(c) for c in (tie or [])])
        out = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_r")).select(*keys, "_r.*")
    if tag is None:
        return out
    newest = df.groupBy(*tag_keys).agg(F.max(run).alias("_newest"))  # the newest run always wins its keys
    return out.join(newest, list(tag_keys), "inner").withColumn(
        tag, F.when(F.col(run) == F.col("_newest"), F.lit("latest")).otherwise(F.lit("db"))).drop("_newest")


def append_missing(base: DataFrame, step: DataFrame, keys: list[str], tag: str = "latest_from") -> DataFrame:
    """J6, incremental: rows of ``step`` whose key is new are appended; existing rows are never replaced."""
    new = step.join(base.select(*keys), keys, "left_anti")
    return base.withColumn(tag, F.lit("latest")).unionByName(new.withColumn(tag, F.lit("db")))


# --- J18 -----------------------------------------------------------------------------------------
def best_run_per_day(rain: DataFrame, sm: DataFrame, slips: DataFrame, reference: Column,
                     area: str = "area", run: str = "run_time") -> DataFrame:
    """Newest run of each day and area present in all three inventories, not later than the reference.

    Slips carry no run; an area needs at least one slips file.
    """
    both = common_times([rain.select(area, run), sm.select(area, run)], [area, run])
    usable = both.join(slips.select(area).distinct(), area, "left_semi").filter(F.col(run) <= reference)
    return usable.groupBy(area, F.col(run).cast("date").alias("day")).agg(F.max(run).alias(run))


# --- A7 ------------------------------------------------------------------------------------------
def coverage(sources: list[tuple[str, DataFrame]], keys: list[str], freq: str = "d", time: str = "time",
             use: tuple[str, ...] | None = None) -> DataFrame:
    """Expected and found steps per key and source over the common window.

    The window runs from the latest start to the earliest end of the sources in ``use`` (default: all);
    no overlap is an error. ``percent`` is found / expected * 100 at two decimals.
    """
    step = 24 if freq == "d" else 1
    tagged = reduce(DataFrame.unionByName, [
        d.select(*keys, F.col(time).alias("_t")).withColumn("source", F.lit(n)) for n, d in sources])
    distinct = tagged.distinct()  # read twice below; both uses share its shuffle
    chosen = distinct.filter(F.col("source").isin(*use)) if use else distinct
    spans = chosen.groupBy(*keys, "source").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
    window = spans.groupBy(*keys).agg(F.max("_lo").alias("window_start"), F.min("_hi").alias("window_end"))
    window = window.withColumn("window_end", F.when(
        F.col("window_start") > F.col("window_end"),
        F.raise_error(F.lit("no overlapping time range between the selected sources")).cast("timestamp_ntz"),
    ).otherwise(F.col("window_end")))
    expected = (F.floor((hour_index(F.col("window_end")) - hour_index(F.col("window_start"))) / step) + 1).cast("bigint")
    found = distinct.join(window, keys, "inner").filter(
        F.col("_t").between(F.col("window_start"), F.col("window_end"))
    ).groupBy(*keys, "source").agg(F.count(F.lit(1)).alias("found"))
    names = F.explode(F.array(*[F.lit(n) for n, _ in sources]))
    return (
        window.withColumn("expected", expected).withColumn("source", names)
        .join(found, [*keys, "source"], "left")
        .withColumn("found", F.coalesce("found", F.lit(0)).cast("bigint"))
        .withColumn("percent", F.round(F.col("found") / F.col("expected") * 100, 2))
    )


def missing_steps(spine: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """A7/A16/O6. Spine steps that the data lack."""
    return spine.join(df.select(*keys), keys, "left_anti")


# --- A8 / A9 / A11 -------------------------------------------------------------------------------
def summary_tag(df: DataFrame, keys: list[str], tag: str, mode: str = "newest") -> DataFrame:
    """A8. Newest or oldest tag; NULL tags are ignored."""
    if mode not in ("newest", "oldest"):
        raise ValueError('mode must be "newest" or "oldest"')
    pick = F.max if mode == "newest" else F.min
    return df.groupBy(*keys).agg(pick(tag).alias(tag)) if keys else df.agg(pick(tag).alias(tag))


def require_single(df: DataFrame, value: str, expected: int = 1, keys: list[str] | None = None) -> DataFrame:
    """A9/A11. The distinct values of a column; the query fails when there are not ``expected`` of them."""
    n = F.count_distinct(value)
    checked = F.when(n == expected, F.min(value)).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {expected} distinct {value}, found "), n.cast("string"))).cast(df.schema[value].dataType))
    grouped = df.groupBy(*keys) if keys else df.groupBy()
    return grouped.agg(checked.alias(value), n.alias("distinct_values"))


# --- P9 ------------------------------------------------------------------------------------------
def fill_typed(df: DataFrame, time_key: str = "time", skip: tuple[str, ...] = ()) -> DataFrame:
    """Columns named ``…time…`` become times (bad text NULL); numbers take -9999, texts ``NA``."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if f.name in skip:
            out.append(c)
        elif time_key in f.name.lower():
            out.append(c.cast("string").try_cast("timestamp_ntz").alias(f.name))
        elif kind in _NUMERIC:
            out.append(F.coalesce(c, F.lit(NO_DATA_NUMBER).cast(f.dataType)).alias(f.name))
        elif kind == "string":
            out.append(F.coalesce(c, F.lit(NO_DATA_TEXT)).alias(f.name))
        else:
            out.append(F.coalesce(c.cast("string"), F.lit(NO_DATA_TEXT)).alias(f.name))
    return df.select(*out)


# --- P10 -----------------------------------------------------------------------------------------
def _whole(c: Column) -> Column:
    number = c.try_cast("double")
    return F.when(number == F.floor(number), number.cast("bigint"))


# how a kind reads a text, and the marker of a missing value (none for times)
_KINDS = {
    "timestamp": (lambda c: c.try_cast("timestamp_ntz"), None),
    "numeric:integer": (_whole, int(NO_DATA_NUMBER)),
    "numeric:float": (lambda c: c.try_cast("double"), float(NO_DATA_FLOAT)),
    "text": (lambda c: c, NO_DATA_TEXT),
}


def fill_by_kinds(df: DataFrame, kinds: dict[str, str | None], keep: tuple[str, ...] = ("time",)) -> DataFrame:
    """Keeps the columns of ``kinds`` that have a kind, casts them, adds absent ones, writes the markers."""
    def filled(name: str, kind: str) -> Column:
        read, marker = _KINDS["timestamp" if "timestamp" in kind else kind if kind in _KINDS else "text"]
        value = read((F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast("string"))
        return (value if marker is None else F.coalesce(value, F.lit(marker).cast("bigint") if isinstance(marker, int) else F.lit(marker))).alias(name)

    return df.select(*[c for c in keep if c in df.columns], *[filled(n, k) for n, k in kinds.items() if k is not None and n not in keep])


# --- U1 ------------------------------------------------------------------------------------------
def stack_tables(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
    """One table above the other; a missing or empty side gives the other; different columns are refused."""
    if a is None or b is None:
        return a if b is None else b
    if set(a.columns) != set(b.columns):
        if a.isEmpty() or b.isEmpty():
            return b if a.isEmpty() else a
        raise ValueError(f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}")
    return a.unionByName(b)


def stack_series(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """U7. Chosen series as (name, value) rows, names sorted."""
    present = sorted(c for c in columns if c in df.columns)
    return df.unpivot(keys, present, "name", "value")
