"""Series operators: means, rolling sums, metrics, thinning, marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geocadence.functions.times import from_hour_index, hour_index, second_floor
from geocadence.model import MIXED, NO_DATA_NUMBER, NO_DATA_ROW_TEXT

CHUNK_HOURS = 720


def _halo(df: DataFrame, widest: int, chunk: int, ascending: bool) -> DataFrame:
    """Copies the last (first) ``widest - 1`` hours of every chunk into the following (preceding) one."""
    pos = F.pmod(F.col("_h"), F.lit(chunk))
    own = F.floor(F.col("_h") / chunk)
    near = pos >= chunk - (widest - 1) if ascending else pos < widest - 1
    other = own + (1 if ascending else -1)
    return df.withColumn("_own", own).withColumn(
        "_chunk", F.explode(F.when(near, F.array(own, other)).otherwise(F.array(own))))


def _compose_sums(df: DataFrame, window, widths: list[int], value: str, prefix: str) -> DataFrame:
    """Exact N-step sums for every width, each built from the sums already there.

    A width is a chain of shorter sums that end where the next begins (24 = 12 + 12, 6 = 3 + 3), fetched with
    ``lag``: a few terms per row and no cancellation, instead of N additions per row and width. Rows are
    unique per step, so the steps are gapless when the row furthest back lies exactly that many steps back.
    """
    built = {1: value}
    for n in widths:
        terms, offset = [], 0
        for m in sorted(built, reverse=True):
            while n - offset >= m:
                terms.append(F.lag(built[m], offset).over(window) if offset else F.col(built[m]))
                last = offset
                offset += m
        total = terms[0].cast("double")
        for term in terms[1:]:
            total = total + term
        gapless = F.lag("_o", last).over(window) == F.col("_o") - last if last else F.lit(True)
        df = df.withColumn(f"{prefix}_{n}", F.when(gapless, total))
        built[n] = f"{prefix}_{n}"
    return df


def rolling_exact(df: DataFrame, keys: list[str], widths, value: str = "value", time: str = "time",
                  how: str = "sum", direction: str = "right", prefix: str = "roll",
                  chunk: int = CHUNK_HOURS) -> DataFrame:
    """W1/W2. Rolling sum or mean over exactly N hourly steps for every N in ``widths``.

    A width is missing where any of its N hours is absent or NULL. Rows are one per key and hour. The
    history of a key is cut into chunks of ``chunk`` hours with a halo of N-1 hours, so a window sort
    never holds more than ``chunk + N`` rows however long or hot the key is; all widths share the sort.
    The rows are spread by key and chunk, so an earlier partitioning by the key alone is not kept.
    """
    if how not in ("sum", "mean"):
        raise ValueError('how must be "sum" or "mean"')
    if direction not in ("right", "left"):
        raise ValueError('direction must be "right" or "left"')
    widths = sorted({int(w) for w in widths})
    chunk = max(chunk, widths[-1])
    up = direction == "right"
    rows = _halo(df.withColumn("_h", hour_index(F.col(time))), widths[-1], chunk, up)
    rows = rows.withColumn("_o", F.col("_h") if up else -F.col("_h")).repartition(*keys, "_chunk")
    order = Window.partitionBy(*keys, "_chunk").orderBy("_o")
    rows = _compose_sums(rows, order, widths, value, prefix)
    if how == "mean":
        rows = rows.withColumns({f"{prefix}_{n}": F.col(f"{prefix}_{n}") / n for n in widths})
    return rows.filter(F.col("_chunk") == F.col("_own")).drop("_h", "_o", "_own", "_chunk")


def rolling_within(df: DataFrame, keys: list[str], widths, value: str, hour: str,
                   prefix: str = "roll", spread: list[str] | None = None) -> DataFrame:
    """Rolling sums inside a bounded group (one analysis period), one sort for all widths.

    ``hour`` is the hour index of the row. ``spread`` names the part of the keys that rows are distributed
    by (default: all). Fewer columns keep neighbouring groups in one task, so that a following aggregate
    combines them before its shuffle.
    """
    order = Window.partitionBy(*keys).orderBy("_o")
    rows = df.withColumn("_o", F.col(hour)).repartition(*(spread or keys))
    return _compose_sums(rows, order, sorted(set(widths)), value, prefix).drop("_o")


# --- A2 ------------------------------------------------------------------------------------------
def area_mean(df: DataFrame, keys: list[str], value: str = "value", weight: str | None = None,
              alias: str = "value") -> DataFrame:
    """Mean per key over cells, NULL skipped; with ``weight`` each cell counts that many times."""
    if weight is None:
        return df.groupBy(*keys).agg(F.avg(value).alias(alias))
    w = F.when(F.col(value).isNotNull(), F.col(weight))
    return df.groupBy(*keys).agg((F.sum(F.col(value) * w) / F.sum(w)).alias(alias))


# --- A3 ------------------------------------------------------------------------------------------
def circle_maxima(df: DataFrame, keys: list[str], values: list[str], point: str = "point_id") -> DataFrame:
    """Largest member value per key (with time) and circle, for each column in ``values``."""
    return df.groupBy(*keys, point).agg(*[F.max(v).alias(v) for v in values])


def peak_metrics(circles: DataFrame, keys: list[str], values: list[str], names: list[str], time: str = "time",
                 strict: bool = False) -> DataFrame:
    """``{name}:max`` and ``{name}:avg`` over all (time, circle) maxima.

    Default: missing circles are ignored. ``strict``: times with no circle at all are dropped and
    any other missing circle makes both results missing.
    """
    if not strict:
        aggs = []
        for v, n in zip(values, names):
            aggs += [F.max(v).alias(f"{n}:max"), F.avg(v).alias(f"{n}:avg")]
        return circles.groupBy(*keys).agg(*aggs)
    per_time = circles.groupBy(*keys, time).agg(*[
        F.struct(F.count(v).alias("n"), F.count(F.lit(1)).alias("all"), F.max(v).alias("mx"), F.sum(v).alias("sm")).alias(v)
        for v in values])
    aggs = []
    for v, n in zip(values, names):
        kept = F.col(f"{v}.n") > 0
        whole = F.count_if(kept & (F.col(f"{v}.n") < F.col(f"{v}.all"))) == 0
        aggs += [
            F.when(whole, F.max(F.col(f"{v}.mx"))).alias(f"{n}:max"),
            F.when(whole, F.sum(F.col(f"{v}.sm")) / F.sum(F.when(kept, F.col(f"{v}.n")))).alias(f"{n}:avg"),
        ]
    return per_time.groupBy(*keys).agg(*aggs)


# --- A4 ------------------------------------------------------------------------------------------
def metric_columns(value: str, metrics, time: str = "time") -> dict[str, Column]:
    """Aggregates for a series; unknown names are skipped. First and last follow time, and may be NULL."""
    known = {
        "avg": F.avg(value), "max": F.max(value), "min": F.min(value),
        "first": F.min_by(F.col(value), F.col(time)), "last": F.max_by(F.col(value), F.col(time)),
    }
    return {m: known[m] for m in metrics if m in known}


def series_metrics(df: DataFrame, keys: list[str], value: str, metrics=("avg", "max"), time: str = "time",
                   name: str | None = None, sep: str = ":") -> DataFrame:
    name = name or value
    cols = metric_columns(value, metrics, time)
    return df.groupBy(*keys).agg(*[c.alias(f"{name}{sep}{m}") for m, c in cols.items()])


# --- W5 / P28 ------------------------------------------------------------------------------------
def null_rows(df: DataFrame, flag: Column, keep: list[str], no_number: float = NO_DATA_NUMBER,
              no_text: str = NO_DATA_ROW_TEXT) -> DataFrame:
    """P28. Rows with ``flag`` get the marker of each column's type; columns in ``keep`` stay."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in keep:
            out.append(c)
            continue
        kind = f.dataType.typeName()
        if kind in ("byte", "short", "integer", "long", "float", "double", "decimal"):
            mark = F.lit(no_number).cast(f.dataType)
        elif kind == "string":
            mark = F.lit(no_text)
        else:
            mark = F.lit(None).cast(f.dataType)
        out.append(F.when(flag, mark).otherwise(c).alias(f.name))
    return df.select(*out)


def keep_one_mixed(df: DataFrame, keys: list[str], type_columns: list[str], time: str = "time",
                   keep: str = "last", label: str = MIXED) -> DataFrame:
    """W5. Among rows flagged mixed in any type column the last (first) in time stays, others are marked.

    The kept time is found by an aggregate per key and joined back, so no window spans a key.
    """
    if keep not in ("last", "first"):
        raise ValueError('keep must be "last" or "first"')
    flagged = F.lit(False)
    for c in type_columns:
        flagged = flagged | F.coalesce(F.col(c) == label, F.lit(False))
    pick = F.max(time) if keep == "last" else F.min(time)
    kept = df.filter(flagged).groupBy(*keys).agg(pick.alias("_kept"))
    joined = df.join(kept, keys, "left")
    drop = flagged & (F.col(time) != F.col("_kept"))
    return null_rows(joined, F.coalesce(drop, F.lit(False)), [*keys, time, "_kept"]).drop("_kept")


# --- W7 ------------------------------------------------------------------------------------------
def duplicate_times(df: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


# --- W8 ------------------------------------------------------------------------------------------
def thin_by_minutes(df: DataFrame, keys: list[str], minutes: int, time: str = "time", path: str = "path") -> DataFrame:
    """Greedy thinning: keep the first, then the next at least ``minutes`` after the last kept.

    ``keys`` name one selection window (group and day), times count in whole seconds. Equal times can
    only yield one kept file, so the rows are first reduced to one per second; the walk then runs over an
    array that the calendar bounds (86400 a day, 1440 for minute stamps), not the number of files.
    """
    slots = (
        df.withColumn(time, second_floor(F.col(time))).groupBy(*keys, time).agg(F.min(path).alias(path))
        .withColumn("_s", (hour_index(F.col(time)) * 3600 + F.minute(time) * 60 + F.second(time)).cast("bigint"))
    )
    walk = slots.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        F.col("_s"), F.col(time).alias("t"), F.col(path).alias("p")))).alias("_all"))
    kept = F.aggregate(
        "_all",
        F.struct(F.lit(None).cast("bigint").alias("last"), F.slice("_all", 1, 0).alias("kept")),
        lambda acc, x: F.when(
            acc["last"].isNull() | (x["_s"] - acc["last"] >= minutes * 60),
            F.struct(x["_s"].alias("last"), F.concat(acc["kept"], F.array(x)).alias("kept")),
        ).otherwise(acc),
        lambda acc: acc["kept"],
    )
    return walk.select(*keys, F.explode(kept).alias("_k")).select(
        *keys, F.col("_k.t").alias(time), F.col("_k.p").alias(path))


# --- W9 ------------------------------------------------------------------------------------------
def first_forecast(df: DataFrame, keys: list[str], rain_type: str = "rain_period_type",
                   sm_type: str = "sm_period_type", time: str = "time",
                   labels: tuple[str, ...] = ("Forecast", "Observed_Forecast")) -> DataFrame:
    """First time flagged as forecast in the rain and in the soil-moisture column, and whether they agree."""
    first = lambda c: F.min(F.when(F.col(c).isin(*labels), F.col(time)))
    return df.groupBy(*keys).agg(first(rain_type).alias("rain_marker"), first(sm_type).alias("sm_marker")).withColumn(
        "agrees", F.col("rain_marker").eqNullSafe(F.col("sm_marker")))


def hourly(df: DataFrame, keys: list[str], time: str, aggs: dict[str, Column]) -> DataFrame:
    """Bins raw readings to whole hours with the given aggregates."""
    return (
        df.withColumn("_h", hour_index(F.col(time))).groupBy(*keys, "_h")
        .agg(*[c.alias(n) for n, c in aggs.items()])
        .withColumn("time", from_hour_index(F.col("_h"))).drop("_h")
    )
