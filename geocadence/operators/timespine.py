"""Time spines, run windows, period tables and gap handling."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geocadence.functions.times import (
    day_ceil, day_floor, from_hour_index, hour_ceil, hour_floor, hour_index, hours, ntz, period_seconds,
)
from geocadence.model import (
    FORECAST, MIXED, NO_DATA_NUMBER, NO_DATA_ROW_TEXT, OBSERVED,
)

_SNAP = {
    "none": lambda c: c,
    "prev": day_floor,
    "next": lambda c: F.date_add(c.cast("date"), 1).cast("timestamp_ntz"),
}


def _floor(c: Column, freq: str) -> Column:
    return {"h": hour_floor, "d": day_floor}[freq](c)


def _ceil(c: Column, freq: str) -> Column:
    return {"h": hour_ceil, "d": day_ceil}[freq](c)


def _steps(n: Column, freq: str) -> Column:
    return hours(n * (24 if freq == "d" else 1))


def _interval(freq: str) -> Column:
    return hours(24 if freq == "d" else 1)


# --- T1 ------------------------------------------------------------------------------------------
def run_window(runs: DataFrame, obs: int = 1, frc: int = 0, freq: str = "h",
               snap_start: str = "prev", snap_end: str = "next") -> DataFrame:
    """Adds ``time_run`` (floored), ``window_start`` and ``window_end`` to rows with a ``run`` time.

    Observed steps end at the run, forecast steps follow it. Rows carrying both ``fixed_start`` and
    ``fixed_end`` use those bounds instead (start up, end down to the step) and the run becomes the end.
    """
    obs, frc = max(int(obs), 0), max(int(frc), 0)
    run = _floor(ntz("run"), freq)
    first = 1 - obs if obs else min(frc, 1)  # steps from the run to the first and the last of the window
    bounds = [run + _steps(F.lit(n), freq) for n in (first, frc)]
    fixed = F.lit(False)
    if {"fixed_start", "fixed_end"} <= set(runs.columns):
        low, high = ntz("fixed_start"), ntz("fixed_end")
        fixed = low.isNotNull() & high.isNotNull()
        refused = F.raise_error(F.lit("fixed_end must not precede fixed_start")).cast("timestamp_ntz")
        given = (_ceil(low, freq), F.when(high < low, refused).otherwise(_floor(high, freq)))
        bounds = [F.when(fixed, g).otherwise(b) for g, b in zip(given, bounds)]
    start, end = _SNAP[snap_start](bounds[0]), _SNAP[snap_end](bounds[1])
    end = F.greatest(end, start)
    time_run = F.when(fixed, _floor(end, freq)).otherwise(run)
    return runs.withColumns({"time_run": time_run, "window_start": start, "window_end": end})


def expand_steps(df: DataFrame, start: str = "window_start", end: str = "window_end", freq: str = "h",
                 alias: str = "time", newest_first: bool = False) -> DataFrame:
    """One row per step of each window; bounded by the calendar, not by the data."""
    steps = F.sequence(F.col(start), F.col(end), _interval(freq))
    if newest_first:
        return df.select("*", F.posexplode(F.reverse(steps)).alias("step", alias))
    return df.withColumn(alias, F.explode(steps))


# --- T2 ------------------------------------------------------------------------------------------
def label_range(df: DataFrame, label: str, periods: int | None, freq: str = "h", run: str = "run") -> DataFrame:
    """Observed: n steps ending at the run. Forecast: n steps from the run; none for n < 1."""
    if label == OBSERVED:
        n = max(int(periods or 1), 1)
        return df.withColumn("time", F.explode(
            F.sequence(F.col(run) - _steps(F.lit(n - 1), freq), F.col(run), _interval(freq))))
    if label == FORECAST:
        if not periods or int(periods) <= 0:
            return df.withColumn("time", F.col(run)).limit(0)
        return df.withColumn("time", F.explode(
            F.sequence(F.col(run), F.col(run) + _steps(F.lit(int(periods) - 1), freq), _interval(freq))))
    raise ValueError(f"label must be {OBSERVED} or {FORECAST}")


# --- W3 / W4 -------------------------------------------------------------------------------------
def period_blocks(windows: DataFrame, obs_hours: int = 24, frc_hours: int = 24,
                  obs_partition: str = "multiple", frc_partition: str = "multiple",
                  drop_partial: bool = True, labels: tuple[str, str, str] = (OBSERVED, FORECAST, MIXED)) -> DataFrame:
    """Period table of each run window (``time_run``, ``window_start``, ``window_end``).

    Observed blocks walk back from the midnight before the run, forecast blocks walk forward from
    the hour after it. Both are numbered from 1 and clipped to the window.
    """
    observed, forecast, mixed = labels
    anchor = day_floor(F.col("time_run"))
    start, end = F.col("window_start"), F.col("window_end")
    if obs_partition == "unique":
        start, end = anchor - hours(obs_hours - 1), F.greatest(end, anchor)
    if frc_partition == "unique":
        start, end = F.least(start, anchor), anchor + hours(frc_hours - 1)

    base = windows.withColumns({"_anchor": hour_index(anchor), "_first": hour_index(start), "_last": hour_index(end)})
    a, s, e = F.col("_anchor"), F.col("_first"), F.col("_last")
    n_obs = F.when(a >= s, F.floor((a - s) / obs_hours) + 1).otherwise(0).cast("int")
    n_frc = F.when(a + 1 <= e, F.floor((e - a - 1) / frc_hours) + 1).otherwise(0).cast("int")
    numbers = lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    observed_blocks = F.transform(numbers(n_obs), lambda i: F.struct(
        F.lit(observed).alias("side"), i.alias("id"),
        (a - i * obs_hours + 1).alias("b"), (a - (i - 1) * obs_hours).alias("e")))
    forecast_blocks = F.transform(numbers(n_frc), lambda i: F.struct(
        F.lit(forecast).alias("side"), i.alias("id"),
        (a + 1 + (i - 1) * frc_hours).alias("b"), (a + i * frc_hours).alias("e")))

    rows = base.withColumn("_p", F.explode(F.concat(observed_blocks, forecast_blocks)))
    b = F.greatest(F.col("_p.b"), s)
    z = F.least(F.col("_p.e"), e)
    rows = rows.withColumns({"_b": b, "_z": z}).filter(F.col("_b") <= F.col("_z"))
    out = rows.select(
        *[c for c in windows.columns if c not in ("window_start", "window_end")],
        F.col("_p.side").alias("_side"),
        F.format_string("%s_%04d_Period", F.col("_p.side"), F.col("_p.id")).alias("period_tag"),
        F.col("_p.id").alias("period_id"),
        from_hour_index(F.col("_b")).alias("time_start"),
        from_hour_index(F.col("_z")).alias("time_end"),
        from_hour_index(F.col("_b")).cast("date").cast("string").alias("time_key"),
        F.col("time_run").alias("time_pivot"),
        (F.col("_z") - F.col("_b") + 1).alias("_len"),
    )
    is_mixed = (F.col("time_start") < F.col("time_pivot")) & (F.col("time_pivot") < F.col("time_end"))
    out = out.withColumn("period_type", F.when(is_mixed, F.lit(mixed)).otherwise(F.col("_side")))
    if drop_partial:
        short = ((F.col("period_type") == OBSERVED) & (F.col("_len") < obs_hours)) | (
            (F.col("period_type") == FORECAST) & (F.col("_len") < frc_hours))
        out = out.filter(~short)
    return out.drop("_side", "_len")


def period_hours(periods: DataFrame, keep: list[str]) -> DataFrame:
    """Hours of each period as rows: the equi-join side that assigns steps to periods."""
    return periods.select(*keep, F.explode(
        F.sequence(F.col("time_start"), F.col("time_end"), hours(1))).alias("time"))


# --- T3 ------------------------------------------------------------------------------------------
def day_spine(df: DataFrame, keys: list[str], time: str = "time", start: Column | None = None,
              end: Column | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """All days per key from start to end; a missing bound is the data's own first or last day.

    ``bounds`` (keys, _lo, _hi) gives these days where they are already known.
    """
    day = F.col(time).cast("date")
    if bounds is None:
        bounds = df.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    lo = F.coalesce(start.cast("date"), F.col("_lo")) if start is not None else F.col("_lo")
    hi = F.coalesce(end.cast("date"), F.col("_hi")) if end is not None else F.col("_hi")
    return (
        bounds.filter(lo <= hi)
        .select(*keys, F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias(time))
    )


def fill_missing_days(df: DataFrame, keys: list[str], time: str = "time", start: Column | None = None,
                      end: Column | None = None, no_number: float = NO_DATA_NUMBER,
                      no_text: str = NO_DATA_ROW_TEXT, bounds: DataFrame | None = None) -> DataFrame:
    """Adds the missing days as marker rows. With neither bound the input is returned unchanged.

    Columns named ``…time_run``, ``…time_start``, ``…time_end`` of a gap row get the day, the day at
    01:00 and the next day at 00:00.
    """
    if start is None and end is None:
        return df
    spine = day_spine(df, keys, time, start, end, bounds)
    data = df.withColumn(time, F.col(time).cast("date")).withColumn("_present", F.lit(True))
    joined = spine.join(data, [*keys, time], "full_outer")  # days of the data outside the bounds stay
    day, next_day = F.col(time).cast("string"), F.date_add(F.col(time), 1).cast("string")
    by_name = {"run": day, "start": F.concat(day, F.lit(" 01:00")), "end": F.concat(next_day, F.lit(" 00:00"))}
    by_kind = {"string": F.lit(no_text)} | dict.fromkeys(("byte", "short", "integer", "long", "float", "double", "decimal"), F.lit(no_number))

    def value(f) -> Column:
        named = re.search(r"(?:^|_)time_(run|start|end)$", f.name)
        marker = by_name[named[1]] if named else by_kind.get(f.dataType.typeName(), F.lit(None))
        return F.when(F.col("_present").isNull(), marker.cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name)

    fields = [F.col(f"`{f.name}`") if f.name in keys else day.alias(time) if f.name == time else value(f) for f in df.schema.fields]
    return joined.select(*fields)


# --- T4 ------------------------------------------------------------------------------------------
def expand_to_range(df: DataFrame, keys: list[str], start: Column | None, end: Column | None,
                    freq: str = "d", time: str = "time", fill: dict[str, object] | None = None) -> DataFrame:
    """Re-indexes each key to every step of [start, end]; steps outside are dropped."""
    bounds = df.groupBy(*keys).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    lo = F.coalesce(start, F.col("_lo")) if start is not None else F.col("_lo")
    hi = F.coalesce(end, F.col("_hi")) if end is not None else F.col("_hi")
    spine = bounds.filter(lo <= hi).select(
        *keys, F.explode(F.sequence(ntz(lo), ntz(hi), _interval(freq))).alias(time))
    out = spine.join(df, [*keys, time], "left")
    return out.fillna(fill) if fill else out


# --- T5 ------------------------------------------------------------------------------------------
def analysis_period(time_start=None, time_end=None, time_period: int | None = None, freq: str = "d",
                    time_reference: datetime | None = None) -> tuple[datetime, datetime] | str | None:
    """Bounds of the analysis: (n, reference) before (start, end) before (start, n) before (end, n).

    ``"ref_data"`` for both bounds means the range of the data. The reference is rounded to the step.
    """
    step = timedelta(days=1) if freq == "d" else timedelta(hours=1)
    if time_start == time_end == "ref_data":
        return "ref_data"
    reach = None if time_period is None else (time_period - 1) * step
    reference = None if time_reference is None or reach is None else _round_half_even(time_reference, step)
    ahead = lambda t: None if t is None or reach is None else t + reach
    back = lambda t: None if t is None or reach is None else t - reach
    ranked = [(back(reference), reference)]
    ranked.append((time_start, time_end) if None not in (time_start, time_end) else (time_start, ahead(time_start)))
    ranked.append((back(time_end), time_end))
    return next((bounds for bounds in ranked if None not in bounds), None)


def _round_half_even(t: datetime, step) -> datetime:
    origin = datetime(1970, 1, 1)
    whole, rest = divmod(t - origin, step)
    up = rest * 2 > step or (rest * 2 == step and whole % 2 == 1)
    return origin + (whole + (1 if up else 0)) * step


def within_period(df: DataFrame, bounds, time: str = "time") -> DataFrame:
    if bounds is None or bounds == "ref_data":
        return df
    return df.filter(F.col(time).between(F.lit(bounds[0]).cast("timestamp_ntz"), F.lit(bounds[1]).cast("timestamp_ntz")))


# --- T6 ------------------------------------------------------------------------------------------
def time_info(df: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Start, end and most frequent step in hours per key.

    Successive times are paired inside slices of 30 days, each slice also holding the first time of
    the next non-empty one, so no window spans the history of a key.
    """
    from pyspark.sql import Window
    steps = df.select(*keys, hour_index(F.col(time)).alias("_h")).distinct()
    slices = steps.withColumn("_s", F.floor(F.col("_h") / 720))
    heads = slices.groupBy(*keys, "_s").agg(F.min("_h").alias("_h"))
    w = Window.partitionBy(*keys).orderBy("_s")  # one row per 30 days
    carried = heads.select(*keys, F.lag("_s").over(w).alias("_s"), "_h").filter("_s IS NOT NULL")
    inner = Window.partitionBy(*keys, "_s").orderBy("_h")
    gaps = (
        slices.select(*keys, "_s", "_h").unionByName(carried)
        .withColumn("_d", F.lead("_h").over(inner) - F.col("_h"))
        .filter(F.col("_d").isNotNull())
        .groupBy(*keys, "_d").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys).agg(F.max_by("_d", F.struct(F.col("_n"), -F.col("_d"))).alias("step_hours"))
    )
    span = df.groupBy(*keys).agg(F.min(time).alias("time_start"), F.max(time).alias("time_end"))
    return span.join(gaps, keys, "left")


# --- T7 ------------------------------------------------------------------------------------------
def require_time(df: DataFrame, time: str = "time") -> DataFrame:
    """Casts the key to a naive time; the query fails on any value that is not a time."""
    bad = F.raise_error(F.concat(F.lit(f"{time} holds an invalid time: "), F.coalesce(F.col(time).cast("string"), F.lit("NULL"))))
    parsed = F.col(time).cast("string").try_cast("timestamp_ntz")
    return df.withColumn(time, F.when(parsed.isNull(), bad.cast("timestamp_ntz")).otherwise(parsed))


# --- W10 / W11 / W12: configuration of windows per side ------------------------------------------
# config rows: (area STRING, types ARRAY<STRING>, periods ARRAY<ARRAY<STRING>>)
def window_set(config: DataFrame) -> DataFrame:
    """W10. Union over areas of the windows named for each side, shortest first."""
    sides = config.select(F.explode("types").alias("side"), F.flatten("periods").alias("p"))
    return (
        sides.select(F.lower("side").alias("side"), F.explode("p").alias("window"))
        .filter(F.col("side").isin("left", "right")).distinct()
        .groupBy("side")
        .agg(F.array_sort(F.collect_list(F.struct(
            F.regexp_replace("window", "[Hh]$", "").cast("int").alias("h"), F.col("window")))).alias("w"))
        .select("side", F.col("w.window").alias("windows"))
    )


def _side_periods(config: DataFrame, mode: str) -> DataFrame:
    if mode == "separate":
        pairs = config.select(F.explode(F.arrays_zip("types", "periods")).alias("z")).select(
            F.lower(F.col("z.types")).alias("side"), F.explode("z.periods").alias("period"))
    elif mode == "common":
        pairs = config.select(F.explode("types").alias("t"), F.flatten("periods").alias("p")).select(
            F.lower("t").alias("side"), F.explode("p").alias("period"))
    else:
        raise ValueError('mode must be "separate" or "common"')
    direct = pairs.filter(F.col("side").isin("left", "right"))
    both = (
        config.filter(F.array_contains(F.transform("types", lambda t: F.lower(t)), "both"))
        .select(F.explode(F.array(F.lit("left"), F.lit("right"))).alias("side"), F.flatten("periods").alias("p"))
        .select("side", F.explode("p").alias("period"))
    )
    return direct.unionByName(both).distinct()


def search_period(config: DataFrame, mode: str = "separate", operation: str = "max") -> DataFrame:
    """W11. Longest or shortest period per side."""
    if operation not in ("max", "min"):
        raise ValueError('operation must be "max" or "min"')
    pick = F.max_by if operation == "max" else F.min_by
    seconds = period_seconds(F.col("period"))
    return _side_periods(config, mode).groupBy("side").agg(
        pick("period", F.struct(seconds, F.col("period"))).alias("search_period"))


def search_partition(config: DataFrame, mode: str = "separate") -> DataFrame:
    """W11. Partition mode per side; more than one distinct mode is an error."""
    return _side_periods(config, mode).groupBy("side").agg(
        F.min("period").alias("search_partition"), F.count(F.lit(1)).alias("_n")
    ).select("side", F.when(
        F.col("_n") > 1, F.raise_error(F.concat(F.lit("several partition modes for side "), F.col("side"))).cast("string")
    ).otherwise(F.col("search_partition")).alias("search_partition"))


def search_range(df: DataFrame, left: str | None, right: str | None, run: str = "run") -> DataFrame:
    """W12. Hourly steps from run - left to run + right; a missing side counts as 0."""
    secs = lambda p: period_seconds(F.lit(p)) if p else F.lit(0)
    span = lambda p: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs(p).cast("decimal(18,6)"))
    return df.withColumn("time", F.explode(F.sequence(
        F.col(run) - span(left), F.col(run) + span(right), hours(1))))
