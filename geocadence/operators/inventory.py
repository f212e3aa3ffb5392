"""Run and file inventories as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geocadence.functions.text import base_name, has_all_tags, is_mc_file, is_me_file, label_minutes, stamp12
from geocadence.functions.times import compact_minute, hour_index, seconds_between
from geocadence.operators.alerts import freshness_gate
from geocadence.operators.series import thin_by_minutes


# --- J16 -----------------------------------------------------------------------------------------
def runs_per_day(runs: DataFrame, day: str = "day", run: str = "run") -> DataFrame:
    """Sorted distinct HHMM labels per day; at most 1440 however many files a run has."""
    return runs.select(day, run).distinct().groupBy(day).agg(F.array_sort(F.collect_list(run)).alias("_runs"))


def latest_run(targets: DataFrame, runs: DataFrame, day: str = "day", at: str = "hhmm", run: str = "run") -> DataFrame:
    """Latest run label of the day not after the target's label; an equi-join on the day."""
    return targets.join(runs_per_day(runs, day, run), day, "left").withColumn(
        run, F.array_max(F.filter("_runs", lambda r: r <= F.col(at)))).drop("_runs")


# --- J17 -----------------------------------------------------------------------------------------
def data_hour_backward(targets: DataFrame, data: DataFrame, tolerance_hours: int, at: str = "run_time",
                       time: str = "time") -> DataFrame:
    """Newest hour with data in [target - tolerance, target], target floored to the hour.

    Each distinct data hour is offered to the ``tolerance + 1`` target hours it can serve, reduced to
    the newest per target hour, then joined by key: rows grow with hours, not with pairs.
    """
    offered = (
        data.select(hour_index(F.col(time)).alias("_d")).distinct()
        .withColumn("_t", F.explode(F.sequence(F.col("_d"), F.col("_d") + tolerance_hours)))
        .groupBy("_t").agg(F.max("_d").alias("data_hour"))
    )
    return targets.withColumn("_t", hour_index(F.col(at))).join(offered, "_t", "left").drop("_t")


def nearest_run(targets: DataFrame, runs: DataFrame, tolerance_minutes: int, at: str = "run_time",
                run: str = "run_time") -> DataFrame:
    """Run of the same day nearest to the target within the tolerance; exact first, a tie goes to the later.

    ``runs`` are reduced to distinct minutes per day (at most 1440) and searched inside the row.
    """
    minute = lambda c: F.hour(c) * 60 + F.minute(c)
    table = (
        runs.select(F.col(run).cast("date").alias("_day"), minute(F.col(run)).alias("_m")).distinct()
        .groupBy("_day").agg(F.collect_list("_m").alias("_ms"))
    )
    t = targets.withColumns({"_day": F.col(at).cast("date"), "_tm": minute(F.col(at))}).join(table, "_day", "left")
    # distance and minute in one integer: the least value is the nearest run, on a tie the later one
    code = F.array_min(F.transform(
        F.filter("_ms", lambda m: F.abs(m - F.col("_tm")) <= tolerance_minutes),
        lambda m: F.abs(m - F.col("_tm")) * 4096 + (2000 - m)))
    return t.withColumn("run_minute", F.lit(2000) - F.pmod(code, F.lit(4096))).drop("_day", "_ms", "_tm")


def select_data_time(targets: DataFrame, data: DataFrame, runs: DataFrame, tolerance_hours: int = 10,
                     at: str = "run_time", time: str = "time", run: str = "run_time") -> DataFrame:
    """J17. Data hour for a run: the same hour, else the newest within the tolerance, else the nearest
    run of the day provided its own hour has data."""
    back = data_hour_backward(targets, data, tolerance_hours, at, time)
    near = nearest_run(back, runs, tolerance_hours * 60, at, run)
    day_hours = F.floor(hour_index(F.col(at)) / 24) * 24
    near = near.withColumn("_fallback", day_hours + F.floor(F.col("run_minute") / 60))
    have = data.select(hour_index(F.col(time)).alias("_fallback")).distinct().withColumn("_has", F.lit(True))
    joined = near.join(have, "_fallback", "left")
    exact = F.col("data_hour") == hour_index(F.col(at))
    return joined.withColumns({
        "picked_hour": F.coalesce(F.col("data_hour"), F.when(F.col("_has"), F.col("_fallback"))),
        "pick": F.when(exact, "exact").when(F.col("data_hour").isNotNull(), "backward")
        .when(F.col("_has"), "nearest_run").otherwise("none"),
    }).drop("_fallback", "_has", "data_hour", "run_minute")


# --- J19 / U5 ------------------------------------------------------------------------------------
def newest_file(files: DataFrame, keys: list[str], path: str = "path", mtime: str = "mtime") -> DataFrame:
    """U5. Newest path per key; the name breaks ties.

    The newest time per key is a number, so a hash aggregate finds it in one pass; names are compared only among the files of that time.
    """
    files = files.select(*keys, F.col(path).alias("_path"), F.col(mtime).alias("_mtime"))
    last = files.groupBy(*keys).agg(F.max("_mtime").alias("_last")).select(*[F.col(f"`{k}`").alias(f"_key{n}") for n, k in enumerate(keys)], "_last")
    same = F.col("_mtime").eqNullSafe(F.col("_last"))
    for n, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_key{n}"))
    newest = files.join(last, same, "left_semi")
    return newest.groupBy(*keys).agg(F.max_by("_path", F.struct(base_name(F.col("_path")), F.col("_path"))).alias(path))


def newest_under_ceiling(files: DataFrame, keys: list[str], label: str, ceiling: str | None,
                         path: str = "path", mtime: str = "mtime") -> DataFrame:
    """J19. Newest path whose run label (HH:MM) is not after the ceiling; without one the newest of all."""
    if ceiling is not None:
        limit = int(ceiling[:2]) * 60 + int(ceiling[3:5])
        files = files.filter(label_minutes(F.col(label)) <= limit)
    return newest_file(files, keys, path, mtime)


# --- U6 ------------------------------------------------------------------------------------------
def first_path_per_time(files: DataFrame, keys: list[str], time: str = "time", path: str = "path") -> DataFrame:
    return files.filter(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.min(path).alias(path))


# --- P27 / P27b ----------------------------------------------------------------------------------
def files_with_tags(files: DataFrame, tags: list[str], path: str = "path") -> DataFrame:
    return files.filter(has_all_tags(F.col(path), tags))


def side_file_picks(stamp: Column, path: str = "path", mtime: str = "mtime") -> list[Column]:
    """Aggregates choosing the ``me`` and ``mc`` side file: one carrying the run stamp before the newest one."""
    name = base_name(F.col(path))
    order = F.struct(F.contains(name, stamp).cast("int"), F.col(mtime), name, F.col(path))
    return [F.max_by(F.when(is_it, F.col(path)), F.when(is_it, order)).alias(alias)
            for is_it, alias in ((is_me_file(F.col(path)), "me_path"), (is_mc_file(F.col(path)), "mc_path"))]


def side_files(files: DataFrame, keys: list[str], stamp: Column, path: str = "path", mtime: str = "mtime") -> DataFrame:
    """P27b. Chosen ``me`` and ``mc`` side file per run."""
    return files.groupBy(*keys).agg(*side_file_picks(stamp, path, mtime))


# --- A10 / O1 ------------------------------------------------------------------------------------
def group_summary(files: DataFrame, keys: list[str], group: str = "group", mtime: str = "mtime",
                  name_time: str = "name_time") -> DataFrame:
    """Count and oldest/newest times per run and file group. The names stay rows of the inventory:
    a group may hold any number of files, so they are not gathered into one value."""
    return files.groupBy(*keys, group).agg(
        F.count(F.lit(1)).alias("seen_count"),
        F.min(mtime).alias("oldest_fs_time"), F.max(mtime).alias("newest_fs_time"),
        F.min(name_time).alias("oldest_name_time"), F.max(name_time).alias("newest_name_time"))


def _timing(df: DataFrame, run_time: str, history: bool) -> DataFrame:
    by_name, by_fs = F.col("overall_newest_name_time"), F.col("overall_newest_fs_time")
    first, second, a, b = (by_name, by_fs, "filename", "filesystem") if history else (by_fs, by_name, "filesystem", "filename")
    return df.withColumns({
        "diff_hours_run_minus_latest": seconds_between(F.coalesce(first, second), F.col(run_time)) / 3600.0,
        "diff_basis": F.when(first.isNotNull(), a).when(second.isNotNull(), b),
    })


def run_catalogue(files: DataFrame, targets: DataFrame, history: bool = True) -> DataFrame:
    """O1. Selected run per day with its timing summary and side files, in one aggregate over its files.

    ``files`` has (day, run, group, path, mtime, name_time), ``targets`` has (day, hhmm).
    """
    chosen = latest_run(targets, files).filter(F.col("run").isNotNull()).select("day", "run").distinct()
    of_run = files.join(chosen, ["day", "run"], "left_semi")
    stamp = F.concat(F.regexp_replace(F.col("day").cast("string"), "-", ""), F.col("run"))
    data = F.lower("group").startswith("data")
    fs, named = F.when(data, F.col("mtime")), F.when(data, F.col("name_time"))
    out = of_run.groupBy("day", "run").agg(
        F.min(fs).alias("overall_oldest_fs_time"), F.max(fs).alias("overall_newest_fs_time"),
        F.min(named).alias("overall_oldest_name_time"), F.max(named).alias("overall_newest_name_time"),
        *side_file_picks(stamp))
    out = out.withColumn("algo_run_time", F.concat(
        F.col("day").cast("string"), F.lit(" "), F.substring("run", 1, 2), F.lit(":"), F.substring("run", 3, 2), F.lit(":00")).cast("timestamp_ntz"))
    times = [c for c in out.columns if c.endswith("_time")]
    return _timing(out, "algo_run_time", history).withColumns({c: compact_minute(F.col(c)) for c in times})


# --- A15 / O2 ------------------------------------------------------------------------------------
def selection_window(runs: DataFrame, limit_to_obs: bool = False, days_back: int = 0, start_hour: str | None = None,
                     flatten_hour: str | None = None, now: Column | None = None, missing: str = "fail") -> DataFrame:
    """O2. ``window_start`` and ``window_end`` from the stamps DateIni, DateObs and DateEnd (yyyyMMddHHmm) of a run.

    The window ends at DateEnd, or at DateObs with ``limit_to_obs``. Before ``flatten_hour`` (HH:MM) of ``now`` it begins a day
    earlier; without ``now`` the hour has no meaning and changes nothing. ``days_back`` moves the start by whole days, to ``start_hour`` (HH:MM) if given. A run
    whose stamps are absent or no times stops the query, or has no row with ``missing="skip"``.
    """
    if missing not in ("fail", "skip"):
        raise ValueError('missing must be "fail" or "skip"')
    since_midnight = lambda hhmm: F.make_dt_interval(F.lit(0), F.lit(int(hhmm[:2])), F.lit(int(hhmm[3:5])))
    start, end = stamp12(F.col("DateIni")), stamp12(F.col("DateObs" if limit_to_obs else "DateEnd"))
    known = start.isNotNull() & end.isNotNull()
    if missing == "skip":
        runs = runs.filter(known)
    else:
        text = F.concat(F.lit("a run lacks the stamps of its window: "), F.to_json(F.struct("DateIni", "DateObs", "DateEnd")))
        start = F.when(known, start).otherwise(F.raise_error(text).cast("timestamp_ntz"))
    if flatten_hour is not None and now is not None:
        early = F.date_format(now, "HH:mm") < F.lit(f"{int(flatten_hour[:2]):02d}:{int(flatten_hour[3:5]):02d}")
        start = start - F.when(early, F.make_dt_interval(F.lit(1))).otherwise(F.make_dt_interval(F.lit(0)))
    out = runs.withColumns({"window_start": start, "window_end": end})
    if days_back > 0:
        moved = F.col("window_start") - F.make_dt_interval(F.lit(days_back))
        if start_hour is not None:
            moved = moved.cast("date").cast("timestamp_ntz") + since_midnight(start_hour)
        out = out.withColumn("window_start", moved)
    return out


def selection_set(files: DataFrame, keys: list[str], start: Column, end: Column, freq_minutes: int | None = None,
                  max_hours: float | None = None, time: str = "data_time", path: str = "path") -> DataFrame:
    """O2. Files inside the window, thinned, with the freshness decision."""
    inside = files.filter(F.col(time).between(start, end))
    if freq_minutes:
        kept = thin_by_minutes(inside, keys, freq_minutes, time, path)
        inside = inside.join(kept, [*keys, path], "left_semi")
    return freshness_gate(inside, max_hours)


def sync_report(files: DataFrame, selected: DataFrame, keys: list[str], start: Column, end: Column,
                time: str = "data_time") -> DataFrame:
    """A15. Candidates, in window, selected and after gate per group."""
    seen = files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(F.col(time).between(start, end)).alias("within_window"))
    done = selected.groupBy(*keys).agg(F.count(F.lit(1)).alias("selected"), F.count_if("keep").alias("selected_after_gate"))
    return seen.join(done, keys, "left").fillna(0, ["selected", "selected_after_gate"])


# --- O3 / O4 / O5 --------------------------------------------------------------------------------
def stale_files(files: DataFrame, tag: Column, path: str = "path") -> DataFrame:
    """O3. Files whose name lacks the date tag of their folder."""
    return files.filter(~F.contains(base_name(F.col(path)), tag))


def wrong_extension(files: DataFrame, extension: str, path: str = "path") -> DataFrame:
    """O4. Files that do not end with the extension."""
    return files.filter(~F.col(path).endswith(extension))


def archive_plan(files: DataFrame, rules: DataFrame, keys: list[str], path: str = "path", mtime: str = "mtime") -> DataFrame:
    """O5. Files to archive: rules say ``all``, ``latest_mtime`` or ``latest_name`` per ``keys[0]``."""
    ruled = files.join(rules, keys[0], "inner")
    every = ruled.filter(F.col("mode") == "all").select(*keys, "mode", path)
    name = base_name(F.col(path))
    by_mtime = F.struct(F.col(mtime), name, F.col(path))
    by_name = F.struct(name, F.col(path))
    latest = ruled.filter(F.col("mode") != "all").groupBy(*keys, "mode").agg(
        F.max_by(path, by_mtime).alias("_m"), F.max_by(path, by_name).alias("_n"))
    return every.unionByName(latest.select(
        *keys, "mode", F.when(F.col("mode") == "latest_mtime", F.col("_m")).otherwise(F.col("_n")).alias(path)))
