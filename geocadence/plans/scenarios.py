"""Daily scenarios per area: best run per day, newest rows, common times, spine merge, gaps (stage 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geocadence.operators.scenario import (
    best_run_per_day, collision_names, fill_typed, merge_on_spine, newest_run_wins,
)
from geocadence.operators.timespine import fill_missing_days
from geocadence.session import discard, stored
from geocadence.sources.versions import Versions


def select_run_rows(rows: DataFrame, chosen: DataFrame, area: str = "area", run: str = "run_time") -> DataFrame:
    return rows.join(chosen.select(area, run), [area, run], "left_semi")


def build_scenarios(rain: DataFrame, sm: DataFrame, slips: DataFrame, reference: Column, look_back_start: Column | None = None,
                    area: str = "area", run: str = "run_time") -> DataFrame:
    """Scenario rows (area, time, …) from indicator rows of all runs and the daily slip table.

    rain and sm hold one row per (area, time, run_time); slips one row per (area, time).
    """
    for name, rows in (("rain", rain), ("soil moisture", sm)):
        if rows.isEmpty():
            raise ValueError(f"there are no {name} indicators")
    chosen = best_run_per_day(rain, sm, slips, reference, area, run)
    rain, sm = select_run_rows(rain, chosen, area, run), select_run_rows(sm, chosen, area, run)
    # a small table that the spine, the merge and the gap filling all start from
    return finish_scenarios(stored(scenario_days(rain, sm, area, run), "scenario-days"), slips, look_back_start, area)


def scenario_days(rain: DataFrame, sm: DataFrame, area: str = "area", run: str = "run_time", newest: DataFrame | None = None) -> DataFrame:
    """One row per area and day with both sources, each from its newest run; times present in only one of them drop.

    ``newest`` (area, run): the newest run of each area, where the rows at hand are not all rows.
    """
    keys = [area, "time"]

    def of_source(rows: DataFrame, name: str) -> DataFrame:
        tag = f"{name}_latest_from"
        if newest is None:
            out = newest_run_wins(rows, keys, run, tag=tag, tag_keys=(area,))
        else:
            out = newest_run_wins(rows, keys, run, tag=None).join(newest.select(area, F.col(run).alias("_newest")), area, "inner").withColumn(
                tag, F.when(F.col(run) == F.col("_newest"), F.lit("latest")).otherwise(F.lit("db"))).drop("_newest")
        return out.withColumnRenamed(run, f"{name}_time_run")

    rain, sm = of_source(rain, "rain"), of_source(sm, "sm")
    names = collision_names([("rain", rain.columns), ("sm", sm.columns)], keys)
    return rain.join(sm.withColumnsRenamed(names["sm"]), keys, "inner")


def finish_scenarios(both: DataFrame, slips: DataFrame, look_back_start: Column | None = None, area: str = "area") -> DataFrame:
    """Days of both sources on the daily spine of their area, with slips, typed markers and marker rows back to the start."""
    keys = [area, "time"]
    bounds = both.groupBy(area).agg(F.min("time").alias("_lo"), F.max("time").alias("_hi"))
    spine = bounds.select(area, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias("time"))
    merged = merge_on_spine(spine, [("indicators", both), ("slips", slips)], keys, area=area)
    filled = fill_typed(merged, skip=(area, "domain", "time"))
    if look_back_start is None:
        return filled
    return fill_missing_days(filled, [area], start=look_back_start, bounds=bounds)


def update_days(days: Versions, runs: Versions, rain: DataFrame, sm: DataFrame, slips: DataFrame, reference: Column,
                since=None, redone: DataFrame | None = None, area: str = "area", run: str = "run_time") -> list:
    """J6, kept up to date: brings the table of ``scenario_days`` to the reference time and returns the days it wrote.

    ``rain`` and ``sm`` also have ``run_date``, the partition of their tables. ``runs`` remembers the run chosen of each area
    and day with its first and last day of rows. A run that is new, is replaced by a later one of its day, or is no longer (or only
    now) the newest of its area touches its days; those days are computed again from the runs that reach them, all other
    days and partitions are left alone. Runs written again under their old name are given as ``redone`` (area, run).
    ``since`` (a date): runs of earlier dates are taken as remembered, without looking at their partitions.

    Days are committed before runs, each as a whole version: an update that was cut off between them is repeated by the next one,
    which must have the same or a later reference time.
    """
    keys, day = [area, run], F.to_date(run)
    recent = (lambda d: d) if since is None else lambda d: d.filter(F.col("run_date") >= F.lit(since))
    chosen = best_run_per_day(recent(rain), recent(sm), slips, reference, area, run).select(*keys)
    old = runs.read()
    if old is None:
        old = rain.select(*keys, F.col("time").alias("lo"), F.col("time").alias("hi")).filter(F.lit(False))
    elif since is not None:
        chosen = chosen.unionByName(old.filter(day < F.lit(since)).select(*keys))
    chosen = stored(chosen, "chosen-runs")  # a row per area and day

    newest = lambda d: d.groupBy(area).agg(F.max(run).alias(run)).select(*keys)
    change = lambda a, b: a.join(b, keys, "left_anti").unionByName(b.join(a, keys, "left_anti"))
    before = old.select(*keys)
    touched = change(before, chosen).unionByName(change(newest(before), newest(chosen)))
    if redone is not None:
        touched = touched.unionByName(redone.select(*keys))
    touched = stored(touched.distinct(), "touched-runs")

    in_dates = lambda d, wanted: d.filter(F.col("run_date").isin([r[0] for r in wanted.select(day).distinct().collect()]))
    seen = in_dates(rain, touched).select(*keys, "time").unionByName(in_dates(sm, touched).select(*keys, "time"))
    spans = seen.join(touched, keys, "left_semi").groupBy(*keys).agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
    spans = stored(spans, "run-spans")
    reach = lambda d: d.select(*keys, F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("time"))
    again = stored(reach(spans).unionByName(reach(old.join(touched, keys, "left_semi"))).select("time").distinct(), "touched-days")
    dates = sorted(r[0] for r in again.collect())  # days of a delivery
    known = old.join(spans, keys, "left_anti").unionByName(spans).join(chosen, keys, "left_semi")
    if dates:
        needed = stored(reach(known).join(again, "time", "left_semi").select(*keys).distinct(), "needed-runs")
        pick = lambda d: in_dates(d, needed).drop("run_date").join(needed, keys, "left_semi").join(again, "time", "left_semi")
        both = scenario_days(pick(rain), pick(sm), area, run, newest(chosen))
        days.replace(both.withColumn("_day", F.col("time").cast("string")), "_day", "scenarios", len(days.numbers()), tuple(str(d)[:10] for d in dates))
        discard(needed)
    if not touched.isEmpty():
        month = F.date_format(run, "yyyy-MM")
        runs.replace(known.withColumn("_month", month), "_month", "scenarios", len(runs.numbers()), tuple(runs.manifest()["parts"]))
    discard(chosen, touched, spans, again)
    return dates
