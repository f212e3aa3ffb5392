"""The stages as jobs on tables: geometry, rain, soil moisture, slips, scenarios, predictors.

A ``Store`` names one folder per table. Outputs are partitioned by run date (or area) and a rerun replaces
only the partitions it computes, so a stage may be repeated after a failure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geocadence.functions.geo import Grid
from geocadence.operators.alerts import count_slips
from geocadence.operators.grid import circle_members
from geocadence.operators.kernel import KernelModel
from geocadence.operators.project import rename_fields
from geocadence.operators.timespine import period_blocks, period_hours, run_window
from geocadence.plans.indicators import area_geometry, rain_indicators, sm_indicators, source_circles
from geocadence.plans.predictors import predict, predictor_table
from geocadence.plans.scenarios import build_scenarios, finish_scenarios, update_days
from geocadence.session import stored
from geocadence.sources.grids import scan_cells, step_policy, written_steps
from geocadence.sources.tables import quantised
from geocadence.sources.versions import Versions


@dataclass(frozen=True)
class Store:
    """Table folders below one root on shared storage."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))

    def write(self, df: DataFrame, name: str, *partition: str) -> None:
        w = df.write.mode("overwrite")
        if partition:
            w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition)
        w.parquet(self.path(name))


def pending_runs(spark: SparkSession, runs: DataFrame, store: Store, table: str) -> DataFrame:
    """Runs whose date has no partition in the table yet."""
    try:
        done = store.read(spark, table).select("run_date").distinct()
    except Exception as missing:  # no table yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return runs
    return runs.join(done, F.col("run").cast("date") == F.col("run_date"), "left_anti")


# --- geometry --------------------------------------------------------------------------------------
def geometry_stage(spark: SparkSession, store: Store, fine_mask: DataFrame, points: DataFrame, source: Grid, fine: Grid,
                   km: float = 10.0) -> None:
    """Stores how areas and circles use the source cells.

    ``fine_mask`` (area, trow, tcol, lon, lat, mask) covers the ``fine`` grid, ``points`` (area, point_id, lon,
    lat) are the circle centres.
    """
    mapping, weights = area_geometry(fine_mask, source)
    store.write(mapping, "regrid_map")
    store.write(weights, "area_cells")
    mask = fine_mask.select("area", F.col("trow").alias("row"), F.col("tcol").alias("col"), "mask")
    members = circle_members(points, fine, km, mask=mask, mask_keys=("area",)).withColumnsRenamed({"row": "trow", "col": "tcol"})
    store.write(source_circles(members.drop("lon", "lat"), store.read(spark, "regrid_map")), "circle_cells")


# --- indicators ------------------------------------------------------------------------------------
def _periods(runs: DataFrame, obs_steps: int, frc_steps: int, obs_block: int, obs_partition: str) -> DataFrame:
    window = run_window(runs.select("run"), obs_steps, frc_steps, snap_end="none").drop("run")
    return stored(period_blocks(window, obs_block, 24, obs_partition=obs_partition), "periods")


def _complete_periods(periods: DataFrame, steps: DataFrame, policy: str) -> DataFrame:
    """Applies the completeness policy; ``steps`` are the times the cells have, known from their log."""
    keys = ["time_run", "period_tag"]
    spine = period_hours(periods, keys)
    present = spine.join(steps, "time", "left_semi")
    checked = step_policy(spine, present, keys, policy)
    if policy == "fail":
        checked.agg(F.sum("missing")).first()  # raises on the first incomplete period
        return periods
    return periods.join(checked.select(*keys), keys, "left_semi")


def _indicator_job(spark, store, runs, table, cells_table, compute, obs_steps, frc_steps, obs_block, obs_partition, policy):
    periods = _periods(runs, obs_steps, frc_steps, obs_block, obs_partition)
    first, last = periods.agg(F.min("time_start"), F.max("time_end")).first()
    if first is None:
        return
    lit = lambda t: F.lit(t).cast("timestamp_ntz")
    cells = scan_cells(spark, store.path(cells_table), lit(first), lit(last))
    steps = written_steps(spark, store.path(cells_table), lit(first), lit(last))
    rows = compute(cells, _complete_periods(periods, steps, policy))
    store.write(rows.withColumn("run_date", F.col("time_run").cast("date")), table, "run_date")


def rain_stage(spark: SparkSession, store: Store, runs: DataFrame, obs_steps: int = 24, frc_steps: int = 24,
               cells: str = "rain_cells", policy: str = "fail", strict: bool = False) -> None:
    """``indicators_rain`` of the given runs; a missing hour stops the job unless ``policy="skip"``."""
    weights, circles = store.read(spark, "area_cells"), store.read(spark, "circle_cells")
    _indicator_job(spark, store, runs, "indicators_rain", cells,
                   lambda c, p: rain_indicators(c, p, weights, circles, strict=strict), obs_steps, frc_steps, 24, "multiple", policy)


def sm_stage(spark: SparkSession, store: Store, runs: DataFrame, obs_steps: int = 24, frc_steps: int = 24,
             cells: str = "sm_cells", policy: str = "skip") -> None:
    """``indicators_sm`` of the given runs; the observed block is the two hours up to midnight."""
    weights = store.read(spark, "area_cells")
    _indicator_job(spark, store, runs, "indicators_sm", cells, lambda c, p: sm_indicators(c, p, weights),
                   obs_steps, frc_steps, 2, "unique", policy)


# --- slips -----------------------------------------------------------------------------------------
def slips_stage(store: Store, points: DataFrame, registry: DataFrame, levels: DataFrame, colors: DataFrame,
                code_source: str = "catalogue") -> None:
    """``slips``: daily counts per area with their level."""
    out = count_slips(points, registry, levels, colors, code_source).filter(F.col("alert_area_label").isNotNull())
    store.write(out.select(
        F.col("alert_area_label").alias("area"), "time", F.col("soil_slips").alias("slips_n"), F.col("id").alias("slips_id"),
        F.col("alert_area_label").alias("slips_area_label"), F.col("alert_color").alias("slips_alert_color"),
        F.col("alert_rgb").alias("slips_alert_rgb")), "slips", "area")


# --- scenarios -------------------------------------------------------------------------------------
def _indicator_rows(df: DataFrame, prefix: str, values: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Indicator rows keyed by day and run, period fields under the prefix, at the precision of a stored CSV."""
    rows = df.select(
        *keep, "area", F.to_date("time_key").alias("time"), F.col("time_run").alias("run_time"), *[F.col(f"`{v}`") for v in values],
        *[F.col(c).alias(f"{prefix}_{c}") for c in ("time_start", "time_end", "time_pivot", "period_type")])
    return quantised(rows, 2)


def scenario_stage(spark: SparkSession, store: Store, reference: Column, look_back_start: Column | None = None,
                   rain_values: tuple[str, ...] = ("rain_peak_3H:max", "rain_accumulated_12H:max"),
                   sm_values: tuple[str, ...] = ("sm_value_first", "sm_value_last")) -> None:
    """``scenarios``: rain, soil moisture and slips per area and day up to the reference time."""
    rain = _indicator_rows(store.read(spark, "indicators_rain"), "rain", list(rain_values))
    sm = _indicator_rows(store.read(spark, "indicators_sm"), "sm", list(sm_values))
    out = build_scenarios(rain, sm, store.read(spark, "slips"), reference, look_back_start)
    store.write(out, "scenarios", "area")


def scenario_update_stage(spark: SparkSession, store: Store, reference: Column, look_back_start: Column | None = None,
                          rain_values: tuple[str, ...] = ("rain_peak_3H:max", "rain_accumulated_12H:max"),
                          sm_values: tuple[str, ...] = ("sm_value_first", "sm_value_last"), since=None, redone: DataFrame | None = None) -> list:
    """``scenarios`` like ``scenario_stage``, from a table of days of which only those are computed that runs touch (``update_days``).

    Of the indicators only partitions of runs that reach those days are read; the rest starts from one row per area and day.
    """
    rain = _indicator_rows(store.read(spark, "indicators_rain"), "rain", list(rain_values), ("run_date",))
    sm = _indicator_rows(store.read(spark, "indicators_sm"), "sm", list(sm_values), ("run_date",))
    days, runs = Versions(spark, store.path("scenario_days")), Versions(spark, store.path("scenario_runs"))
    slips = store.read(spark, "slips")
    dates = update_days(days, runs, rain, sm, slips, reference, since, redone)
    both = days.read()
    if both is None:
        raise ValueError("there are no scenario days up to the reference time")
    store.write(finish_scenarios(both, slips, look_back_start), "scenarios", "area")
    return dates


# --- predictors ------------------------------------------------------------------------------------
# fixed values: names of scenario columns as the predictors know them
SCENARIO_NAMES = {
    "rain_peak_3H:max": "rain_peak_3H", "rain_accumulated_12H:max": "rain_accumulated_12H", "slips_area_label": "slips_domain",
    "slips_n": "slips_obs_n", "slips_id": "slips_obs_id", "slips_alert_color": "slips_obs_alert_color",
    "slips_alert_rgb": "slips_obs_alert_rgb",
}
# fixed values: names of the predictor table
PREDICTOR_NAMES = {
    "slips_domain": "soil_slips_domain", "slips_obs_n": "soil_slips_obs_n", "slips_obs_id": "soil_slips_obs_alert_level",
    "slips_obs_alert_color": "soil_slips_obs_alert_color", "slips_obs_alert_rgb": "soil_slips_obs_alert_rgb",
    "slips_pred_n": "soil_slips_pred_n", "slips_pred_id": "soil_slips_pred_alert_level",
    "slips_pred_alert_color": "soil_slips_pred_alert_color", "slips_pred_alert_rgb": "soil_slips_pred_alert_rgb",
}


def predictor_stage(spark: SparkSession, store: Store, model: KernelModel, period=None, levels: DataFrame | None = None) -> None:
    """``predictors``: predicted counts and levels per area and day, by each area's ranges; gaps written with markers."""
    scenarios = rename_fields(store.read(spark, "scenarios"), SCENARIO_NAMES)
    scenarios = scenarios.withColumn("time", F.col("time").cast("date"))
    table = predictor_table(predict(quantised(scenarios, 3), model, period=period, levels=levels), names=PREDICTOR_NAMES)
    store.write(table, "predictors", "area")
