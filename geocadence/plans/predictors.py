"""Predicted events and alert levels per area and day (M8, M9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geocadence.model import KERNEL_FEATURES, PREDICTOR_KINDS
from geocadence.operators.alerts import classify_predicted
from geocadence.operators.kernel import KernelModel, feature_columns, predicted_count, score_collapsed
from geocadence.operators.project import drop_invalid, rename_fields
from geocadence.operators.scenario import fill_by_kinds
from geocadence.operators.series import keep_one_mixed
from geocadence.operators.timespine import within_period


def predict(scenarios: DataFrame, model: KernelModel, area: str = "area", period=None, keep: str = "last",
            features=KERNEL_FEATURES, levels: DataFrame | None = None) -> DataFrame:
    """Scenario rows with ``slips_pred_n`` and its level, for all areas in one plan.

    Only the newest mixed row of an area is used, rows lacking a rain or soil-moisture value drop, each
    row is scored on its own key and classified by the ranges of its area (``levels``, the defaults for areas without).
    """
    df = within_period(scenarios, period)
    df = keep_one_mixed(df, [area], ["rain_period_type", "sm_period_type"], keep=keep)
    df = drop_invalid(df).withColumn("day_of_the_year", F.dayofyear("time"))
    scored = score_collapsed(df, model, feature_columns(df, features))
    scored = scored.withColumn("slips_pred_n", predicted_count(F.col("raw_score"))).drop("raw_score")
    out = classify_predicted(scored, "slips_pred_n", levels, "slips_pred", area)
    return out.withColumnsRenamed({"slips_pred_color": "slips_pred_alert_color", "slips_pred_rgba": "slips_pred_alert_rgb"})


def predictor_table(predicted: DataFrame, start: Column | None = None, end: Column | None = None, area: str = "area",
                    kinds=PREDICTOR_KINDS, names: dict[str, str] | None = None) -> DataFrame:
    """Daily table of fixed columns: gaps between start and end become marker rows."""
    bounds = predicted.groupBy(area).agg(F.min("time").alias("_lo"), F.max("time").alias("_hi"))
    lo = F.coalesce(start, F.col("_lo")) if start is not None else F.col("_lo")
    hi = F.coalesce(end, F.col("_hi")) if end is not None else F.col("_hi")
    spine = bounds.filter(lo <= hi).select(area, F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias("time"))
    table = fill_by_kinds(spine.join(predicted, [area, "time"], "left"), kinds, keep=(area, "time"))
    return rename_fields(table, names or {})


def review_table(df: DataFrame, observed: str, predicted: str, keys: list[str]) -> DataFrame:
    """M9. How often each observed level met each predicted level."""
    return df.groupBy(*keys, observed, predicted).agg(F.count(F.lit(1)).alias("n"))
