"""Rain and soil-moisture indicators per area and period.

One job for all areas, periods and windows. The reading of a target cell is that of its source cell, so
rolling sums and peaks are taken on source cells and area means are weighted by how many target cells a
source cell feeds; the hourly data are never multiplied onto the fine mask grid.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geocadence.functions.times import hour_index
from geocadence.model import OBSERVED, RAIN_WINDOWS
from geocadence.operators.grid import cell_weights, regrid_map
from geocadence.operators.series import area_mean, peak_metrics, rolling_within
from geocadence.operators.timespine import period_hours

TILE = 16  # cells per side of a tile
PERIOD_FIELDS = ["period_type", "period_tag", "period_id", "time_start", "time_end", "time_key", "time_pivot"]


def area_geometry(fine_mask: DataFrame, source, target=("trow", "tcol"), radius_m: float = 25000.0):
    """Source-cell weights of each area from the fine mask (area, trow, tcol, lon, lat, mask)."""
    cells = fine_mask.select(*target, "lon", "lat").distinct()
    mapping = regrid_map(cells, source, 1, radius_m)
    return mapping, cell_weights(mapping, fine_mask, list(target))


def source_circles(members: DataFrame, mapping: DataFrame, target=("trow", "tcol")) -> DataFrame:
    """Circle membership of fine cells carried over to the distinct source cells behind them."""
    return (
        members.join(mapping.filter("rank = 0"), list(target), "inner")
        .select("area", "point_id", F.col("src_row").alias("row"), F.col("src_col").alias("col")).distinct()
    )


def period_number(keys: list[str]) -> Column:
    """A 64-bit number per period; hourly rows carry it through their shuffles instead of the names behind it."""
    return F.xxhash64(*keys)


def cell_use(weights: DataFrame, circles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each source cell feeds: (row, col, _use) with an entry (number, n) per circle (n NULL) and per area (n its weight).

    Second, the small table of the numbers: (_u, area, circle).
    """
    feeds = circles.select("row", "col", "area", "point_id", F.lit(None).cast("long").alias("n"), F.lit(True).alias("circle")).unionByName(
        weights.select("row", "col", "area", F.lit(None).cast(circles.schema["point_id"].dataType).alias("point_id"), F.col("n").cast("long").alias("n"), F.lit(False).alias("circle")))
    number = F.xxhash64("area", "point_id", "circle")
    use = feeds.groupBy("row", "col").agg(F.collect_list(F.struct(number.alias("_u"), "n")).alias("_use"))
    return use, feeds.select(number.alias("_u"), "area", "circle").distinct()


def assign_periods(cells: DataFrame, periods: DataFrame, keys: list[str]) -> DataFrame:
    """Each reading once per period it falls in, as (_p, _h, row, col, value); an equi-join on the hour."""
    steps = period_hours(periods, keys).select(
        period_number(keys).alias("_p"), "time", hour_index(F.col("time")).cast("int").alias("_h"))
    return cells.join(steps, "time", "inner").select("_p", "_h", "row", "col", "value")


def rain_indicators(cells: DataFrame, periods: DataFrame, weights: DataFrame, circles: DataFrame,
                    windows: dict[str, tuple[int, ...]] | None = None, strict: bool = False,
                    run_keys: tuple[str, ...] = ("time_run",)) -> DataFrame:
    """One wide row per area and period.

    cells (time, row, col, value), one row per cell and hour; periods from ``period_blocks``; weights (area,
    row, col, n); circles (area, point_id, row, col). Columns ``rain_peak_{w}H:max|avg``,
    ``rain_average_{w}H:avg|max|min`` and ``rain_accumulated_{w}H:max|min``.
    """
    windows = windows or {"left": RAIN_WINDOWS, "right": RAIN_WINDOWS}
    widths = sorted({w for side in windows.values() for w in side})
    keys = [*run_keys, "period_tag"]
    base = assign_periods(cells, periods, keys)

    # Cells are read, joined and shuffled once. Each carries the numbers of the (few) circles and areas it feeds through the
    # window of its rolling sums. Rows are spread by period and tile, so that the maxima of a circle and the weighted
    # sums of an area are combined before their shuffle.
    use, numbers = cell_use(weights, circles)
    fed = base.join(use, ["row", "col"], "inner").withColumns({
        "_tr": F.floor(F.col("row") / TILE).cast("int"), "_tc": F.floor(F.col("col") / TILE).cast("int")})
    tile = ["_p", "_tr", "_tc"]
    sums = rolling_within(fed, [*tile, "row", "col"], widths, "value", "_h", prefix="s", spread=tile)
    names = [f"s_{w}" for w in widths]
    fields = sums.select("_p", "_h", "value", *names, F.inline("_use"))
    weight = F.when(F.col("value").isNotNull(), F.col("n"))
    hourly = fields.groupBy("_p", "_h", "_u").agg(
        *[F.max(F.when(F.col("n").isNull(), F.col(s))).alias(s) for s in names], (F.sum(F.col("value") * weight) / F.sum(weight)).alias("value"))
    hourly = hourly.join(numbers, "_u", "inner")

    # One more window: rolling sums of the area means. A circle is a series of its own there, whose sums nobody reads.
    rolled = rolling_within(hourly, ["area", "_p", "_u"], widths, "value", "_h", prefix="acc", spread=["area", "_p"])
    aggs, circle = [], F.col("circle")
    for w in widths:
        total = F.when(~circle, F.col(f"acc_{w}"))
        peak = F.when(circle, F.col(f"s_{w}"))
        aggs += [
            F.avg(total / w).alias(f"rain_average_{w}H:avg"), F.max(total / w).alias(f"rain_average_{w}H:max"),
            F.min(total / w).alias(f"rain_average_{w}H:min"),
            F.max(total).alias(f"rain_accumulated_{w}H:max"), F.min(total).alias(f"rain_accumulated_{w}H:min"),
        ] + ([] if strict else [F.max(peak).alias(f"rain_peak_{w}H:max"), F.avg(peak).alias(f"rain_peak_{w}H:avg")])
    rows = rolled.groupBy("area", "_p").agg(F.count_if(~circle).alias("_hours"), *aggs).where("_hours > 0").drop("_hours")
    if strict:
        points = hourly.where("circle").select("area", "_p", "_h", *names)
        rows = rows.join(peak_metrics(points, ["area", "_p"], names, [f"rain_peak_{w}H" for w in widths], time="_h", strict=True), ["area", "_p"], "left")
    return _side_windows(_with_period_fields(rows, periods, keys), windows, widths)


def _with_period_fields(rows: DataFrame, periods: DataFrame, keys: list[str]) -> DataFrame:
    fields = periods.select(period_number(keys).alias("_p"), *keys, *[c for c in PERIOD_FIELDS if c not in keys])
    return rows.join(fields, "_p", "inner").drop("_p")


def _side_windows(df: DataFrame, windows: dict[str, tuple[int, ...]], widths: list[int]) -> DataFrame:
    """Observed periods use the left windows, forecast and mixed ones the right; others are missing."""
    cols = {}
    for c in df.columns:
        if c.startswith("rain_") and ":" in c:
            w = int(c.split("_")[2].split("H")[0])
            left, right = w in windows["left"], w in windows["right"]
            if not (left and right):
                on_left = F.col("period_type") == OBSERVED
                cols[c] = F.when(on_left if left else ~on_left, F.col(f"`{c}`"))
    return df.withColumns(cols) if cols else df


def sm_indicators(cells: DataFrame, periods: DataFrame, weights: DataFrame,
                  run_keys: tuple[str, ...] = ("time_run",)) -> DataFrame:
    """Area and period rows with ``sm_value_avg``, ``_max``, ``_first``, ``_last``; one step alone gives none."""
    keys = [*run_keys, "period_tag"]
    series = area_mean(assign_periods(cells, periods, keys).join(weights, ["row", "col"], "inner"), ["area", "_p", "_h"], weight="n")
    rows = series.groupBy("area", "_p").agg(
        F.avg("value").alias("sm_value_avg"), F.max("value").alias("sm_value_max"),
        F.min_by("value", "_h").alias("sm_value_first"), F.max_by("value", "_h").alias("sm_value_last"),
        F.count(F.lit(1)).alias("_steps"))
    return _with_period_fields(rows.filter("_steps > 1").drop("_steps"), periods, keys)


def append_periods(tables: list[DataFrame]) -> DataFrame:
    """U2. Indicator rows of several periods or runs in one table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
