"""Regional soil moisture from basin grids: unscale, mask, scatter or resample, mosaic, region mask."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geocadence.functions.cells import unscale
from geocadence.functions.geo import Grid
from geocadence.operators.grid import apply_nearest, mask_cells, mosaic, regrid_map, scatter


def regional_soil_moisture(basins: DataFrame, merged: Grid, targets: DataFrame, region_mask: DataFrame,
                           scale: float = 1.0, no_data: float = -9999.0, basin_mask: DataFrame | None = None) -> DataFrame:
    """Basin cells (domain, domain_order, time, row, col, lon, lat, value) to the regional grid.

    ``merged`` is the common grid the basins are scattered on, ``targets`` (trow, tcol, lon, lat) the
    final grid, ``region_mask`` (row, col, mask) its region.
    """
    cells = basins.withColumn("value", unscale(F.col("value"), scale, no_data))
    if basin_mask is not None:
        cells = mask_cells(cells, basin_mask, on=("domain", "row", "col"))
    placed = scatter(cells, merged, ["time", "domain", "domain_order"])
    whole = mosaic(placed, ["time"])
    mapping = regrid_map(targets, merged)
    fine = apply_nearest(whole, mapping, ["time"], ["trow", "tcol"]).withColumnsRenamed({"trow": "row", "tcol": "col"})
    return mask_cells(fine, region_mask)
