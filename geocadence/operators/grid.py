"""Grid operators: masks, regridding, scatter, mosaic, circles, rasterising.

Regular grids let every neighbour search be index arithmetic on the row itself: candidates come from
``sequence`` around the computed index, so no pair of cells is ever formed by a join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geocadence.functions.geo import (
    Grid, cross_x, crosses, haversine_m, mercator_lat, mercator_lon, mercator_x, mercator_y, polygon_edges, polygon_rings,
)
from geocadence.model import EARTH_RADIUS_M


# --- S16 -----------------------------------------------------------------------------------------
def grid_cells(spark: SparkSession, grid: Grid) -> DataFrame:
    """All cells of a grid with centre coordinates and fill value 1."""
    n = grid.nrows * grid.ncols
    return spark.range(n).select(
        F.floor(F.col("id") / grid.ncols).cast("int").alias("row"),
        F.pmod(F.col("id"), F.lit(grid.ncols)).cast("int").alias("col"),
    ).withColumns({"lon": grid.lon(F.col("col")), "lat": grid.lat(F.col("row")), "value": F.lit(1)})


def cells_of_definitions(defs: DataFrame) -> DataFrame:
    """Cells of every grid in a ``grid_def`` table (grid, nrows, ncols, xllcorner, yllcorner, cellsize)."""
    res = F.col("cellsize")
    return (
        defs.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("nrows") - 1)))
        .withColumn("col", F.explode(F.sequence(F.lit(0), F.col("ncols") - 1)))
        .select(
            "grid", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"),
            (F.col("xllcorner") + res / 2 + F.col("col") * res).alias("lon"),
            (F.col("yllcorner") + res / 2 + (F.col("nrows") - 1 - F.col("row")) * res).alias("lat"),
            F.lit(1).alias("value"))
    )


# --- P7 ------------------------------------------------------------------------------------------
def mask_cells(cells: DataFrame, mask: DataFrame, keep: int = 1, value: str = "value", drop: bool = False,
               on: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """Cells whose mask equals ``keep`` stay; the others become missing, or are dropped.

    ``mask`` holds (row, col, mask). It is joined by key; Spark broadcasts it only below its own limit.
    """
    on = list(on)
    if drop:
        return cells.join(mask.filter(F.col("mask") == keep).select(*on), on, "left_semi")
    m = mask.select(*on, F.col("mask").alias("_m"))
    return cells.join(m, on, "left").withColumn(value, F.when(F.col("_m") == keep, F.col(value))).drop("_m")


def same_grid(a: DataFrame, b: DataFrame, key: str = "grid") -> DataFrame:
    """P7b. Whether two grid definitions agree (sizes exactly, cell size and corners to 3 decimals)."""
    fields = ["ncols", "nrows", "cellsize", "xllcorner", "yllcorner"]
    r = b.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    same = F.lit(True)
    for f in fields[:2]:
        same = same & (F.col(f) == F.col(f"_{f}"))
    for f in fields[2:]:
        same = same & (F.format_string("%.3f", F.col(f).cast("double")) == F.format_string("%.3f", F.col(f"_{f}").cast("double")))
    return a.join(r, key, "inner").select(key, same.alias("mask_active"))


def needs_regrid(a: DataFrame, b: DataFrame, key: str = "grid") -> DataFrame:
    """P7c. Whether a source has to be regridded (rows, columns or cell size differ)."""
    r = b.select(key, *[F.col(f).alias(f"_{f}") for f in ("ncols", "nrows", "cellsize")])
    differ = F.lit(False)
    for f in ("ncols", "nrows", "cellsize"):
        differ = differ | (F.col(f) != F.col(f"_{f}"))
    return a.join(r, key, "inner").select(key, differ.alias("regrid"))


# --- J8 / J9 -------------------------------------------------------------------------------------
def regrid_map(targets: DataFrame, source: Grid, k: int = 1, radius_m: float = 25000.0,
               lon: str = "lon", lat: str = "lat") -> DataFrame:
    """For each target the k nearest source cells within the radius: src_row, src_col, dist_m, rank.

    The candidates are the cells of a block around the target's own index. Its half-widths are
    chosen so that the k nearest cells surely lie in it, at corners and for targets outside too; the result is exact. For
    k = 1 the best column of any row is one of the two beside the target, and the best row is the nearest
    up to the small poleward shift of the great circle.
    """
    if k == 1:
        poleward = math.degrees((radius_m / EARTH_RADIUS_M * source.metres_per_row / source.least_metres_per_col()) ** 2 / 4)
        half = 1 + math.ceil(poleward / source.cellsize)
        clamp = lambda c, n: F.least(F.greatest(c, F.lit(0)), F.lit(n - 1))
        centre = F.rint(source.row_pos(F.col(lat))).cast("int")
        left = F.floor(source.col_pos(F.col(lon))).cast("int")
        t = targets.withColumns({
            "_rows": F.sequence(clamp(centre - half, source.nrows), clamp(centre + half, source.nrows)),
            "_cols": F.array_distinct(F.array(clamp(left, source.ncols), clamp(left + 1, source.ncols)))})
        return _pick_nearest(t, targets.columns, source, k, radius_m, lon, lat)
    # around the nearest point of the grid the k nearest cells lie within ``reach``: a quarter of a disc holds them at a corner,
    # a strip when the grid is narrower than that; a target outside the grid adds its distance from it
    narrow, quarter = min(source.nrows, source.ncols), 2 * math.sqrt(k / math.pi) + 2
    reach = max(quarter, k / narrow + narrow if narrow < quarter else 0) * source.metres_per_row  # a column is never wider than a row is high
    row, col = source.row_pos(F.col(lat)), source.col_pos(F.col(lon))
    off = lambda pos, n: F.greatest(-pos, pos - (n - 1), F.lit(0.0))
    far = F.least(F.lit(float(radius_m)), reach + source.metres_per_row * (off(row, source.nrows) + off(col, source.ncols)))

    def span(pos: Column, metres: float, n: int) -> Column:
        lo = F.greatest(F.floor(pos - far / metres) - 1, F.lit(0)).cast("int")
        hi = F.least(F.ceil(pos + far / metres) + 1, F.lit(n - 1)).cast("int")
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    t = targets.withColumns({"_rows": span(row, source.metres_per_row, source.nrows), "_cols": span(col, source.least_metres_per_col(), source.ncols)})
    return _pick_nearest(t, targets.columns, source, k, radius_m, lon, lat)


def _pick_nearest(t: DataFrame, columns: list[str], source: Grid, k: int, radius_m: float, lon: str, lat: str) -> DataFrame:
    candidates = F.flatten(F.transform("_rows", lambda r: F.transform("_cols", lambda c: F.struct(
        haversine_m(F.col(lon), F.col(lat), source.lon(c), source.lat(r)).alias("dist_m"),
        r.alias("src_row"), c.alias("src_col")))))
    near = F.slice(F.array_sort(F.filter(candidates, lambda s: s["dist_m"] <= radius_m)), 1, k)
    return t.select("*", F.posexplode(near).alias("rank", "_n")).select(
        *columns, "rank", "_n.src_row", "_n.src_col", "_n.dist_m")


def apply_nearest(cells: DataFrame, mapping: DataFrame, keys: list[str], target: list[str], value: str = "value") -> DataFrame:
    """J8. Source cells moved onto targets through a rank-0 map; an equi-join on the source index."""
    m = mapping.filter(F.col("rank") == 0).select(*target, "src_row", "src_col")
    c = cells.select(*keys, F.col("row").alias("src_row"), F.col("col").alias("src_col"), F.col(value))
    return c.join(m, ["src_row", "src_col"], "inner").select(*keys, *target, value)


def apply_weighted(cells: DataFrame, mapping: DataFrame, keys: list[str], target: list[str], weight: str = "weight",
                   value: str = "value") -> DataFrame:
    """J9. Sum(w*v)/sum(w) over the mapped cells, only where the weights add up to more than 0.

    As with plain sums in an array, a missing member makes the result missing.
    """
    m = mapping.select(*target, "src_row", "src_col", F.col(weight).alias("_w"))
    c = cells.select(*keys, F.col("row").alias("src_row"), F.col("col").alias("src_col"), F.col(value).alias("_v"))
    return c.join(m, ["src_row", "src_col"], "inner").groupBy(*keys, *target).agg(
        F.when((F.sum("_w") > 0) & (F.count("_v") == F.count(F.lit(1))), F.sum(F.col("_w") * F.col("_v")) / F.sum("_w")).alias(value))


def cell_weights(mapping: DataFrame, mask: DataFrame, target: list[str]) -> DataFrame:
    """Collapses a nearest map and area masks to (area, row, col, n): how many masked target cells take
    their value from a source cell.

    A mean over the regridded, masked cells of an area equals the mean over source cells weighted by
    n, so hourly data never have to be multiplied onto the fine grid.
    """
    return (
        mapping.filter(F.col("rank") == 0).join(mask.filter("mask = 1").select("area", *target), target, "inner")
        .groupBy("area", F.col("src_row").alias("row"), F.col("src_col").alias("col"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- J10 -----------------------------------------------------------------------------------------
def resample_map(targets: DataFrame, source: Grid, method: str = "nearest", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Source cells and weights of each target on a regular grid.

    A target outside the centres gets the nearest cell with a missing weight, so ``apply_weighted`` gives it a row without a value.
    """
    fr, fc = source.row_pos(F.col(lat)), source.col_pos(F.col(lon))
    eps = 1e-9
    inside = F.col("_fr").between(-eps, source.nrows - 1 + eps) & F.col("_fc").between(-eps, source.ncols - 1 + eps)
    t = targets.withColumns({"_fr": fr, "_fc": fc}).withColumn("_in", inside)
    near = lambda c, n: F.least(F.greatest(F.ceil(F.col(c) - 0.5).cast("int"), F.lit(0)), F.lit(n - 1))  # noqa: E731  a half goes down
    row, col = near("_fr", source.nrows), near("_fc", source.ncols)
    if method == "nearest":
        return t.select(*targets.columns, row.alias("src_row"), col.alias("src_col"), F.when(F.col("_in"), F.lit(1.0)).alias("weight"))
    if method != "linear":
        raise ValueError('method must be "nearest" or "linear"')

    def sides(pos: str, n: int) -> Column:
        lo = F.least(F.greatest(F.floor(F.col(pos)).cast("int"), F.lit(0)), F.lit(max(n - 2, 0)))
        w = F.col(pos) - lo
        return F.filter(F.array(
            F.struct(lo.alias("i"), (F.lit(1.0) - w).alias("w")),
            F.struct((lo + 1).alias("i"), w.alias("w"))), lambda s: F.abs(s["w"]) > eps)

    corners = F.flatten(F.transform(sides("_fr", source.nrows), lambda r: F.transform(
        sides("_fc", source.ncols), lambda c: F.struct(r["i"].alias("r"), c["i"].alias("c"), (r["w"] * c["w"]).alias("w")))))
    none = F.array(F.struct(row.alias("r"), col.alias("c"), F.lit(None).cast("double").alias("w")))
    return t.withColumn("_k", F.explode(F.when(F.col("_in"), corners).otherwise(none))).select(
        *targets.columns, F.col("_k.r").alias("src_row"), F.col("_k.c").alias("src_col"), F.col("_k.w").alias("weight"))


# --- J11 -----------------------------------------------------------------------------------------
def scatter_index(cells: DataFrame, region: Grid, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Target index of each basin cell on the regional grid (half-even rounding); outside cells drop."""
    col = F.rint((F.col(lon) - region.xll) / region.cellsize).cast("int")
    row = (F.lit(region.nrows) - F.rint((F.col(lat) - region.yll) / region.cellsize)).cast("int")
    return cells.withColumns({"dst_row": row, "dst_col": col}).filter(
        F.col("dst_row").between(0, region.nrows - 1) & F.col("dst_col").between(0, region.ncols - 1))


def scatter(cells: DataFrame, region: Grid, keys: list[str], value: str = "value") -> DataFrame:
    """Basin cells on the regional grid; of several on one target the last in row-major order wins."""
    return scatter_index(cells, region).groupBy(*keys, "dst_row", "dst_col").agg(
        F.max_by(value, F.shiftleft(F.col("row").cast("long"), 32) + F.col("col")).alias(value)  # plain numbers: a hash aggregate
    ).withColumnsRenamed({"dst_row": "row", "dst_col": "col"})


# --- J12 -----------------------------------------------------------------------------------------
def mosaic(cells: DataFrame, keys: list[str], order: str = "domain_order", value: str = "value",
           no_data: float | None = None) -> DataFrame:
    """One value per cell over basins: the last basin with a value wins; the marker counts as missing."""
    v = F.col(value) if no_data is None else F.nullif(F.col(value), F.lit(float(no_data)))
    v = F.when(~F.isnan(v), v)
    return cells.groupBy(*keys, "row", "col").agg(
        F.max_by(v, F.when(v.isNotNull(), F.col(order))).alias(value))


# --- J13 -----------------------------------------------------------------------------------------
def circle_members(points: DataFrame, grid: Grid, km: float = 10.0, lon: str = "lon", lat: str = "lat",
                   mask: DataFrame | None = None, mask_keys: tuple[str, ...] = (), rim: str = "circle") -> DataFrame:
    """Cells whose centre lies within ``km`` of each point, inside the mask.

    The block of cells around a point follows from the radius; only that block is generated.
    ``rim="polygon"`` tests against the 64-sided outline instead of the circle.
    """
    radius = km * 1000.0
    dlat = math.degrees(radius / EARTH_RADIUS_M)
    cosmin = F.greatest(F.cos(F.radians(F.least(F.abs(F.col(lat)) + dlat, F.lit(89.0)))), F.lit(1e-3))
    dlon = F.lit(dlat) / cosmin

    def block(lo_pos: Column, hi_pos: Column, n: int) -> Column:
        lo = F.greatest(F.floor(lo_pos).cast("int"), F.lit(0))
        hi = F.least(F.ceil(hi_pos).cast("int"), F.lit(n - 1))
        return F.when(lo <= hi, F.sequence(lo, hi))

    rows = block(grid.row_pos(F.col(lat) + dlat), grid.row_pos(F.col(lat) - dlat), grid.nrows)
    cols = block(grid.col_pos(F.col(lon) - dlon), grid.col_pos(F.col(lon) + dlon), grid.ncols)
    out = (
        points.withColumns({"_rows": rows, "_cols": cols, "_plon": F.col(lon), "_plat": F.col(lat)})
        .withColumn("row", F.explode("_rows")).withColumn("col", F.explode("_cols")).drop("_rows", "_cols")
        .withColumns({"_clon": grid.lon(F.col("col")), "_clat": grid.lat(F.col("row"))})
    )
    dist = haversine_m(F.col("_plon"), F.col("_plat"), F.col("_clon"), F.col("_clat"))
    if rim == "circle":
        ok = dist < radius
    elif rim == "polygon":
        step = 2 * math.pi / 64
        p1, p2 = F.radians("_plat"), F.radians("_clat")
        dl = F.radians(F.col("_clon") - F.col("_plon"))
        bearing = F.atan2(F.sin(dl) * F.cos(p2), F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl))
        turn = F.pmod(bearing, F.lit(step))
        ok = dist * F.cos(turn - step / 2) < radius * math.cos(step / 2)
    else:
        raise ValueError('rim must be "circle" or "polygon"')
    out = out.filter(ok).drop("_clon", "_clat", "_plon", "_plat")
    if mask is not None:
        keys = [*mask_keys, "row", "col"]
        out = out.join(mask.filter("mask = 1").select(*keys), keys, "left_semi")
    return out


# --- J14 -----------------------------------------------------------------------------------------
def lattice(bounds: DataFrame, km: float = 10.0, axes: str = "swapped") -> DataFrame:
    """Points every ``km`` in Web-Mercator over (x_min, x_max, y_min, y_max) of each row of ``bounds``.

    ``axes="swapped"`` (default) projects latitude on the linear Mercator axis and longitude on the
    stretched one, as the established lattices do; ``"standard"`` projects lon/lat the usual way.
    Point ids run along rows from the northernmost.
    """
    step = km * 1000.0
    if axes == "swapped":
        ax0, ax1 = mercator_y(F.col("x_min")), mercator_y(F.col("x_max"))
        ay0, ay1 = mercator_x(F.col("y_min")), mercator_x(F.col("y_max"))
        to_lon, to_lat = mercator_lat, mercator_lon
    elif axes == "standard":
        ax0, ax1 = mercator_x(F.col("x_min")), mercator_x(F.col("x_max"))
        ay0, ay1 = mercator_y(F.col("y_min")), mercator_y(F.col("y_max"))
        to_lon, to_lat = mercator_lon, mercator_lat
    else:
        raise ValueError('axes must be "swapped" or "standard"')
    nx, ny = F.ceil((ax1 - ax0) / step).cast("int"), F.ceil((ay1 - ay0) / step).cast("int")
    b = bounds.withColumns({"_ax": ax0, "_ay": ay0, "_nx": nx, "_ny": ny}).filter("_nx > 0 AND _ny > 0")
    return (
        b.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_nx") - 1)))
        .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_ny") - 1)))
        .select(
            *bounds.columns,
            ((F.col("_ny") - 1 - F.col("_j")) * F.col("_nx") + F.col("_i")).alias("point_id"),
            to_lon(F.col("_ax") + F.col("_i") * step).alias("lon"),
            to_lat(F.col("_ay") + F.col("_j") * step).alias("lat"))
    )


def nearest_cell(points: DataFrame, grid: Grid, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Row and column of the nearest cell centre; points beyond the edge take the edge cell."""
    pick = lambda pos, n: F.least(F.greatest(F.rint(pos).cast("int"), F.lit(0)), F.lit(n - 1))
    return points.withColumns({
        "row": pick(grid.row_pos(F.col(lat)), grid.nrows), "col": pick(grid.col_pos(F.col(lon)), grid.ncols)})


# --- J15 -----------------------------------------------------------------------------------------
def rasterize(polygons: DataFrame, res: float, code: str = "alert_area_code") -> DataFrame:
    """Cells of resolution ``res`` whose centre lies inside each polygon, on the polygon's own bounding box.

    Scan lines: every edge yields its crossings with the row latitudes, the sorted crossings of a row bound
    the inner stretches, and only their columns are generated. Edges and rows spread over the cluster; the
    outline is never copied per row.
    """
    rings = polygon_rings(polygons.columns)
    vertices = F.flatten(rings)
    xs, ys = F.transform(vertices, lambda v: v["x"]), F.transform(vertices, lambda v: v["y"])
    p = polygons.select(
        code, F.array_min(xs).alias("_x0"), F.array_max(xs).alias("_x1"), F.array_min(ys).alias("_y0"), F.array_max(ys).alias("_y1"),
        F.explode(polygon_edges(rings)).alias("_e"))
    frame = [code, "_x0", "_x1", "_y0", "_n"]
    p = p.withColumn("_n", F.ceil((F.col("_y1") - F.col("_y0")) / res).cast("int"))
    row_of = lambda y: F.col("_n") - 1 - (y - F.col("_y0") - res / 2) / res
    hi, lo = F.greatest("_e.y1", "_e.y2"), F.least("_e.y1", "_e.y2")
    first, last = F.greatest(F.floor(row_of(hi)).cast("int"), F.lit(0)), F.least(F.ceil(row_of(lo)).cast("int"), F.col("_n") - 1)
    lat = F.col("_y0") + res / 2 + (F.col("_n") - 1 - F.col("row")) * res
    cuts = (
        p.withColumn("row", F.explode(F.when(first <= last, F.sequence(first, last))))
        .withColumn("lat", lat)
        .filter(crosses(F.col("_e"), F.col("lat")))
        .groupBy(*frame, "row", "lat").agg(F.array_sort(F.collect_list(cross_x(F.col("_e"), F.col("lat")))).alias("_cut"))
    )
    pairs = F.transform(
        F.sequence(F.lit(0), (F.size("_cut") / 2).cast("int") - 1),
        lambda i: F.struct(F.get("_cut", i * 2).alias("a"), F.get("_cut", i * 2 + 1).alias("b")))
    spans = cuts.withColumn("_s", F.explode(pairs))
    pos = lambda c: (F.col(c) - F.col("_x0") - res / 2) / res
    cols = F.sequence(F.greatest(F.floor(pos("_s.a")).cast("int"), F.lit(0)), F.ceil(pos("_s.b")).cast("int") + 1)
    return (
        spans.withColumn("col", F.explode(cols))
        .withColumn("lon", F.col("_x0") + res / 2 + F.col("col") * res)
        .filter((F.col("lon") >= F.col("_s.a")) & (F.col("lon") < F.col("_s.b")) & (F.col("lon") < F.col("_x1")))
        .select(code, "row", "col", "lon", "lat")
    )


# --- F1 ------------------------------------------------------------------------------------------
def apply_to_slices(cells: DataFrame, function, schema: str, keys: tuple[str, ...] = ("time",)) -> DataFrame:
    """Runs a pandas function on each slice (one grid at one time). For functions without a column form.

    A slice holds one grid, so its size is that of the grid definition, not of the history.
    """
    return cells.groupBy(*keys).applyInPandas(function, schema)
