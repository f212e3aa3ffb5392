"""Grid and spatial queries: F1, J8-J15, S16."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from geocadence.catalog.registry import SQL_CELL_HOURS, Tables, big, cell_hours, query, r6, text
from geocadence.functions.geo import Grid
from geocadence.operators import grid as G
from geocadence.operators.swath import swath_map

# A coarse source grid of 8 x 8 cells over the plane of the embedding entries, moved to 44 N 8 E.
SOURCE = Grid(nrows=8, ncols=8, xll=7.6, yll=43.6, cellsize=0.1)
_R = 6371000.0
_HAV = ("2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b})) "
        "* pow(sin(radians({d} - {c}) / 2), 2))))")


def hav(lon1, lat1, lon2, lat2):
    return _HAV.format(a=lat1, b=lat2, c=lon1, d=lon2)


def _points(t: Tables):
    """Targets: one point per embedding, spread over the grid."""
    return t.embeddings.select(
        "vec_id", (F.get("embedding", F.lit(0)).cast("double") + 8.0).alias("lon"), (F.get("embedding", F.lit(1)).cast("double") + 44.0).alias("lat"), "label")


SQL_POINTS = "points AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) + 8.0::DOUBLE AS lon, CAST(embedding[2] AS DOUBLE) + 44.0::DOUBLE AS lat, label FROM embeddings)"
SQL_SOURCE = """src AS (SELECT r AS row, c AS col, 7.65::DOUBLE + c * 0.1::DOUBLE AS lon, 44.35::DOUBLE - r * 0.1::DOUBLE AS lat FROM range(0, 8) a(r), range(0, 8) b(c))"""


def _values(t: Tables):
    """Source cells: hourly sums of events, user_id % 64 names the cell."""
    from geocadence.catalog.registry import cents
    from geocadence.functions.times import hour_floor
    cell = F.pmod("user_id", F.lit(64)).cast("int")
    e = t.events.select(F.floor(cell / 8).cast("int").alias("row"), F.pmod(cell, F.lit(8)).alias("col"),
                        (F.floor(F.hour("ts") / 12)).cast("int").alias("half"), cents().alias("c"))
    return e.groupBy("half", "row", "col").agg((F.sum("c") / 100.0).alias("value"))


SQL_VALUES = """vals AS (SELECT CAST(hour(ts) // 12 AS INTEGER) AS half, CAST((user_id % 64) // 8 AS INTEGER) AS row, CAST(user_id % 8 AS INTEGER) AS col,
  SUM(CAST(round(value * 100) AS BIGINT)) / 100.0 AS value FROM events GROUP BY 1, 2, 3)"""


@query("j8_nearest_regrid_map", f"""
WITH {SQL_POINTS}, {SQL_SOURCE}, d AS (SELECT vec_id, row, col, {hav('p.lon', 'p.lat', 's.lon', 's.lat')} AS dist FROM points p, src s)
SELECT vec_id, row AS src_row, col AS src_col, round(dist + 1e-9, 3) AS dist_m FROM d WHERE dist <= 25000 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, row, col) = 1""")
def j8(t: Tables):
    m = G.regrid_map(_points(t), SOURCE)
    return m.select("vec_id", big("src_row").alias("src_row"), big("src_col").alias("src_col"), F.round(F.col("dist_m") + 1e-9, 3).alias("dist_m"))


@query("j8_nearest_regrid", f"""
WITH {SQL_POINTS}, {SQL_SOURCE}, {SQL_VALUES}, d AS (SELECT vec_id, row, col, {hav('p.lon', 'p.lat', 's.lon', 's.lat')} AS dist FROM points p, src s),
m AS (SELECT * FROM d WHERE dist <= 25000 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, row, col) = 1)
SELECT half, vec_id, value FROM m JOIN vals USING (row, col)""")
def j8_apply(t: Tables):
    return G.apply_nearest(_values(t), G.regrid_map(_points(t), SOURCE), ["half"], ["vec_id"])


@query("j9_weighted_regrid", f"""
WITH {SQL_POINTS}, {SQL_SOURCE}, {SQL_VALUES}, d AS (SELECT vec_id, row, col, {hav('p.lon', 'p.lat', 's.lon', 's.lat')} AS dist FROM points p, src s),
m AS (SELECT *, 1 / (1 + dist) AS w FROM d WHERE dist <= 25000 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, row, col) <= 4)
SELECT half, vec_id, round(SUM(w * value) / SUM(w) + 1e-9, 6) AS value FROM m JOIN vals USING (row, col) GROUP BY half, vec_id""")
def j9(t: Tables):
    m = G.regrid_map(_points(t), SOURCE, k=4).withColumn("weight", 1 / (1 + F.col("dist_m")))
    return G.apply_weighted(_values(t), m, ["half"], ["vec_id"]).withColumn("value", r6("value"))


@query("j9_many_neighbours", f"""
WITH {SQL_POINTS}, {SQL_SOURCE}, {SQL_VALUES}, moved AS (SELECT vec_id, lon + (vec_id % 3 - 1) * 0.9::DOUBLE AS lon, lat + (vec_id % 5 - 2) * 0.3::DOUBLE AS lat FROM points),
d AS (SELECT vec_id, row, col, {hav('p.lon', 'p.lat', 's.lon', 's.lat')} AS dist FROM moved p, src s),
m AS (SELECT *, 1 / (1 + dist) AS w FROM d WHERE dist <= 150000 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, row, col) <= 20)
SELECT half, vec_id, round(SUM(w * value) / SUM(w) + 1e-9, 6) AS value FROM m JOIN vals USING (row, col) GROUP BY half, vec_id""")
def j9_many(t: Tables):
    moved = _points(t).withColumns({"lon": F.col("lon") + (F.pmod("vec_id", F.lit(3)) - 1) * 0.9, "lat": F.col("lat") + (F.pmod("vec_id", F.lit(5)) - 2) * 0.3})
    m = G.regrid_map(moved, SOURCE, k=20, radius_m=150000.0).withColumn("weight", 1 / (1 + F.col("dist_m")))
    return G.apply_weighted(_values(t), m, ["half"], ["vec_id"]).withColumn("value", r6("value"))


def _swath(t: Tables):
    """A cell per customer on bent lines of uneven distance: rows of 40 cells."""
    row, col = F.floor(F.col("c_custkey") / 40).cast("int"), F.pmod("c_custkey", F.lit(40)).cast("int")
    return t.customer.select(
        row.alias("row"), col.alias("col"), (F.lit(7.6) + col * 0.02 + F.pmod(row, F.lit(3)) * 0.013).alias("lon"),
        (F.lit(44.4) - big(row) * big(row) * 0.0005 - F.pmod(col, F.lit(4)) * 0.011).alias("lat"), F.col("c_acctbal").alias("value"))


SQL_SWATH = f"""sw AS (SELECT c_custkey // 40 AS row, c_custkey % 40 AS col, c_acctbal AS value,
  7.6::DOUBLE + (c_custkey % 40) * 0.02::DOUBLE + (c_custkey // 40 % 3) * 0.013::DOUBLE AS lon, 44.4::DOUBLE - (c_custkey // 40) * (c_custkey // 40) * 0.0005::DOUBLE - (c_custkey % 40 % 4) * 0.011::DOUBLE AS lat FROM customer),
d AS (SELECT vec_id, row, col, value, {hav('p.lon', 'p.lat', 's.lon', 's.lat')} AS dist FROM points p, sw s)"""


@query("j8_uneven_grid", f"""
WITH {SQL_POINTS}, {SQL_SWATH} SELECT vec_id, row AS src_row, col AS src_col, round(dist + 1e-9, 3) AS dist_m, value FROM d
WHERE dist <= 25000 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, row, col) = 1""")
def j8_uneven(t: Tables):
    m = swath_map(_points(t), _swath(t), ["vec_id"])
    moved = G.apply_nearest(_swath(t), m, [], ["vec_id"])
    return m.join(moved, "vec_id").select("vec_id", big("src_row").alias("src_row"), big("src_col").alias("src_col"), F.round(F.col("dist_m") + 1e-9, 3).alias("dist_m"), "value")


@query("j9_uneven_grid", f"""
WITH {SQL_POINTS}, {SQL_SWATH}, m AS (SELECT *, 1 / (1 + dist) AS w FROM d WHERE dist <= 30000 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, row, col) <= 6)
SELECT vec_id, round(SUM(w * value) / SUM(w) + 1e-9, 6) AS value FROM m GROUP BY vec_id""")
def j9_uneven(t: Tables):
    m = swath_map(_points(t), _swath(t), ["vec_id"], k=6, radius_m=30000.0).withColumn("weight", 1 / (1 + F.col("dist_m")))
    return G.apply_weighted(_swath(t), m, [], ["vec_id"]).withColumn("value", r6("value"))


_FR, _FC = "(44.35::DOUBLE - lat) / 0.1::DOUBLE", "(lon - 7.65::DOUBLE) / 0.1::DOUBLE"


@query("j10_resample_nearest", f"""
WITH {SQL_POINTS}, {SQL_VALUES}, f AS (SELECT vec_id, {_FR} AS fr, {_FC} AS fc FROM points),
m AS (SELECT vec_id, least(greatest(CAST(ceil(fr - 0.5) AS INTEGER), 0), 7) AS row, least(greatest(CAST(ceil(fc - 0.5) AS INTEGER), 0), 7) AS col, fr BETWEEN 0 AND 7 AND fc BETWEEN 0 AND 7 AS inside FROM f)
SELECT half, vec_id, CASE WHEN inside THEN value END AS value FROM m JOIN vals USING (row, col)""")
def j10_nearest(t: Tables):
    m = G.resample_map(_points(t), SOURCE, "nearest")  # points outside keep a row without a value
    return G.apply_weighted(_values(t), m, ["half"], ["vec_id"])


@query("j10_resample_linear", f"""
WITH {SQL_POINTS}, {SQL_VALUES}, f AS (SELECT vec_id, {_FR} AS fr, {_FC} AS fc FROM points), g AS (SELECT *, least(floor(fr), 6) AS r0, least(floor(fc), 6) AS c0 FROM f WHERE fr BETWEEN 0 AND 7 AND fc BETWEEN 0 AND 7),
k AS (SELECT vec_id, CAST(r0 + a AS INTEGER) AS row, CAST(c0 + b AS INTEGER) AS col, (CASE a WHEN 0 THEN 1 - (fr - r0) ELSE fr - r0 END) * (CASE b WHEN 0 THEN 1 - (fc - c0) ELSE fc - c0 END) AS w FROM g, range(0, 2) x(a), range(0, 2) y(b))
SELECT half, vec_id, round(SUM(w * value) + 1e-9, 6) AS value FROM k JOIN vals USING (row, col) GROUP BY half, vec_id HAVING COUNT(*) = 4""")
def j10_linear(t: Tables):
    m = G.resample_map(_points(t), SOURCE, "linear")
    values = _values(t)
    full = values.select("half").distinct().withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(7)))) \
        .withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(7))))
    dense = full.join(values, ["half", "row", "col"], "left")
    return G.apply_weighted(dense, m, ["half"], ["vec_id"]).filter("value IS NOT NULL").withColumn("value", r6("value"))


REGION = Grid(nrows=20, ncols=20, xll=7.7, yll=43.7, cellsize=0.03)
_SCATTER = f"""{SQL_POINTS}, idx AS (SELECT vec_id, label, CAST(round_even((lon - 7.7::DOUBLE) / 0.03::DOUBLE, 0) AS INTEGER) AS c, 20 - CAST(round_even((lat - 43.7::DOUBLE) / 0.03::DOUBLE, 0) AS INTEGER) AS r FROM points)"""


def _basin_cells(t: Tables):
    """Basin cells: embeddings as irregular cells of ten basins (label)."""
    p = _points(t)
    return p.select(F.col("label").alias("domain"), F.col("vec_id").cast("int").alias("row"), F.lit(0).alias("col"), "lon", "lat",
                    F.when(F.pmod("vec_id", F.lit(6)) != 0, F.col("vec_id").cast("double")).alias("value"))


@query("j11_scatter", f"""
WITH {_SCATTER} SELECT CAST(label AS BIGINT) AS domain, CAST(r AS BIGINT) AS row, CAST(c AS BIGINT) AS col, CASE WHEN MAX(vec_id) % 6 <> 0 THEN CAST(MAX(vec_id) AS DOUBLE) END AS value
FROM idx WHERE r BETWEEN 0 AND 19 AND c BETWEEN 0 AND 19 GROUP BY label, r, c""")
def j11(t: Tables):
    out = G.scatter(_basin_cells(t), REGION, ["domain"])
    return out.select(*[big(c).alias(c) for c in ("domain", "row", "col")], "value")


@query("j12_mosaic", f"""
WITH {_SCATTER}, s AS (SELECT label, r, c, CASE WHEN MAX(vec_id) % 6 <> 0 THEN CAST(MAX(vec_id) AS DOUBLE) END AS v FROM idx WHERE r BETWEEN 0 AND 19 AND c BETWEEN 0 AND 19 GROUP BY label, r, c)
SELECT CAST(r AS BIGINT) AS row, CAST(c AS BIGINT) AS col, arg_max(v, label) FILTER (v IS NOT NULL AND v <> 101) AS value FROM s GROUP BY r, c""")
def j12(t: Tables):
    placed = G.scatter(_basin_cells(t), REGION, ["domain"]).withColumn("domain_order", F.col("domain"))
    out = G.mosaic(placed, [], no_data=101.0)
    return out.select(big("row").alias("row"), big("col").alias("col"), "value")


FINE = Grid(nrows=40, ncols=40, xll=7.6, yll=43.6, cellsize=0.02)
SQL_FINE = "fine AS (SELECT r AS row, c AS col, 7.61::DOUBLE + c * 0.02::DOUBLE AS lon, 44.39::DOUBLE - r * 0.02::DOUBLE AS lat, (r * 40 + c) % 7 <> 0 AS m FROM range(0, 40) a(r), range(0, 40) b(c))"


def _fine_mask(t: Tables):
    return G.grid_cells(t.spark, FINE).select("row", "col", F.when(F.pmod(F.col("row") * 40 + F.col("col"), F.lit(7)) != 0, 1).otherwise(0).alias("mask"))


@query("j13_circle_members", f"""
WITH {SQL_POINTS}, {SQL_FINE} SELECT vec_id, CAST(f.row AS BIGINT) AS row, CAST(f.col AS BIGINT) AS col FROM points p, fine f
WHERE m AND {hav('p.lon', 'p.lat', 'f.lon', 'f.lat')} < 4000""")
def j13(t: Tables):
    out = G.circle_members(_points(t), FINE, km=4.0, mask=_fine_mask(t))
    return out.select("vec_id", big("row").alias("row"), big("col").alias("col"))


@query("j13_circle_members_outline", f"""
WITH {SQL_POINTS}, {SQL_FINE}, d AS (SELECT vec_id, f.row, f.col, {hav('p.lon', 'p.lat', 'f.lon', 'f.lat')} AS dist,
  atan2(sin(radians(f.lon - p.lon)) * cos(radians(f.lat)), cos(radians(p.lat)) * sin(radians(f.lat)) - sin(radians(p.lat)) * cos(radians(f.lat)) * cos(radians(f.lon - p.lon))) AS az FROM points p, fine f),
u AS (SELECT *, az + 2 * pi() - floor((az + 2 * pi()) / (pi() / 32)) * (pi() / 32) AS turn FROM d)
SELECT vec_id, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col FROM u WHERE dist * cos(turn - pi() / 64) < 4000 * cos(pi() / 64)""")
def j13_outline(t: Tables):
    out = G.circle_members(_points(t), FINE, km=4.0, rim="polygon")
    return out.select("vec_id", big("row").alias("row"), big("col").alias("col"))


def _bounds(t: Tables):
    return _points(t).groupBy("label").agg(F.min("lon").alias("x_min"), F.max("lon").alias("x_max"), F.min("lat").alias("y_min"), F.max("lat").alias("y_max"))


_MY = "ln(tan(pi() / 4 + radians({0}) / 2)) * 6378137.0"
_LATTICE = """
WITH {points}, b AS (SELECT label, MIN(lon) AS x0, MAX(lon) AS x1, MIN(lat) AS y0, MAX(lat) AS y1 FROM points GROUP BY label),
p AS (SELECT label, {ax0} AS ax, {ay0} AS ay, CAST(ceil(({ax1} - {ax0}) / 10000) AS INTEGER) AS nx, CAST(ceil(({ay1} - {ay0}) / 10000) AS INTEGER) AS ny FROM b),
e AS (SELECT label, ax, ay, nx, ny, i, unnest(range(0, ny)) AS j FROM (SELECT *, unnest(range(0, nx)) AS i FROM p))
SELECT CAST(label AS BIGINT) AS label, (ny - 1 - j) * nx + i AS point_id, round({lon} + 1e-9, 6) AS lon, round({lat} + 1e-9, 6) AS lat FROM e"""


@query("j14_lattice", _LATTICE.format(
    points=SQL_POINTS, ax0=_MY.format("x0"), ax1=_MY.format("x1"), ay0="radians(y0) * 6378137.0", ay1="radians(y1) * 6378137.0",
    lon="degrees(2 * atan(exp((ax + i * 10000) / 6378137.0)) - pi() / 2)", lat="degrees((ay + j * 10000) / 6378137.0)"))
def j14(t: Tables):
    out = G.lattice(_bounds(t), 10.0)
    return out.select(big("label").alias("label"), big("point_id").alias("point_id"), r6("lon").alias("lon"), r6("lat").alias("lat"))


@query("j14_lattice_standard", _LATTICE.format(
    points=SQL_POINTS, ax0="radians(x0) * 6378137.0", ax1="radians(x1) * 6378137.0", ay0=_MY.format("y0"), ay1=_MY.format("y1"),
    lon="degrees((ax + i * 10000) / 6378137.0)", lat="degrees(2 * atan(exp((ay + j * 10000) / 6378137.0)) - pi() / 2)"))
def j14_standard(t: Tables):
    out = G.lattice(_bounds(t), 10.0, axes="standard")
    return out.select(big("label").alias("label"), big("point_id").alias("point_id"), r6("lon").alias("lon"), r6("lat").alias("lat"))


@query("j14_lattice_mask", f"""
WITH {SQL_POINTS}, i AS (SELECT vec_id, least(greatest(CAST(round_even((44.39::DOUBLE - lat) / 0.02::DOUBLE, 0) AS INTEGER), 0), 39) AS r, least(greatest(CAST(round_even((lon - 7.61::DOUBLE) / 0.02::DOUBLE, 0) AS INTEGER), 0), 39) AS c FROM points)
SELECT vec_id FROM i WHERE (r * 40 + c) % 7 <> 0""")
def j14_mask(t: Tables):
    near = G.nearest_cell(_points(t), FINE)
    return G.mask_cells(near, _fine_mask(t), drop=True).select("vec_id")


def _label_shapes(t: Tables):
    """One five-cornered shape per label, from the extremes of its points."""
    p = _points(t)
    v = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    b = p.groupBy("label").agg(F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.min("lat").alias("y0"), F.max("lat").alias("y1"))
    mid = (F.col("x0") * 0.4 + F.col("x1") * 0.6)
    return b.select("label", F.array(
        v(F.col("x0"), F.col("y0")), v(F.col("x1"), F.col("y0") + 0.013), v(F.col("x1") - 0.07, F.col("y1")),
        v(mid, (F.col("y0") + F.col("y1")) / 2), v(F.col("x0") + 0.031, F.col("y1") - 0.017)).alias("ring"))


_SHAPES = f"""{SQL_POINTS}, b AS (SELECT label, MIN(lon) AS x0, MAX(lon) AS x1, MIN(lat) AS y0, MAX(lat) AS y1 FROM points GROUP BY label),
v AS (SELECT label, 0 AS k, x0 AS x, y0 AS y FROM b UNION ALL SELECT label, 1, x1, y0 + 0.013::DOUBLE FROM b UNION ALL SELECT label, 2, x1 - 0.07::DOUBLE, y1 FROM b
  UNION ALL SELECT label, 3, x0 * 0.4::DOUBLE + x1 * 0.6::DOUBLE, (y0 + y1) / 2 FROM b UNION ALL SELECT label, 4, x0 + 0.031::DOUBLE, y1 - 0.017::DOUBLE FROM b),
e AS (SELECT a.label, a.x AS xa, a.y AS ya, c.x AS xb, c.y AS yb FROM v a JOIN v c ON a.label = c.label AND c.k = (a.k + 1) % 5),
n AS (SELECT label, x0, x1, y0, CAST(ceil((y1 - y0) / 0.02::DOUBLE) AS INTEGER) AS nr, CAST(ceil((x1 - x0) / 0.02::DOUBLE) AS INTEGER) AS nc FROM b),
g AS (SELECT label, r, unnest(range(0, nc)) AS c, x0, y0, nr FROM (SELECT *, unnest(range(0, nr)) AS r FROM n)),
q AS (SELECT label, r, c, x0 + 0.01::DOUBLE + c * 0.02::DOUBLE AS lon, y0 + 0.01::DOUBLE + (nr - 1 - r) * 0.02::DOUBLE AS lat FROM g)"""


@query("j15_rasterize", f"""
WITH {_SHAPES} SELECT CAST(q.label AS BIGINT) AS label, q.r AS row, q.c AS col FROM q JOIN e ON e.label = q.label
GROUP BY q.label, q.r, q.c HAVING SUM(CASE WHEN (ya > lat) <> (yb > lat) AND lon < xa + (lat - ya) / (yb - ya) * (xb - xa) THEN 1 ELSE 0 END) % 2 = 1""")
def j15(t: Tables):
    out = G.rasterize(_label_shapes(t), 0.02, code="label")
    return out.select(*[big(c).alias(c) for c in ("label", "row", "col")])


@query("s16_reference_grids", """
WITH d AS (SELECT CAST(c_custkey AS VARCHAR) AS grid, c_custkey % 4 + 2 AS nr, c_custkey % 3 + 2 AS nc, 7.0::DOUBLE + c_custkey AS x, 40.0::DOUBLE + c_nationkey AS y, 0.5::DOUBLE AS cs FROM customer),
r AS (SELECT *, unnest(range(0, nr)) AS r FROM d), c AS (SELECT *, unnest(range(0, nc)) AS c FROM r)
SELECT grid, r AS row, c AS col, x + cs / 2 + c * cs AS lon, y + cs / 2 + (nr - 1 - r) * cs AS lat, CAST(1 AS BIGINT) AS value FROM c""")
def s16(t: Tables):
    k = F.col("c_custkey")
    defs = t.customer.select(
        k.cast("string").alias("grid"), (F.pmod(k, F.lit(4)) + 2).alias("nrows"), (F.pmod(k, F.lit(3)) + 2).alias("ncols"),
        (k + F.lit(7.0)).alias("xllcorner"), (F.col("c_nationkey") + F.lit(40.0)).alias("yllcorner"), F.lit(0.5).alias("cellsize"))
    return G.cells_of_definitions(defs).select("grid", big("row").alias("row"), big("col").alias("col"), "lon", "lat", big("value").alias("value"))


@query("f1_slice_function", f"""
WITH {SQL_CELL_HOURS} SELECT CAST(time AS VARCHAR) AS time, area, cell, round(value - MIN(value) OVER (PARTITION BY time) + 1e-9, 6) AS value FROM cell_hours""")
def f1(t: Tables):
    def above_least(pdf):
        return pdf.assign(value=pdf["value"] - pdf["value"].min())
    out = G.apply_to_slices(cell_hours(t).select("time", "area", "cell", "value"), above_least, "time timestamp_ntz, area string, cell int, value double")
    return out.select(text("time").alias("time"), "area", "cell", r6("value").alias("value"))
