"""Point events and alert levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geocadence.functions.geo import inside, once, polygon_edges, polygon_rings
from geocadence.functions.text import parse_range, rgba_text
from geocadence.functions.times import calendar_parts, seconds_between
from geocadence.model import ALERT_DEFAULTS, UNKNOWN_RGBA


# --- J1 ------------------------------------------------------------------------------------------
def polygon_bins(polygons: DataFrame, bin_deg: float) -> DataFrame:
    """Each polygon once per bin its bounding box meets, with the edges that matter there.

    A ray towards larger x from a point of the bin can only meet edges that reach the bin's latitudes and
    do not end west of it; the others are left out, so detailed outlines are not copied whole. A bin that no
    edge touches lies inside or outside as a whole: outside it is left out, inside (``_whole``) it needs no edges.
    """
    rings = polygon_rings(polygons.columns)
    vertices = F.flatten(rings)
    xs, ys = F.transform(vertices, lambda v: v["x"]), F.transform(vertices, lambda v: v["y"])
    p = polygons.withColumns({
        "_all": polygon_edges(rings), "_x0": F.array_min(xs), "_x1": F.array_max(xs), "_y0": F.array_min(ys), "_y1": F.array_max(ys),
    }).drop("ring", "rings")
    b = lambda c: F.floor(F.col(c) / bin_deg)
    slack = bin_deg * 1e-6
    south, north, west = F.col("_by") * bin_deg - slack, (F.col("_by") + 1) * bin_deg + slack, F.col("_bx") * bin_deg - slack
    near = F.filter("_all", lambda e: (F.greatest(e["y1"], e["y2"]) >= south) & (F.least(e["y1"], e["y2"]) <= north)
                    & (F.greatest(e["x1"], e["x2"]) >= west))
    cx, cy, half = (F.col("_bx") + 0.5) * bin_deg, (F.col("_by") + 0.5) * bin_deg, bin_deg / 2 + slack
    # an edge misses a square that is east or west of it, or wholly on one side of its line
    touched = lambda edges: F.exists(edges, lambda e: (F.least(e["x1"], e["x2"]) <= cx + half) & (
        F.abs((e["x2"] - e["x1"]) * (cy - e["y1"]) - (e["y2"] - e["y1"]) * (cx - e["x1"]))
        <= half * (F.abs(e["x2"] - e["x1"]) + F.abs(e["y2"] - e["y1"]))))

    def kept(edges: Column) -> Column:
        """At most one (edges, whole) of a bin, none if the bin is wholly outside."""
        part = lambda e, whole: F.array(F.struct(e.alias("_edges"), F.lit(whole).alias("_whole")))
        none = F.slice(part(edges, False), 1, 0)
        return F.when(touched(edges), part(edges, False)).when(inside(edges, cx, cy), part(F.when(F.lit(False), edges), True)).otherwise(none)

    return (
        p.withColumn("_bx", F.explode(F.sequence(b("_x0"), b("_x1"))))
        .withColumn("_by", F.explode(F.sequence(b("_y0"), b("_y1"))))
        .select("*", F.inline(once(near, kept))).drop("_all")  # a generator: edges are found once for the test and the result
    )


def locate_points(points: DataFrame, polygons: DataFrame, lon: str = "lon", lat: str = "lat",
                  bin_deg: float = 0.25, code: str = "alert_area_code") -> DataFrame:
    """Point in polygon, left, boundary excluded; a point in k polygons yields k rows.

    An equi-join on bins of ``bin_deg`` degrees, then exact ray casting in the join condition, but for bins wholly inside.
    A bin may hold most of the points: polygons that Spark finds small are broadcast, and in the shuffled join adaptive
    execution splits a bin by the bytes it measured (points are the side it may split).
    """
    right = polygon_bins(polygons, bin_deg).withColumnRenamed(code, "_code")
    left = points.withColumns({"_px": F.floor(F.col(lon) / bin_deg), "_py": F.floor(F.col(lat) / bin_deg)})
    x, y = F.col(lon), F.col(lat)
    match = (
        (F.col("_px") == F.col("_bx")) & (F.col("_py") == F.col("_by"))
        & x.between(F.col("_x0"), F.col("_x1")) & y.between(F.col("_y0"), F.col("_y1"))
        & (F.col("_whole") | inside(F.col("_edges"), x, y))
    )
    return left.join(right, match, "left").select(
        *[F.col(f"`{c}`") for c in points.columns], F.col("_code").alias(f"{code}_polygon"))


# --- J2 / J3 -------------------------------------------------------------------------------------
def join_groups(registry: DataFrame, groups: DataFrame, name: str = "name") -> DataFrame:
    """J2. Registry with its group settings, only names present in both."""
    return registry.join(groups, name, "inner")


def attach_label(df: DataFrame, registry: DataFrame, code: str = "alert_area_code",
                 label: str = "alert_area_label") -> DataFrame:
    """J3. Area label by code; unknown codes keep NULL. ``registry`` has name and alert_area."""
    lookup = registry.select(F.col("alert_area").alias(code), F.col("name").alias(label))
    return df.join(lookup, code, "left")


# --- registry of levels --------------------------------------------------------------------------
LEVELS = ("white", "green", "yellow", "orange", "red")  # fixed values, in order of severity


def level_table(registry: DataFrame, name: str = "name") -> DataFrame:
    """Range texts ``{level}_range`` of the registry as ordered rows (name, ord, level, lo, hi)."""
    items = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(lv).alias("level"), parse_range(F.col(f"{lv}_range")).alias("r"))
        for i, lv in enumerate(LEVELS)])
    return registry.select(name, F.explode(items).alias("_i")).select(
        name, F.col("_i.ord").alias("ord"), F.col("_i.level").alias("level"),
        F.col("_i.r.lo").alias("lo"), F.col("_i.r.hi").alias("hi"))


def _level_arrays(levels: DataFrame, name: str) -> DataFrame:
    """One row per area holding its (five) ordered ranges."""
    return levels.groupBy(name).agg(F.array_sort(F.collect_list(F.struct("ord", "level", "lo", "hi"))).alias("_levels"))


def matching_level(count: Column, levels: Column) -> Column:
    """First range that holds the count; an open upper bound is NULL; no range gives NULL."""
    return F.get(F.filter(levels, lambda r: (r["lo"] <= count) & (r["hi"].isNull() | (count <= r["hi"]))), F.lit(0))["level"]


# --- C1 ------------------------------------------------------------------------------------------
def classify_by_area(df: DataFrame, levels: DataFrame, count: str, area: str = "alert_area_label",
                     name: str = "name") -> DataFrame:
    """Level by the ranges of the row's own area: an equi-join with one row per area, no range join."""
    arrays = _level_arrays(levels, name).withColumnRenamed(name, area)
    return (
        df.join(arrays, area, "left")
        .withColumn("alert_color", F.coalesce(matching_level(F.col(count), F.col("_levels")), F.lit("unknown")))
        .withColumn("alert_range", F.when(F.col("alert_color") == "unknown", F.lit("unknown"))
                    .otherwise(F.concat("alert_color", F.lit("_range"))))
        .drop("_levels")
    )


# --- C2 / C3 -------------------------------------------------------------------------------------
def classify_default(df: DataFrame, count: str, prefix: str = "slip_alert", ranges=None) -> DataFrame:
    """Id, colour and rgba text of a predicted count; outside every range id and colour are NULL."""
    return _described(df, count, _default_levels(ranges or ALERT_DEFAULTS), prefix)


def classify_predicted(df: DataFrame, count: str, levels: DataFrame | None = None, prefix: str = "slip_alert", area: str = "area",
                       name: str = "name", defaults=None) -> DataFrame:
    """Id, colour and rgba text of a predicted count by the ranges of the row's own area.

    ``levels``: (name, ord, level, lo, hi) rows, optionally with ``id`` and ``rgba``; what an area's ranges lack of these
    is taken from the default of that level. Areas without ranges use the defaults. A missing count has no level.
    """
    default = _default_levels(defaults or ALERT_DEFAULTS)
    if levels is None:
        return _described(df, count, default, prefix)
    usual = {level: (level_id, rgba) for level, _, _, level_id, rgba in defaults or ALERT_DEFAULTS}
    by_level = lambda i: F.create_map(*[F.lit(x) for level, v in usual.items() for x in (level, v[i])])[F.col("level")]
    known = levels.withColumns({
        "id": F.coalesce(F.col("id").cast("int"), by_level(0)) if "id" in levels.columns else by_level(0),
        "rgba": F.coalesce("rgba", by_level(1)) if "rgba" in levels.columns else by_level(1)})
    entry = F.struct("ord", "level", F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"), "id", "rgba")
    own = known.groupBy(F.col(name).alias(area)).agg(F.array_sort(F.collect_list(entry)).alias("_own"))  # five rows per area
    out = _described(df.join(own, area, "left"), count, F.coalesce("_own", default), prefix)
    return out.drop("_own")


def _default_levels(ranges) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(level).alias("level"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"),
                              F.lit(level_id).alias("id"), F.lit(rgba).alias("rgba")) for i, (level, lo, hi, level_id, rgba) in enumerate(ranges)])


def _described(df: DataFrame, count: str, levels: Column, prefix: str) -> DataFrame:
    c = F.col(count)
    hit = F.get(F.filter(levels, lambda r: (r["lo"] <= c) & (r["hi"].isNull() | (c <= r["hi"]))), F.lit(0))
    rows = df.withColumn("_hit", hit)
    return rows.withColumns({
        f"{prefix}_id": F.col("_hit.id"), f"{prefix}_color": F.col("_hit.level"),
        f"{prefix}_rgba": F.coalesce(F.col("_hit.rgba"), F.lit(UNKNOWN_RGBA))}).drop("_hit")


# --- A1 ------------------------------------------------------------------------------------------
def count_slips(points: DataFrame, registry: DataFrame, levels: DataFrame, colors: DataFrame | None = None,
                code_source: str = "catalogue", time: str = "time", code: str = "alert_area_code") -> DataFrame:
    """Events per day and area with label, level, id, colour and calendar parts.

    ``code_source`` chooses the catalogue's own area code or the one found by ``locate_points``.
    ``colors`` holds (level, id, r, g, b, opacity).
    """
    if code_source not in ("catalogue", "polygon"):
        raise ValueError('code_source must be "catalogue" or "polygon"')
    src = code if code_source == "catalogue" else f"{code}_polygon"
    day = F.col(time).cast("date")
    counts = (
        points.select(day.alias("time"), F.col(src).alias(code)).na.drop()
        .groupBy("time", code).agg(F.count(F.lit(1)).alias("soil_slips"))
    )
    out = classify_by_area(attach_label(counts, registry, code), levels, "soil_slips")
    if colors is not None:
        out = out.join(colors.withColumnRenamed("level", "alert_color"), "alert_color", "left").withColumn(
            "alert_rgb", rgba_text(F.col("r"), F.col("g"), F.col("b"), F.col("opacity"))).drop("r", "g", "b", "opacity")
    parts = calendar_parts(F.col("time"))
    return out.withColumns({k: parts[k] for k in ("year", "month", "day")})


# --- C5 ------------------------------------------------------------------------------------------
def freshness_gate(df: DataFrame, max_hours: float | None, mtime: str = "mtime", oldest: str = "oldest",
                   run: str = "run_time") -> DataFrame:
    """Keeps or rejects a file by the age against its anchor.

    The anchor is the oldest file time of the run for files not newer than it, else the run time.
    Files dated after the run time are rejected. Without a limit every file is kept.
    """
    m, o, r = F.col(mtime), F.col(oldest), F.col(run)
    if max_hours is None:
        return df.withColumns({"anchor": F.lit("no_gate"), "age_seconds": F.lit(None).cast("double"), "keep": F.lit(True)})
    by_oldest = o.isNotNull() & (m <= o)
    age = F.when(by_oldest, seconds_between(m, o)).otherwise(seconds_between(m, r))
    anchor = (
        F.when(by_oldest, F.lit("oldest_sf_time"))
        .when(seconds_between(m, r) < 0, F.lit("run_time_future")).otherwise(F.lit("run_time"))
    )
    return df.withColumns({"anchor": anchor, "age_seconds": age}).withColumn(
        "keep", F.coalesce(F.col("age_seconds").between(0, max_hours * 3600.0), F.lit(False)))
