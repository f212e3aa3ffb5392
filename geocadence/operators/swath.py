"""Nearest cells of grids that are given by coordinates: uneven axes or a longitude and latitude per cell.

Places are hashed into cubes of the earth-centred space, which know no date line and no poles. Cubes of all sizes are nested, and a
target uses the smallest one around it that holds k cells: the k-th nearest of those bounds how far it has to look, and
the cubes of that size within the bound hold its neighbours for certain.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geocadence.functions.geo import haversine_m
from geocadence.model import EARTH_RADIUS_M
from geocadence.session import discard, stored

LEVELS = 12  # the finest cubes are 2**12 times smaller than the radius, but not below a metre
SLACK_M = 0.01  # far above the rounding of places and distances
_AXES = ("_x", "_y", "_z")  # number of the finest cube
_CUBE = ("_cx", "_cy", "_cz")  # of the cube of some level


def _place(lon: Column, lat: Column, side: float) -> list[Column]:
    """Earth-centred coordinates, in sides of the finest cubes."""
    lam, phi, scale = F.radians(lon), F.radians(lat), F.lit(EARTH_RADIUS_M / side)
    return [F.cos(phi) * F.cos(lam) * scale, F.cos(phi) * F.sin(lam) * scale, F.sin(phi) * scale]


def _known(lon: Column, lat: Column) -> Column:
    return (F.abs(lon) < float("inf")) & (F.abs(lat) < float("inf"))  # neither null nor NaN


def _up(number: Column, level: Column) -> Column:
    return F.call_function("shiftright", number, level)


def _at_level(df: DataFrame, level: Column) -> DataFrame:
    return df.withColumns({c: _up(F.col(a), level) for a, c in zip(_AXES, _CUBE)})


def _within(df: DataFrame, level: Column, reach_m: Column, side: float) -> DataFrame:
    """A row per target and cube of the level that is within reach and touched by the surface of the earth."""
    far = (reach_m + SLACK_M) / side
    for c, u in zip(_CUBE, _place(F.col("_tlon"), F.col("_tlat"), side)):
        df = df.withColumn(c, F.explode(F.sequence(_up(F.floor(u - far), level), _up(F.floor(u + far), level))))
    width, radius, slack = F.pow(F.lit(2.0), level), EARTH_RADIUS_M / side, SLACK_M / side
    low, high = [F.col(c) * width for c in _CUBE], [(F.col(c) + 1) * width for c in _CUBE]
    nearest = sum(F.pow(F.greatest(lo, -hi, F.lit(0.0)), F.lit(2.0)) for lo, hi in zip(low, high))
    farthest = sum(F.pow(F.greatest(F.abs(lo), F.abs(hi)), F.lit(2.0)) for lo, hi in zip(low, high))
    return df.filter((nearest <= (radius + slack) ** 2) & (farthest >= max(0.0, radius - slack) ** 2))


def _distances(asked: DataFrame, cells: DataFrame) -> DataFrame:
    near = asked.join(cells.hint("merge"), ["_level", *_CUBE])
    return near.withColumn("dist_m", haversine_m(F.col("_tlon"), F.col("_tlat"), F.col("_lon"), F.col("_lat")))


def swath_map(targets: DataFrame, cells: DataFrame, target: list[str], k: int = 1, radius_m: float = 25000.0, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """For each target the k nearest cells within the radius: src_row, src_col, dist_m, rank, like ``regrid_map``, and exact.

    ``cells`` (row, col, lon, lat) may lie anywhere; ``target`` are the columns that name a target. Ties go to the smaller row, then
    column. Places without coordinates take no part, and a target without a cell in reach has no rows.

    Both sides of every join grow with the inputs, and files say little about the rows in them: all joins are shuffled, also
    those with the result. Cubes that are counted or made distinct are stored: adaptive execution splits a hot cube only where
    both sides of a join are shuffled for it.
    """
    top = max(0, min(LEVELS, math.floor(math.log2(max(radius_m, 1.0)))))
    side, named = max(radius_m, 1.0) / 2**top, [*target, "_tlon", "_tlat"]
    todo = targets.select(*target, F.col(lon).cast("double").alias("_tlon"), F.col(lat).cast("double").alias("_tlat")).filter(_known(F.col("_tlon"), F.col("_tlat")))
    sources = cells.select(F.col("row").alias("src_row"), F.col("col").alias("src_col"), F.col("lon").cast("double").alias("_lon"), F.col("lat").cast("double").alias("_lat")) \
        .filter(_known(F.col("_lon"), F.col("_lat")))
    sources = sources.select("*", *[F.floor(u).alias(a) for a, u in zip(_AXES, _place(F.col("_lon"), F.col("_lat"), side))])
    # cells out of every target's reach are left out
    reach = stored(_within(todo.select("_tlon", "_tlat"), F.lit(top), F.lit(radius_m), side).select(*_CUBE).distinct(), "swath-reach")
    near = stored(_at_level(sources, F.lit(top)).join(reach.hint("merge"), list(_CUBE), "left_semi").drop(*_CUBE), "swath-cells")
    # the smallest cube around a target with k cells; none: null
    all_levels = F.explode(F.sequence(F.lit(0), F.lit(top)))
    full = near.groupBy(*_AXES).agg(F.count(F.lit(1)).alias("_n")).withColumn("_level", all_levels)
    full = stored(_at_level(full, F.col("_level")).groupBy("_level", *_CUBE).agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= k), "swath-full")
    around = _at_level(todo.select("*", *[F.floor(u).alias(a) for a, u in zip(_AXES, _place(F.col("_tlon"), F.col("_tlat"), side))]).withColumn("_level", all_levels), F.col("_level"))
    start = stored(around.join(full.hint("merge"), ["_level", *_CUBE], "left").groupBy(*named, *_AXES).agg(F.min(F.when(F.col("_n").isNotNull(), F.col("_level"))).alias("_level")), "swath-start")
    used = [r[0] for r in start.select(F.coalesce("_level", F.lit(top))).distinct().collect()]  # 13 at most
    hashed = _at_level(near.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in used or [top]]))), F.col("_level"))
    # the k-th of its cells bounds the search
    inside = _distances(_at_level(start.filter(F.col("_level").isNotNull()), F.col("_level")).drop(*_AXES), hashed.drop(*_AXES))
    kth = inside.withColumn("_rank", F.row_number().over(Window.partitionBy(*named).orderBy("dist_m"))).filter(F.col("_rank") == k)
    bounds = kth.select(*named, "_level", F.least("dist_m", F.lit(radius_m)).alias("_reach")).unionByName(
        start.filter(F.col("_level").isNull()).select(*named, F.lit(top).alias("_level"), F.lit(float(radius_m)).alias("_reach")))
    found = _distances(_within(bounds, F.col("_level"), F.col("_reach"), side), hashed.drop(*_AXES)).filter((F.col("dist_m") <= radius_m) & (F.col("dist_m") <= F.col("_reach") + SLACK_M))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*target).orderBy("dist_m", "src_row", "src_col")) - 1).filter(F.col("rank") < k)
    out = stored(found.select(*target, "rank", "src_row", "src_col", "dist_m"), "swath-map")
    discard(reach, near, full, start)
    return targets.join(out.hint("merge"), target, "inner").select(*targets.columns, "rank", "src_row", "src_col", "dist_m").hint("merge")
