"""Cell arithmetic. NULL means missing everywhere; NaN is turned into NULL at ingest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing_to_null(c: Column, no_data: float | None = None) -> Column:
    """NaN and the marker become NULL."""
    c = F.when(~F.isnan(c), c)
    return c if no_data is None else F.nullif(c, F.lit(float(no_data)))


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """P4. Values beyond a limit take the limit; NULL stays NULL (``greatest`` would skip it)."""
    out = c
    if lo is not None:
        out = F.when(out < lo, F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(hi)).otherwise(out)
    return out


def within_or_null(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """P5. Values beyond a limit become missing."""
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (c >= lo)
    if hi is not None:
        ok = ok & (c <= hi)
    return F.when(ok, c)


def unscale(c: Column, scale: float, no_data: float | None) -> Column:
    """P6. The scale factor is applied first, then the marker is compared."""
    out = c / F.lit(float(scale))
    return out if no_data is None else F.nullif(out, F.lit(float(no_data)))


def storage_from_curve_number(cn: Column, river: Column | None = None, no_data: float = -9999.0) -> Column:
    """P23. Largest storage in mm; marker cells and river cells (river = 1) are missing."""
    cn = F.nullif(cn.cast("double"), F.lit(float(no_data)))
    out = F.when(cn != 0, (F.lit(1000.0) / cn - F.lit(10.0)) * F.lit(25.4))
    return out if river is None else F.when(F.coalesce(river, F.lit(0)) != 1, out)


def saturation_percent(volume: Column, volume_max: Column, terrain: Column | None = None,
                       lo: float = 0.0, hi: float = 100.0) -> Column:
    """P22. Water volume as percent of the largest storage, clipped; missing below terrain 0."""
    out = F.when(volume_max != 0, clip(volume / volume_max * 100.0, lo, hi))
    return out if terrain is None else F.when(F.coalesce(terrain, F.lit(0)) >= 0, out)


# layer functions that a configuration may name, with their input layers
LAYER_FUNCTIONS = {
    "saturation_percent": (("volume", "volume_max", "terrain"), saturation_percent),
    "storage_from_curve_number": (("curve_number", "river"), storage_from_curve_number),
}


def layer_function(name: str, columns: dict[str, str]) -> Column:
    """F2. Build the named layer function from a map of layer name to column name."""
    if name not in LAYER_FUNCTIONS:
        raise ValueError(f"unknown layer function {name!r}; known: {sorted(LAYER_FUNCTIONS)}")
    layers, build = LAYER_FUNCTIONS[name]
    return build(*[F.col(columns[layer]) if layer in columns else None for layer in layers])
