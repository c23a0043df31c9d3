"""Column functions of the parameter rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the model's parameter rules.
INCHES_PER_M, MM_PER_INCH = 39.3701, 25.4
SWE_LEVELS = [round(1 - i / 10, 1) for i in range(11)]


def degrees_to_fraction(x: Column) -> Column:
    return F.tan(F.radians(x))


def radiation_transmission(density_percent: Column) -> Column:
    """Transmission below a canopy of some percent density; null density counts as none."""
    return F.exp(-2.7557 * F.coalesce(density_percent, F.lit(0.0)) / 100) * 0.9917


def winter_density(summer: Column, loss_percent: Column) -> Column:
    return summer * (1 - loss_percent / 100)


def threshold_inches(mm: Column) -> Column:
    """Millimetres as inches; 0 for what is null, not finite or not positive."""
    good = mm.isNotNull() & ~F.isnan(mm) & (mm > 0) & (mm < float("inf"))
    return F.when(good, mm / MM_PER_INCH).otherwise(0.0)


def missing_as_null(v: Column, nodata: float | None = None, fill_below: float = -1e30) -> Column:
    """Null for NaN, nodata and fill values."""
    bad = F.isnan(v) | (v <= fill_below)
    if nodata is not None:
        bad = bad | (v == nodata)
    return F.when(~bad, v)


def interpolate(points: Column, at: Column) -> Column:
    """y at ``at`` of an array of struct(x, y) sorted by x: linear, clamped at both ends;
    of points with one x the last counts from the right."""
    left = F.filter(points, lambda p: p["x"] <= at)
    right = F.filter(points, lambda p: p["x"] > at)
    a, b = F.try_element_at(left, F.lit(-1)), F.try_element_at(right, F.lit(1))
    between = a["y"] + (b["y"] - a["y"]) * (at - a["x"]) / (b["x"] - a["x"])
    return F.when(a.isNull(), b["y"]).when(b.isNull(), a["y"]).otherwise(between)


def running_minimum(values: Column) -> Column:
    """Cumulative minimum of an array."""
    first = F.array().cast("array<double>")
    return F.aggregate(values, first, lambda seen, v: F.concat(seen, F.array(F.least(F.coalesce(F.try_element_at(seen, F.lit(-1)), v), v))))


def clipped(values: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.transform(values, lambda v: F.least(F.greatest(v, F.lit(low)), F.lit(high)))


def valid_curve(curve: Column) -> Column:
    """11 values in [0, 1] that never rise by more than 1e-9."""
    falls = F.forall(F.zip_with(F.slice(curve, 1, 10), F.slice(curve, 2, 10), lambda a, b: b - a), lambda d: d <= 1e-9)
    return (F.size(curve) == 11) & F.forall(curve, lambda v: v.isNotNull() & (v >= 0) & (v <= 1)) & falls


def corner_tile_label(lon: Column, lat: Column) -> Column:
    """Name of a one-degree tile by its north-west corner, like n47w101."""
    return F.format_string("n%02dw%03d", F.ceil(lat).cast("int"), F.ceil(-lon).cast("int"))


def floor_tile_label(lon: Column, lat: Column) -> Column:
    """Name of a one-degree tile by its south-west corner, like N48W123."""
    return F.format_string("N%02dW%03d", F.floor(lat).cast("int"), (-F.floor(lon)).cast("int"))


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def ten_km_tiles(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Array of struct(tx, ty) of the 10-km tiles under a box: x by floor, y by ceiling."""
    xs = F.sequence(F.floor(x0 / 10000), F.floor(x1 / 10000))
    ys = F.sequence(F.ceil(y0 / 10000), F.ceil(y1 / 10000))
    return F.flatten(F.transform(xs, lambda tx: F.transform(ys, lambda ty: F.struct(tx.alias("tx"), ty.alias("ty")))))


def snap_bounds(low: Column, high: Column, origin: float, cell: float, pad: int) -> tuple[Column, Column]:
    """Bounds moved out to whole cells of a grid, and by ``pad`` cells more."""
    return F.floor((low - origin) / cell - pad) * cell + origin, F.ceil((high - origin) / cell + pad) * cell + origin


SUB_REGIONS = {"03N": "03", "03S": "03", "03W": "03", "10L": "10", "10U": "10"}


def region_code(label: Column) -> Column:
    """Two-digit region of a label like 3, 03N or 10U."""
    from tarnworks.core.checks import lookup

    padded = F.when(label.rlike(r"^\d$"), F.lpad(label, 2, "0")).when(label.rlike(r"^\d[A-Z]$"), F.lpad(label, 3, "0")).otherwise(label)
    return F.coalesce(lookup(padded, SUB_REGIONS), padded)


def water_year(date: Column) -> Column:
    """The year in which the water year (1 October to 30 September) ends."""
    return F.year(date) + (F.month(date) >= 10).cast("int")


#: Transforms that declared derived columns may name.
TRANSFORMS = {"deg_to_fraction": degrees_to_fraction, "inches_from_mm": lambda x: x / MM_PER_INCH, "inches_from_m": lambda x: x * INCHES_PER_M, "copy": lambda x: x}
