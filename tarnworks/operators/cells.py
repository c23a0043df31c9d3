"""Cell-table operators: masks, neighbourhoods, regridding and rasterised polygons.

A grid is a table of (row, col, value); a mask is the set of its cells. Joins are by cell.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.core.checks import assert_none
from tarnworks.core.io import materialize
from tarnworks.operators.ranks import exact_percentiles

CELL = ["row", "col"]


def require_aligned(grids: DataFrame) -> None:
    """Raise when grids (a row each) differ in shape, system or transform."""
    kinds = grids.select("crs", "width", "height", "a", "b", "c", "d", "e", "f").distinct().limit(2).count()
    if kinds > 1:
        raise ValueError("grids are not aligned")


def whole_cell_offset(a: float, origin_a: float, origin_b: float) -> bool:
    """Two origins lie a whole number of cells apart, to a millionth of a cell."""
    steps = (origin_a - origin_b) / a
    return abs(steps - round(steps)) <= 1e-6


def mask(cells: DataFrame, condition: Column | str) -> DataFrame:
    return cells.where(condition).select(*CELL)


def intersect(*masks: DataFrame) -> DataFrame:
    """Cells of all masks."""
    return reduce(lambda a, b: a.join(b.select(*CELL), CELL, "left_semi"), masks)


def on_land(cells: DataFrame, land: DataFrame) -> DataFrame:
    return cells.join(land.select(*CELL), CELL, "left_semi")


def off_land_count(cells: DataFrame, land: DataFrame) -> DataFrame:
    return cells.join(land.select(*CELL), CELL, "left_anti").agg(F.count(F.lit(1)).alias("n_dropped"))


def above_region_threshold(cells: DataFrame, thresholds: DataFrame, region: str = "region") -> DataFrame:
    """Adds ``passes``: value above its region's threshold; a cell without region never passes; a
    region that cells have and the thresholds (a row a region) lack raises."""
    known = thresholds.select(region, "t")
    assert_none(cells.select(region).where(F.col(region).isNotNull()).distinct().join(known, region, "left_anti"), "regions without threshold")
    return cells.join(known, region, "left").withColumn("passes", F.coalesce(F.col("value") > F.col("t"), F.lit(False))).drop("t")


def product(a: DataFrame, b: DataFrame, name: str = "value") -> DataFrame:
    """Cell-wise product where both have a value."""
    return a.select(*CELL, F.col("value").alias("x")).join(b.select(*CELL, F.col("value").alias("y")), CELL).select(*CELL, (F.col("x") * F.col("y")).alias(name))


def conditional_product(canopy: DataFrame, keep: DataFrame, cover: DataFrame, least: int = 3) -> DataFrame:
    """canopy * keep / 100 where the cover class is ``least`` or more, else 0; all three needed."""
    j = canopy.select(*CELL, F.col("value").alias("c")).join(keep.select(*CELL, F.col("value").alias("k")), CELL).join(cover.select(*CELL, F.col("value").alias("u")), CELL)
    return j.select(*CELL, F.when(F.col("u") >= least, F.col("c") * F.col("k") / 100).otherwise(0.0).alias("value"))


def composite_class(cells: DataFrame, depression: Column, onstream: Column) -> DataFrame:
    return cells.withColumn("class", F.when(depression, 1).when(onstream, 2).otherwise(0))


def topographic_index(fac: Column, slope_deg: Column) -> Column:
    """log((fac + 1) * 10 / (tan(slope) + 0.01)), slopes above 60 degrees as 60."""
    return F.log((fac + 1) * 10 / (F.tan(F.radians(F.least(slope_deg, F.lit(60.0)))) + 0.01))


def code_boxes(cells: DataFrame, code: str) -> DataFrame:
    """Each code's half-open bounding box; null is no code."""
    g = cells.where(F.col(code).isNotNull()).groupBy(code)
    return g.agg(F.min("row").alias("r0"), (F.max("row") + 1).alias("r1"), F.min("col").alias("c0"), (F.max("col") + 1).alias("c1"))


def subset_to_bounds(cells: DataFrame, x: Column, y: Column, bounds: tuple[float, float, float, float], margin: float = 2000.0) -> DataFrame:
    """Cells whose centre lies in the bounds moved out by a margin; none at all raises."""
    x0, y0, x1, y1 = bounds
    out = cells.where(x.between(x0 - margin, x1 + margin) & y.between(y0 - margin, y1 + margin))
    if out.isEmpty():
        raise ValueError("no cell in the bounds")
    return out


def pervious(land: DataFrame, impervious: DataFrame, depression: DataFrame) -> DataFrame:
    return land.select(*CELL).join(impervious.select(*CELL), CELL, "left_anti").join(depression.select(*CELL), CELL, "left_anti")


def contributing(perv: DataFrame, twi: DataFrame, onstream: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Pervious cells with a flag for each threshold: on-stream, or the index above it."""
    d = perv.select(*CELL).join(twi.select(*CELL, F.col("value").alias("twi")), CELL, "left").join(onstream.select(*CELL).withColumn("on", F.lit(True)), CELL, "left")
    flags = {k: F.coalesce("on", F.lit(False)) | F.coalesce(F.col("twi") > t, F.lit(False)) for k, t in thresholds.items()}
    return d.withColumns(flags).drop("twi", "on")


def depression_classes(regions: DataFrame, connected: DataFrame, endorheic: DataFrame, impervious: DataFrame, land: DataFrame) -> DataFrame:
    """(row, col, kind) of waterbody regions (row, col, label): depression or onstream.

    Depression: regions that no connected cell touches, and endorheic cells that are not
    connected; without impervious cells, on land. Onstream: the other waterbody cells on land.
    """
    touched = regions.join(connected.select(*CELL), CELL, "left_semi").select("label").distinct()
    whole = regions.join(touched, "label", "left_anti").select(*CELL)
    single = regions.join(endorheic.select(*CELL), CELL, "left_semi").join(connected.select(*CELL), CELL, "left_anti").select(*CELL)
    dry = whole.union(single).distinct()
    off = lambda d: d.join(impervious.select(*CELL), CELL, "left_anti").join(land.select(*CELL), CELL, "left_semi")
    rest = regions.select(*CELL).join(dry, CELL, "left_anti").join(land.select(*CELL), CELL, "left_semi")
    return off(dry).withColumn("kind", F.lit("depression")).union(rest.withColumn("kind", F.lit("onstream")))


def regions_touching(regions: DataFrame, other: DataFrame) -> DataFrame:
    return regions.join(other.select(*CELL), CELL, "left_semi").select("label").distinct()


def cells_of_regions(regions: DataFrame, labels: DataFrame) -> DataFrame:
    return regions.join(labels.select("label"), "label", "left_semi").select(*CELL)


def gated_burn(values: DataFrame, land: DataFrame, depression: DataFrame) -> DataFrame:
    """Values on cells that are land and depression; a value that is not positive raises."""
    assert_none(values.where("value <= 0").select(*CELL), "not positive")
    return values.join(land.select(*CELL), CELL, "left_semi").join(depression.select(*CELL), CELL, "left_semi")


def coarse(cells: DataFrame, factor: int, how: str = "average") -> DataFrame:
    """An overview level: blocks' means, or the value of the block's centre cell."""
    block = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in CELL]
    if how == "average":
        return cells.groupBy(*block).agg(F.avg("value").alias("value"))
    half = factor // 2
    return cells.where((F.col("row") % factor == half) & (F.col("col") % factor == half)).select(*block, "value")


def every_nth(cells: DataFrame, n: int) -> DataFrame:
    return cells.where((F.col("row") % n == 0) & (F.col("col") % n == 0))


def nearest_regrid(source: DataFrame, target: DataFrame, scale: float, shift: float = 0.0, missing: tuple = ()) -> DataFrame:
    """Target cells (row, col) with the source cell under their centre: source index =
    floor((target + 0.5) * scale + shift). Listed and negative values are missing."""
    at = [F.floor((F.col(c) + 0.5) * scale + shift).cast("int").alias(f"s_{c}") for c in CELL]
    s = source.select(F.col("row").alias("s_row"), F.col("col").alias("s_col"), "value").where((F.col("value") >= 0) & ~F.col("value").isin(list(missing)))
    return target.select(*CELL, *at).join(s, ["s_row", "s_col"]).select(*CELL, "value")


def bilinear_regrid(source: DataFrame, target: DataFrame, scale: float) -> DataFrame:
    """Target cells with the weighted mean of the four source cells around their centre; missing
    ones are left out of the mean."""
    t = target.select(*CELL, *[((F.col(c) + 0.5) * scale - 0.5).alias(f"p_{c}") for c in CELL])
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    t = t.withColumn("k", F.explode(near)).select(
        *CELL, (F.floor("p_row") + F.col("k.i")).cast("int").alias("s_row"), (F.floor("p_col") + F.col("k.j")).cast("int").alias("s_col"),
        ((1 - F.abs(F.col("p_row") - F.floor("p_row") - F.col("k.i"))) * (1 - F.abs(F.col("p_col") - F.floor("p_col") - F.col("k.j")))).alias("w"),
    )
    s = source.where(F.col("value").isNotNull()).select(F.col("row").alias("s_row"), F.col("col").alias("s_col"), "value")
    g = t.where("w > 0").join(s, ["s_row", "s_col"]).groupBy(*CELL).agg(F.sum(F.col("w") * F.col("value")).alias("v"), F.sum("w").alias("w"))
    return g.select(*CELL, (F.col("v") / F.col("w")).alias("value"))


#: Row and column steps of the D8 codes: fixed values of the code.
D8 = {1: (0, 1), 2: (1, 1), 4: (1, 0), 8: (1, -1), 16: (0, -1), 32: (-1, -1), 64: (-1, 0), 128: (-1, 1)}


def neighbours(cells: DataFrame) -> DataFrame:
    """Each valid cell with the values of its up to eight neighbours: (row, col, value, code, n_value).

    The eight rows a cell are more than Catalyst's estimate, which takes an exploded array for one
    row, so that this join is never one by broadcast.
    """
    steps = F.array(*[F.struct(F.lit(k).alias("code"), F.lit(i).alias("i"), F.lit(j).alias("j")) for k, (i, j) in D8.items()])
    # A neighbour's value is sent to the cells that look at it.
    sent = cells.where(F.col("value").isNotNull()).withColumn("s", F.explode(steps))
    sent = sent.select((F.col("row") - F.col("s.i")).alias("row"), (F.col("col") - F.col("s.j")).alias("col"), F.col("s.code").alias("code"), F.col("value").alias("n_value"))
    return cells.where(F.col("value").isNotNull()).select(*CELL, "value").join(sent.hint("merge"), CELL)


def slope_aspect(cells: DataFrame, size: float) -> DataFrame:
    """(row, col, slope, aspect) in degrees by the 3 x 3 gradient; a missing neighbour counts as the
    centre. Aspect: clockwise from north, the way down; null on flat cells."""
    n = neighbours(cells)
    pick = lambda code: F.coalesce(F.max(F.when(F.col("code") == code, F.col("n_value"))), F.first("value"))
    g = n.groupBy(*CELL).agg(*[pick(k).alias(f"z{k}") for k in D8])
    dx = ((F.col("z128") + 2 * F.col("z1") + F.col("z2")) - (F.col("z32") + 2 * F.col("z16") + F.col("z8"))) / (8 * size)
    dy = ((F.col("z8") + 2 * F.col("z4") + F.col("z2")) - (F.col("z32") + 2 * F.col("z64") + F.col("z128"))) / (8 * size)
    flat = (dx == 0) & (dy == 0)
    return g.select(*CELL, F.degrees(F.atan(F.sqrt(dx * dx + dy * dy))).alias("slope"), F.when(~flat, F.pmod(F.degrees(F.atan2(-dx, dy)), F.lit(360.0))).alias("aspect"))


def flow_pointer(cells: DataFrame) -> DataFrame:
    """(row, col, code): D8 code of the steepest descent, the smallest code on ties, 0 where none."""
    diagonal = F.col("code").isin([2, 8, 32, 128])
    drop = (F.col("value") - F.col("n_value")) / F.when(diagonal, F.sqrt(F.lit(2.0))).otherwise(1.0)
    best = neighbours(cells).where("n_value < value").groupBy(*CELL).agg(F.max_by("code", F.struct(drop.alias("d"), -F.col("code"))).alias("code"))
    return cells.where(F.col("value").isNotNull()).select(*CELL).join(best.hint("merge"), CELL, "left").select(*CELL, F.coalesce("code", F.lit(0)).alias("code"))


def overlap_mosaic(tiles: DataFrame, how: str = "min", order: str = "tile") -> DataFrame:
    """One value a cell of overlapping tiles: the least, or the first tile's."""
    v = F.min("value") if how == "min" else F.min_by("value", order)
    return tiles.where(F.col("value").isNotNull()).groupBy(*CELL).agg(v.alias("value"))


def priority_mosaic(primary: DataFrame, fill: DataFrame) -> DataFrame:
    """(row, col, value, filled): the primary value, else the fill one."""
    p, f = primary.select(*CELL, F.col("value").alias("p")), fill.select(*CELL, F.col("value").alias("f"))
    j = p.join(f, CELL, "full")
    return j.select(*CELL, F.coalesce("p", "f").alias("value"), F.col("p").isNull().alias("filled")).where("value IS NOT NULL")


def fill_zone(primary: DataFrame, fill: DataFrame) -> DataFrame:
    return fill.where(F.col("value").isNotNull()).join(primary.where(F.col("value").isNotNull()).select(*CELL), CELL, "left_anti").select(*CELL)


def difference_statistics(a: DataFrame, b: DataFrame, region: str = "region") -> DataFrame:
    """Per region over common valid cells: n, mean, mean_abs, std, p1, p50, p95 and p99 of the
    differences, and the share within 0.1. Percentiles come from range partitions."""
    j = a.select(*CELL, region, F.col("value").alias("x")).join(b.select(*CELL, F.col("value").alias("y")), CELL).where("x IS NOT NULL AND y IS NOT NULL")
    j = materialize(j.select(region, (F.col("x") - F.col("y")).alias("d")), "differences")
    s = j.groupBy(region).agg(
        F.count(F.lit(1)).alias("n"), F.avg("d").alias("mean"), F.avg(F.abs("d")).alias("mean_abs"), F.stddev_pop("d").alias("std"),
        F.avg((F.abs("d") <= 0.1).cast("double")).alias("within"),
    )
    at = (1, 50, 95, 99)
    q = exact_percentiles(j, "d", [p / 100 for p in at], [region]).select(F.col(region).alias("_region"), *[F.get("q", F.lit(i)).alias(f"p{p}") for i, p in enumerate(at)])
    return s.join(q, F.equal_null(region, "_region"), "left").drop("_region")


def gained_lost(new: DataFrame, old: DataFrame, region: str, cell_area: float) -> DataFrame:
    """Cells in the new mask only, in the old one only, in both, and their area, by region."""
    n, o = new.select(*CELL, region).withColumn("new", F.lit(1)), old.select(*CELL, F.col(region).alias("r2")).withColumn("old", F.lit(1))
    j = n.join(o, CELL, "full").withColumn(region, F.coalesce(region, "r2"))
    kinds = {"gained": "old IS NULL", "lost": "new IS NULL", "both": "new = 1 AND old = 1"}
    g = j.groupBy(region).agg(*[F.count_if(F.expr(c)).alias(k) for k, c in kinds.items()])
    return g.withColumn("net_area", (F.col("gained") - F.col("lost")) * cell_area)


def recoverable(waterbody: DataFrame, connected: DataFrame, depression: DataFrame, impervious: DataFrame, land: DataFrame, cell_area: float) -> DataFrame:
    """One row: cells, and area, of waterbodies on land that no other mask holds."""
    d = waterbody.select(*CELL)
    for m in (connected, depression, impervious):
        d = d.join(m.select(*CELL), CELL, "left_anti")
    return d.join(land.select(*CELL), CELL, "left_semi").agg(F.count(F.lit(1)).alias("n_cells"), (F.count(F.lit(1)) * cell_area).alias("area"))
