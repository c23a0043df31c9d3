"""Waterbody masks and touched cells: polygons onto the grid, connected and endorheic sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.checks import assert_none, assert_some
from tarnworks.functions.scalar import region_code
from tarnworks.operators.cells import CELL
from tarnworks.operators.vector import rasterise


def touched_by_edges(edges: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, row, col) of the unit cells that an edge passes through: per column its run of rows."""
    e = edges.withColumn("xa", F.least("x1", "x2")).withColumn("xb", F.greatest("x1", "x2"))
    e = e.withColumn("col", F.explode(F.sequence(F.floor("xa"), F.floor("xb"))))
    slope = F.when(F.col("x2") != F.col("x1"), (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")))
    lo, hi = F.greatest(F.col("xa"), F.col("col")), F.least(F.col("xb"), F.col("col") + 1)
    p, q = F.col("y1") + slope * (lo - F.col("x1")), F.col("y1") + slope * (hi - F.col("x1"))
    first, last = F.when(slope.isNull(), F.least("y1", "y2")).otherwise(F.least(p, q)), F.when(slope.isNull(), F.greatest("y1", "y2")).otherwise(F.greatest(p, q))
    e = e.select(zone, "col", F.explode(F.sequence(F.floor(first), F.floor(last))).alias("row"))
    return e.select(zone, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col")).distinct()


def rasterise_touched(edges: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Cells whose centre lies in the polygon, and all cells that its boundary passes through."""
    return rasterise(edges, zone).union(touched_by_edges(edges, zone)).distinct()


def region_codes(cells: DataFrame, label: str) -> DataFrame:
    """(row, col, code) of labelled cells: 1..18 by sub-region; other codes raise."""
    d = cells.withColumn("code", region_code(F.col(label)).cast("int"))
    assert_none(d.where("code IS NULL OR code NOT BETWEEN 1 AND 18").select(label).distinct(), "region labels")
    return d.select(*CELL, "code")


def polygon_cells(polygons: DataFrame, edges: DataFrame, land: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Cells on land of the selected polygons; no polygon at all raises."""
    keep = assert_some(polygons.select(zone).distinct(), "no polygon selected")
    cells = rasterise(edges.join(keep, zone, "left_semi"), zone).select(*CELL).distinct()
    return cells.join(land.select(*CELL), CELL, "left_semi")


def waterbody_masks(waterbodies: DataFrame, edges: DataFrame, connected: DataFrame, endorheic: DataFrame, land: DataFrame, row_id: str = "zone_id", key: str = "comid", member: str = "member_comid") -> DataFrame:
    """(row, col, kind): cells on land of all waterbodies, of the connected keys' and of the
    endorheic keys'. A key selects a row by its own or its member's id."""
    from tarnworks.operators.tables import either_key

    kinds = {"waterbody": waterbodies, "connected": either_key(waterbodies, connected, row_id, key, member), "endorheic": either_key(waterbodies, endorheic, row_id, key, member)}
    out = None
    for kind, rows in kinds.items():
        cells = polygon_cells(rows, edges, land, row_id).withColumn("kind", F.lit(kind))
        out = cells if out is None else out.unionByName(cells)
    return out


def append_sinks(waterbodies: DataFrame, sinks: DataFrame, reached: DataFrame, key: str = "comid") -> DataFrame:
    """Waterbodies and sink polygons: sink keys must be negative, and none of them may reach an
    on-stream polygon (``reached``: seed, key)."""
    assert_none(sinks.where(F.col(key) >= 0).select(key), "sink keys that are not negative")
    assert_none(reached.join(sinks.select(F.col(key).alias("seed")), "seed", "left_semi").select("seed", "key"), "sinks reach on-stream polygons")
    return waterbodies.unionByName(sinks, allowMissingColumns=True)


def grid_mismatches(grids: DataFrame, template: str, name: str = "grid_id") -> DataFrame:
    """(grid, field) of grids whose shape, system or transform differs from the template's; a template
    that is named twice raises."""
    assert_none(grids.where(F.col(name) == template).groupBy(name).count().where("count > 1"), "template grids named twice")
    fields = ["crs", "width", "height", "a", "b", "c", "d", "e", "f"]
    t = grids.where(F.col(name) == template).select(*[F.col(f).cast("string").alias(f"t_{f}") for f in fields])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), (~F.equal_null(F.col(f).cast("string"), F.col(f"t_{f}"))).alias("off")) for f in fields])
    return grids.join(F.broadcast(t)).select(name, F.explode(pairs).alias("p")).where("p.off").select(name, "p.field")


def threshold_value(bins: DataFrame, totals: DataFrame, t: float, low: float, width: float, zone: str = "zone_id") -> DataFrame:
    """(zone, value): (onstream + cells in bins whose centre is above t) / pervious, within [0, 1]."""
    above = bins.where(low + (F.col("bin") + 0.5) * width > t).groupBy(zone).agg(F.sum("n").alias("above"))
    v = F.when(F.col("n_perv") > 0, (F.col("onstream") + F.coalesce("above", F.lit(0))) / F.col("n_perv")).otherwise(0.0)
    return totals.join(above, zone, "left").select(zone, F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)).alias("value"))


def reference_lookup(rows: DataFrame, reference: DataFrame, value: str, forward: bool = True) -> DataFrame:
    """Adds ``looked_up``: a value's percentile on a reference (pct, value), or a percentile's value;
    linear and clamped. The reference is a small table: one row a percentile."""
    from tarnworks.functions.scalar import interpolate

    x, y = ("value", "pct") if forward else ("pct", "value")
    known = reference.agg(F.sort_array(F.collect_list(F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))).alias("known"))
    return rows.join(F.broadcast(known)).withColumn("looked_up", interpolate(F.col("known"), F.col(value).cast("double"))).drop("known")


