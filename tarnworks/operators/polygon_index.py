"""A quadtree cover of polygons for point lookups.

Cells of ``size`` that a polygon's boundary touches hold their own edges and whether their lower left
corner is inside. Cells without boundary lie wholly inside or outside; the inside ones are kept as
the largest quadtree cells that hold no boundary, so a polygon's index grows with its boundary and
not with its area. A point meets the cells that hold it, one a level: an inside cell answers at
once, a boundary cell by the edges between its corner and the point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import materialize

SEG = ["x1", "y1", "x2", "y2"]
#: Cells nearer than this (in cells) to an edge count as touched, so that rounding loses none.
NEAR = 1e-7
#: A cover of at most so many edges and inside cells is sent to the points; a larger one is shuffled.
SENT = 20_000


def crosses_right(e, x: Column, y: Column) -> Column:
    """Whether the edge crosses the level ``y`` to the right of ``x``; half open, so that a ring's
    edges cross the level of a common corner an even number of times."""
    at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
    return F.when((e["y1"] > y) != (e["y2"] > y), x < at).otherwise(F.lit(False))


def touched_cells(edges: DataFrame, size: float, margin: float = NEAR) -> DataFrame:
    """The edges with each cell (cx, cy) that they touch, or come nearer to than ``margin`` cells:
    column by column, the rows they pass there."""
    cell = lambda c, by=0.0: F.floor(c / size + by).cast("long")
    e = edges.withColumn("cx", F.explode(F.sequence(cell(F.least("x1", "x2"), -margin), cell(F.greatest("x1", "x2"), margin))))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    level = lambda x: F.col("y1") + (x - F.col("x1")) * (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    left, right = (F.col("cx") - margin) * size, (F.col("cx") + 1 + margin) * size
    side = lambda x: F.greatest(F.least(level(F.greatest(F.least(x, F.greatest("x1", "x2")), F.least("x1", "x2"))), high), low)
    a, b = F.when(F.col("x1") == F.col("x2"), low).otherwise(side(left)), F.when(F.col("x1") == F.col("x2"), high).otherwise(side(right))
    return e.withColumn("cy", F.explode(F.sequence(cell(F.least(a, b), -margin), cell(F.greatest(a, b), margin))))


def polygon_cover(edges: DataFrame, zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(zone, level, cx, cy, odd, own): the cover of the polygons of an edge table.

    Rings must be closed; edges with a null are left out. Its joins are shuffled: both sides grow with
    the boundary, and rows of exploded arrays are estimated as one each. ``own`` are the edges of a boundary cell
    (level 0), null for an inside cell; ``odd`` says whether the cell's lower left corner is inside.
    ``size`` should be near an edge's length: an edge lies in about length / size cells. Corners are
    settled by the crossings of their own polygon's row.
    """
    e = edges.select(F.col(zone).alias("zone"), *[F.col(c).cast("double").alias(c) for c in SEG]).where(" AND ".join(f"{c} IS NOT NULL" for c in ("zone", *SEG)))
    boundary = touched_cells(e, size).groupBy("zone", "cx", "cy").agg(F.collect_list(F.struct(*SEG)).alias("own"))
    boundary = materialize(boundary, "cover-boundary")
    # A polygon's levels end where its boundary fits in two by two cells.
    span = F.greatest(F.max("cx") - F.min("cx"), F.max("cy") - F.min("cy"))
    top = boundary.groupBy("zone").agg(F.ceil(F.log2(span + 1.0)).cast("int").alias("top"))
    up = boundary.select("zone", "cx", "cy").join(top.hint("merge"), "zone").withColumn("level", F.explode(F.sequence(F.lit(0), "top")))
    halved = lambda c: F.call_function("shiftright", F.col(c), F.col("level")).alias(c)
    nodes = up.select("zone", "level", halved("cx"), halved("cy")).distinct()
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    below = nodes.where("level > 0").withColumn("s", step).select("zone", (F.col("level") - 1).alias("level"), (2 * F.col("cx") + F.col("s.i")).alias("cx"), (2 * F.col("cy") + F.col("s.j")).alias("cy"))
    even = below.join(nodes.hint("merge"), ["zone", "level", "cx", "cy"], "left_anti")
    # Corners of all these cells against the crossings of their polygon's rows, right to left.
    asked = even.unionByName(boundary.select("zone", F.lit(0).alias("level"), "cx", "cy"))
    base = lambda c: F.call_function("shiftleft", F.col(c), F.col("level"))
    asked = asked.select("zone", base("cy").alias("row"), (base("cx") * F.lit(size)).alias("x"), F.lit(0).alias("crossing"), "level", "cx", "cy")
    rows = F.sequence(F.floor(F.least("y1", "y2") / size).cast("long"), F.floor(F.greatest("y1", "y2") / size).cast("long") + 1)
    y = F.col("row") * F.lit(size)
    met = e.withColumn("row", F.explode(rows)).where((F.col("y1") > y) != (F.col("y2") > y))
    met = met.select("zone", "row", (F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("x"), F.lit(1).alias("crossing"))
    right = Window.partitionBy("zone", "row").orderBy(F.desc("x"), "crossing").rowsBetween(Window.unboundedPreceding, 0)
    settled = asked.unionByName(met, allowMissingColumns=True).withColumn("odd", F.sum("crossing").over(right) % 2 == 1).where("crossing = 0")
    settled = settled.join(boundary.withColumn("level", F.lit(0)).hint("merge"), ["zone", "level", "cx", "cy"], "left").where("odd OR own IS NOT NULL")
    return materialize(settled.select("zone", "level", "cx", "cy", "odd", "own"), "cover")


def met_cells(points: DataFrame, cover: DataFrame, size: float = 1.0) -> DataFrame:
    """Points (with x, y) and the cover's cells that hold them, one row a cell."""
    held = F.sum(F.when(F.col("own").isNull(), 1).otherwise(F.size("own"))).alias("n")
    levels = {r["level"]: r["n"] for r in cover.groupBy("level").agg(held).collect()}  # at most 64
    cover = cover.hint("broadcast" if sum(levels.values()) <= SENT else "merge")
    p = points.where("x IS NOT NULL AND y IS NOT NULL").withColumn("level", F.explode(F.array(*[F.lit(i) for i in sorted(levels)]) if levels else F.array().cast("array<int>")))
    key = lambda c: F.call_function("shiftright", F.floor(F.col(c) / size).cast("long"), F.col("level"))
    return p.withColumns({"cx": key("x"), "cy": key("y")}).join(cover, ["level", "cx", "cy"])


def points_in_cover(points: DataFrame, cover: DataFrame, point: str = "point_id", zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(point, zone) of points inside polygons: an odd number of crossings to the right.

    Between the corner and the point only the cell's own edges can change the count. An edge adds
    the crossings of both levels, and for each end that lies right of the point and between the
    levels one more: ends are shared by two edges of the ring, so these cancel, and what is left of
    an edge that does not come near the cell is nothing. So the answer is the same, rounding
    included, as if all edges of the polygon were counted. A repeated row of a point is another
    point; null coordinates are nowhere.
    """
    m = met_cells(points.select(F.col(point).alias("point"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")), cover, size)
    x0, y0 = F.col("cx") * F.lit(size), F.col("cy") * F.lit(size)
    between = lambda vx, vy: (vx > F.col("x")) & ((vy > y0) != (vy > F.col("y")))
    moved = lambda e: (crosses_right(e, F.col("x"), F.col("y")) != crosses_right(e, x0, y0)) != (between(e["x1"], e["y1"]) != between(e["x2"], e["y2"]))
    inside = F.when(F.col("own").isNull(), F.col("odd")).otherwise(F.aggregate("own", F.col("odd"), lambda odd, e: odd != moved(e)))
    return m.where(inside).select(F.col("point").alias(point), F.col("zone").alias(zone))
