"""Polygons, points and grids as edge tables: coverage, containment, area, neighbours, batches.

An edge table has a row for each ring edge: (zone_id, x1, y1, x2, y2); outer rings and holes
turn opposite ways. Containment is half open: a point on a left or lower edge is inside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import materialize
from tarnworks.operators.polygon_index import points_in_cover, polygon_cover


def coverage(edges: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, row, col, w): the share of each unit cell that each polygon covers.

    Coordinates are in cells: x along columns, y along rows. An edge adds, to each cell of
    the columns it spans, the signed area between itself and the cell's lower side: exactly
    for the rows it crosses, the full height below them by a running sum over rows.
    """
    e = edges.where("x1 <> x2").select(
        zone, F.when(F.col("x2") > F.col("x1"), 1.0).otherwise(-1.0).alias("sign"),
        F.least("x1", "x2").alias("xa"), F.greatest("x1", "x2").alias("xb"),
        F.when(F.col("x1") < F.col("x2"), F.col("y1")).otherwise(F.col("y2")).alias("ya"), F.when(F.col("x1") < F.col("x2"), F.col("y2")).otherwise(F.col("y1")).alias("yb"),
    )
    e = e.withColumn("col", F.explode(F.sequence(F.floor("xa"), F.greatest(F.ceil("xb") - 1, F.floor("xa")))))
    slope = (F.col("yb") - F.col("ya")) / (F.col("xb") - F.col("xa"))
    lo, hi = F.greatest(F.col("xa"), F.col("col")), F.least(F.col("xb"), F.col("col") + 1)
    e = e.select(zone, "sign", "col", (hi - lo).alias("dx"), (F.col("ya") + slope * (lo - F.col("xa"))).alias("p"), (F.col("ya") + slope * (hi - F.col("xa"))).alias("q")).where("dx > 0")
    bottom = F.floor(F.least("p", "q"))
    e = e.withColumn("first", bottom).withColumn("row", F.explode(F.sequence(bottom, F.greatest(F.ceil(F.greatest("p", "q")) - 1, bottom))))
    area = lambda t: F.when(t <= F.col("row"), 0.0).when(t >= F.col("row") + 1, t - F.col("row") - 0.5).otherwise((t - F.col("row")) * (t - F.col("row")) / 2)
    level = (F.least(F.greatest(F.col("p"), F.col("row")), F.col("row") + 1) - F.col("row")) * F.col("dx")
    inside = F.when(F.abs(F.col("q") - F.col("p")) < 1e-12, level).otherwise((area(F.col("q")) - area(F.col("p"))) * F.col("dx") / (F.col("q") - F.col("p")))
    parts = e.groupBy(zone, "col", "row").agg(F.sum(F.col("sign") * inside).alias("exact"), F.sum(F.when(F.col("row") == F.col("first"), F.col("sign") * F.col("dx")).otherwise(0.0)).alias("full"))
    span = parts.groupBy(zone, "col").agg(F.sequence(F.min("row"), F.max("row")).alias("rows"))
    every = span.select(zone, "col", F.explode("rows").alias("row"))
    above = Window.partitionBy(zone, "col").orderBy(F.desc("row")).rowsBetween(Window.unboundedPreceding, -1)
    d = every.join(parts, [zone, "col", "row"], "left").fillna(0.0, ["exact", "full"])
    d = d.withColumn("w", F.abs(F.col("exact") + F.coalesce(F.sum("full").over(above), F.lit(0.0))))
    return d.where("w > 1e-12").select(zone, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), "w")


def measures(edges: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, area, cx, cy, xmin, ymin, xmax, ymax) by sums over the ring edges."""
    k = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    s = edges.groupBy(zone).agg(
        F.sum(k).alias("k"), F.sum((F.col("x1") + F.col("x2")) * k).alias("mx"), F.sum((F.col("y1") + F.col("y2")) * k).alias("my"),
        F.min(F.least("x1", "x2")).alias("xmin"), F.min(F.least("y1", "y2")).alias("ymin"), F.max(F.greatest("x1", "x2")).alias("xmax"), F.max(F.greatest("y1", "y2")).alias("ymax"),
    )
    return s.select(zone, F.abs(F.col("k") / 2).alias("area"), (F.col("mx") / (3 * F.col("k"))).alias("cx"), (F.col("my") / (3 * F.col("k"))).alias("cy"), "xmin", "ymin", "xmax", "ymax")


def points_in_polygons(points: DataFrame, edges: DataFrame, point: str = "point_id", zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(point, zone) of points (point, x, y) inside polygons, over their quadtree cover of cells of
    ``size``; see ``polygon_index``."""
    return points_in_cover(points, polygon_cover(edges, zone, size), point, zone, size)


def first_polygon(points: DataFrame, edges: DataFrame, label: str = "unassigned", point: str = "point_id", zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """Every point with its smallest containing zone as text, or ``label``."""
    first = points_in_polygons(points, edges, point, zone, size).groupBy(point).agg(F.min(zone).alias(zone))
    return points.select(point).join(first, point, "left").select(point, F.coalesce(F.col(zone).cast("string"), F.lit(label)).alias(zone))


def points_per_polygon(points: DataFrame, edges: DataFrame, point: str = "point_id", zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    return points_in_polygons(points, edges, point, zone, size).groupBy(zone).agg(F.count(F.lit(1)).alias("n_points"))


def rasterise(edges: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, row, col) of the unit cells whose centre lies in the polygon: on every row's centre
    line the crossings, in order, open and close runs of columns."""
    y = F.col("row") + 0.5
    e = edges.where("y1 <> y2").withColumn("row", F.explode(F.sequence(F.ceil(F.least("y1", "y2") - 0.5), F.greatest(F.ceil(F.greatest("y1", "y2") - 0.5) - 1, F.ceil(F.least("y1", "y2") - 0.5)))))
    e = e.where((F.col("y1") > y) != (F.col("y2") > y)).select(zone, "row", (F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("x"))
    order = Window.partitionBy(zone, "row").orderBy("x")
    runs = e.withColumn("k", F.row_number().over(order)).withColumn("end", F.lead("x").over(order)).where("k % 2 = 1 AND end IS NOT NULL")
    first, last = F.ceil(F.col("x") - 0.5), F.ceil(F.col("end") - 0.5) - 1
    runs = runs.where(last >= first)
    return runs.select(zone, F.col("row").cast("int").alias("row"), F.explode(F.sequence(first, last)).alias("col")).select(zone, "row", F.col("col").cast("int").alias("col"))


def last_polygon_wins(cells: DataFrame, order: str = "zone_id") -> DataFrame:
    """(row, col, label): of several zones on a cell the one that comes last in ``order``."""
    return cells.groupBy("row", "col").agg(F.max(order).alias("label"))


#: Donors in a bin that is not divided further, and how often a bin is halved at most.
BIN_DONORS, BIN_LEVELS = 8, 26


def nearest(missing: DataFrame, donors: DataFrame, k: int = 1, key: str = "zone_id") -> DataFrame:
    """(key, rank, donor, distance): each row's k nearest donors by distance of (x, y), ties by id.

    Donors lie in a pyramid of square bins with their counts; bins of more than ``BIN_DONORS``
    distinct places are divided. All rows start at the top bin and descend together: in each round a
    row's k donors are surely within some distance, that of the nearest bins that hold k; bins that
    begin beyond it are left, the others divided. So a row meets a few bins a level and then the
    donors of a few bins, however far it lies from all donors. Fewer than k donors: all of them; no
    donor raises. Rows and donors without coordinates take no part. Of donors at one place only
    the k with the smallest ids can count.
    """
    there = lambda d: d.where("x IS NOT NULL AND y IS NOT NULL").where(~F.isnan("x") & ~F.isnan("y"))
    xy = [F.col(c).cast("double").alias(c) for c in "xy"]
    same_place = Window.partitionBy("dx", "dy").orderBy("donor")
    d = there(donors.select(key, *xy)).select(F.col(key).alias("donor"), F.col("x").alias("dx"), F.col("y").alias("dy"))
    d = materialize(d.withColumn("n", F.row_number().over(same_place)).where(F.col("n") <= k).drop("n"), "donors")
    s = d.agg(F.count(F.lit(1)).alias("n"), F.min("dx").alias("x0"), F.max("dx").alias("x1"), F.min("dy").alias("y0"), F.max("dy").alias("y1")).first()
    if not s["n"]:
        raise ValueError("no donor")
    k = min(k, s["n"])
    x0, y0 = s["x0"], s["y0"]
    width = max(s["x1"] - x0, s["y1"] - y0, 1e-9) * (1 + 1e-9)
    levels = min(BIN_LEVELS, s["n"].bit_length() + 8)  # level 0 is the top bin
    fine = 2.0**levels / width
    code = lambda c, low: F.least(F.floor((F.col(c) - low) * fine), F.lit(2**levels - 1)).cast("long")
    up = lambda c: F.call_function("shiftright", F.col(c), (F.lit(levels) - F.col("level")).cast("int")).alias(c)
    bins = d.select(code("dx", x0).alias("bx"), code("dy", y0).alias("by"), F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"))
    bins = materialize(bins.select("level", up("bx"), up("by")).groupBy("level", "bx", "by").agg(F.count(F.lit(1)).alias("n")), "donor-bins")
    parents = bins.where(F.col("n") > BIN_DONORS).select((F.col("level") + 1).alias("level"), F.col("bx").alias("px"), F.col("by").alias("py"))
    half = lambda c: F.call_function("shiftright", F.col(c), F.lit(1))
    kept = bins.withColumns({"px": half("bx"), "py": half("by")})
    kept = kept.where("level = 0").unionByName(kept.where("level > 0").join(parents, ["level", "px", "py"]).select(*kept.columns))
    leaf = (F.col("n") <= BIN_DONORS) | (F.col("level") == levels)
    kept = materialize(kept.withColumn("leaf", leaf), "donor-pyramid")

    size = F.lit(width) / F.pow(F.lit(2.0), F.col("level"))
    slack = F.lit(1e-9 * width) + 1e-12 * (F.abs("x") + F.abs("y") + abs(x0) + abs(y0))  # for the rounding of bins
    low = {c: F.lit(o) + F.col(f"b{c}") * size for c, o in (("x", x0), ("y", y0))}
    off = {c: F.greatest(low[c] - F.col(c), F.col(c) - low[c] - size, F.lit(0.0)) for c in "xy"}
    most = {c: F.greatest(F.abs(F.col(c) - low[c]), F.abs(low[c] + size - F.col(c))) for c in "xy"}
    bounds = {"near": F.sqrt(off["x"] ** 2 + off["y"] ** 2) - slack, "far": F.sqrt(most["x"] ** 2 + most["y"] ** 2) + slack}
    row = [key, "x", "y"]
    by_far = Window.partitionBy(*row).orderBy("far").rowsBetween(Window.unboundedPreceding, 0)

    def pruned(asked: DataFrame) -> DataFrame:
        """Bins that may hold one of the row's k nearest: a row has few bins."""
        d = asked.withColumns(bounds).withColumn("upto", F.sum("n").over(by_far))
        reach = F.min(F.when(F.col("upto") >= k, F.col("far"))).over(Window.partitionBy(*row))
        return d.withColumn("reach", reach).where(F.col("near") <= F.col("reach")).select(*row, "level", "bx", "by", "n", "leaf")

    todo = there(missing.select(key, *xy)).distinct()
    asked = materialize(todo.join(F.broadcast(kept.where("level = 0"))).select(*row, "level", "bx", "by", "n", "leaf"), "nearest-bins")
    for level in range(levels):
        if asked.where("NOT leaf").isEmpty():
            break
        down = asked.where("NOT leaf").select(*row, (F.col("level") + 1).alias("level"), F.col("bx").alias("px"), F.col("by").alias("py"))
        below = down.join(kept.where(F.col("level") == level + 1), ["level", "px", "py"]).select(*row, "level", "bx", "by", "n", "leaf")
        asked = materialize(pruned(asked.where("leaf").unionByName(below)), "nearest-bins", instead_of=asked)
    holders = kept.where("leaf").select("level").distinct()
    placed = d.withColumns({"cx": code("dx", x0), "cy": code("dy", y0)}).join(F.broadcast(holders)).withColumns({"bx": F.col("cx"), "by": F.col("cy")})
    placed = placed.select("donor", "dx", "dy", "level", up("bx"), up("by"))
    far = F.sqrt((F.col("x") - F.col("dx")) ** 2 + (F.col("y") - F.col("dy")) ** 2)
    best = Window.partitionBy(*row).orderBy("distance", "donor")
    found = asked.where("leaf").join(placed, ["level", "bx", "by"]).withColumn("distance", far).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select(key, F.col("rank").cast("int").alias("rank"), "donor", "distance")


def spatial_batches(points: DataFrame, size: int, key: str = "zone_id") -> DataFrame:
    """(key, batch_id): halves by the median of x and y in turn, left up to the median, down to
    ``size // 2`` rows or ceil(log2(n // size)) levels; one batch where all fit. Batches number
    from 0 in the order of their halves."""
    import math

    from tarnworks.core.io import materialize
    from tarnworks.operators.ranks import exact_percentiles, numbered

    n = points.count()
    d = points.select(key, "x", "y").withColumn("node", F.lit(1).cast("long"))
    levels = max(0, math.ceil(math.log2(max(1, n // size)))) if n > size else 0
    for level in range(levels):
        axis = "xy"[level % 2]
        cut = d.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min(axis).alias("lo"), F.max(axis).alias("hi"))
        cut = cut.join(exact_percentiles(d, axis, [0.5], ["node"]).select("node", F.get("q", F.lit(0)).alias("cut")), "node")
        cut = materialize(cut, "batch-cuts")  # a row a node: joins see its size, not that of a sum over all points
        right = (F.col(axis) > F.col("cut")).cast("long")
        split = (F.col("n") > size // 2) & (F.col("lo") < F.col("hi"))
        d = materialize(d.join(cut, "node").select(key, "x", "y", F.when(split, 2 * F.col("node") + right).otherwise(2 * F.col("node")).alias("node")), "batches")
    names = numbered(d.select("node").distinct(), ["node"], "batch_id")
    return d.join(names, "node").select(key, F.col("batch_id").cast("int").alias("batch_id"))


def tile_membership(boxes: DataFrame, key: str, size: float, fine: DataFrame) -> DataFrame:
    """(key, tile, resolution): all fine tiles (tx, ty) under a box, or the coarse one where
    no fine tile exists."""
    xs, ys = F.sequence(F.floor(F.col("xmin") / size), F.floor(F.col("xmax") / size)), F.sequence(F.floor(F.col("ymin") / size), F.floor(F.col("ymax") / size))
    t = boxes.withColumn("tx", F.explode(xs)).withColumn("ty", F.explode(ys)).select(key, "tx", "ty")
    hits = t.join(fine.select("tx", "ty").distinct(), ["tx", "ty"]).select(key, F.concat_ws("_", "tx", "ty").alias("tile"), F.lit("fine").alias("resolution"))
    rest = boxes.select(key).join(hits.select(key), key, "left_anti").select(key, F.lit("coarse").alias("tile"), F.lit("coarse").alias("resolution"))
    return hits.unionByName(rest)
