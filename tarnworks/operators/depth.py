"""Per-polygon depths from windowed elevation cells.

``cells`` is (comid, row, col, value, inside): a window of cells round each polygon, ``inside``
where the centre lies in it. A cell has one row in its window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import materialize
from tarnworks.operators.flow import fill_depressions

#: Mean depth over maximum depth by basin shape: fixed values.
SHAPE_FACTORS = {"cone": 1 / 3, "paraboloid": 0.5, "cylinder": 1.0}


def _run_reach(cells: DataFrame, line: str, along: str) -> DataFrame:
    """Adds ``reach``: the steps ``along`` a line of cells to the first cell that is not there."""
    keys = ["comid", line]
    order = Window.partitionBy(*keys).orderBy(along)
    d = cells.withColumn("run", F.col(along) - F.row_number().over(order))
    run = Window.partitionBy(*keys, "run")
    reach = F.least(F.col(along) - F.min(along).over(run), F.max(along).over(run) - F.col(along)) + 1
    return d.withColumn("reach", reach.cast("long")).drop("run")


def farthest(heights: list[int]) -> int:
    """The largest value of the lower envelope of the parabolas heights[p] + (q - p) ** 2 at the
    places q of a column: each parabola enters and leaves the envelope once, so time is linear."""
    on, since = [0], [float("-inf")]  # parabolas of the envelope, and where each begins
    for q in range(1, len(heights)):
        while True:
            p = on[-1]
            meet = (heights[q] + q * q - heights[p] - p * p) / (2 * (q - p))
            if meet > since[-1]:
                break
            on.pop()
            since.pop()
        on.append(q)
        since.append(meet)
    most, k = 0, 0
    for q in range(len(heights)):
        while k + 1 < len(on) and since[k + 1] < q:
            k += 1
        most = max(most, heights[on[k]] + (q - on[k]) ** 2)
    return most


def column_distances(pdf: pd.DataFrame) -> pd.DataFrame:
    """The largest distance to the shore, squared, in some columns of one polygon: for each cell
    the least of reach ** 2 + (rows apart) ** 2 over its column; missing cells have reach 0."""
    r0, c0 = pdf["row"].min() - 1, pdf["col"].min()
    square = np.zeros((pdf["row"].max() - r0 + 2, pdf["col"].max() - c0 + 1), np.int64)
    square[pdf["row"] - r0, pdf["col"] - c0] = pdf["reach"].to_numpy(np.int64) ** 2
    return pd.DataFrame({"comid": [pdf["comid"].iloc[0]], "square": [max(map(farthest, square.T.tolist()))]})


def shore_distances(inside: DataFrame, columns: int = 64, most: int = 2**26, faults: bool = False) -> DataFrame:
    """(comid, distance): the largest distance in cells of an inside cell (comid, row, col) to its
    nearest cell that is not inside, centre to centre.

    First along the rows, then down the columns, ``columns`` of them in a task's group. A group
    whose rows span more than ``most`` cells raises; with ``faults``, what a group raises stands as
    text in a third column, ``fault``, and its polygon has no distance.
    """

    def strip(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            spanned = (int(pdf["row"].max()) - int(pdf["row"].min()) + 3) * columns
            if spanned > most:
                raise ValueError(f"a strip of {spanned} cells; at most {most}")
            return column_distances(pdf).assign(fault=None)
        except Exception as error:
            if not faults:
                raise
            return pd.DataFrame({"comid": pdf["comid"].iloc[:1], "square": pd.array([None], "Int64"), "fault": [f"{type(error).__name__}: {error}"]})

    strips = _run_reach(inside, "row", "col").withColumn("strip", F.floor(F.col("col") / columns))
    found = strips.groupBy("comid", "strip").applyInPandas(strip, "comid long, square long, fault string")
    fault = F.min("fault")
    found = found.groupBy("comid").agg(F.when(fault.isNull(), F.sqrt(F.max("square"))).alias("distance"), fault.alias("fault"))
    return found if faults else found.drop("fault")


def ring_slopes(cells: DataFrame, inside: DataFrame, size: float, width: int = 2) -> DataFrame:
    """(comid, slope): mean gradient of the window's cells within ``width`` cells outside the shore.

    Central differences, one-sided at the window's border; cells without their neighbours'
    values are ignored. Polygons without such cells, or of one row or column, have no row.
    """
    across = _run_reach(inside, "row", "col").where("reach = 1").select("comid", "row", "col")
    shore = across.union(_run_reach(inside, "col", "row").where("reach = 1").select("comid", "row", "col"))
    box = cells.groupBy("comid").agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1")).where("r1 > r0 AND c1 > c0")
    step = F.sequence(F.lit(-width), F.lit(width))
    grown = shore.withColumn("i", F.explode(step)).withColumn("j", F.explode(step)).select("comid", (F.col("row") + F.col("i")).alias("row"), (F.col("col") + F.col("j")).alias("col")).distinct()
    key = ["comid", "row", "col"]
    ring = grown.join(inside, key, "left_anti").join(box, "comid").where("row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1")
    sides = {"here": (0, 0), "up": (-1, 0), "down": (1, 0), "left": (0, -1), "right": (0, 1)}
    looks = F.array(*[F.struct(F.lit(n).alias("side"), F.lit(i).alias("i"), F.lit(j).alias("j")) for n, (i, j) in sides.items()])
    at = ring.withColumn("s", F.explode(looks)).select("comid", *[F.col(c).alias(f"ring_{c}") for c in ("row", "col")], "r0", "r1", "c0", "c1", "s.side", (F.col("row") + F.col("s.i")).alias("row"), (F.col("col") + F.col("s.j")).alias("col"))
    seen = at.join(cells.select(*key, "value"), key).groupBy("comid", "ring_row", "ring_col", "r0", "r1", "c0", "c1")
    seen = seen.agg(*[F.max(F.when(F.col("side") == n, F.col("value"))).alias(n) for n in sides])
    slope = lambda at, lo, hi, less, more: F.when(F.col(at) == F.col(lo), F.col(more) - F.col("here")).when(F.col(at) == F.col(hi), F.col("here") - F.col(less)).otherwise((F.col(more) - F.col(less)) / 2) / size
    gy, gx = slope("ring_row", "r0", "r1", "up", "down"), slope("ring_col", "c0", "c1", "left", "right")
    return seen.groupBy("comid").agg(F.avg(F.sqrt(gy * gy + gx * gx)).alias("slope")).where("slope IS NOT NULL")


def _windows(cells: DataFrame) -> DataFrame:
    """The windows' cells with a key, one row a cell; NaN and infinite values are missing."""
    value = F.col("value").cast("double")
    kept = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value).alias("value")
    return cells.where("comid IS NOT NULL").select(F.col("comid").cast("long").alias("comid"), "row", "col", kept, F.coalesce("inside", F.lit(False)).alias("inside"))


def shore_estimates(cells: DataFrame, size: float, faults: bool = False) -> DataFrame:
    """(comid, hollister_max_m) of every polygon: mean slope in a ring of two cells round the shore
    times the largest distance to the shore; 0 without inside cells or ring. With ``faults`` also
    ``fault``, where the estimate is null."""
    d = _windows(cells)
    inside = d.where("inside").select("comid", "row", "col")
    e = d.select("comid").distinct().join(shore_distances(inside, faults=True) if faults else shore_distances(inside), "comid", "left")
    e = e.join(ring_slopes(d, inside, size), "comid", "left")
    estimate = F.coalesce(F.col("slope") * F.col("distance") * size, F.lit(0.0))
    if not faults:
        return e.select("comid", estimate.alias("hollister_max_m"))
    return e.select("comid", F.when(F.col("fault").isNull(), estimate).alias("hollister_max_m"), "fault")


def depth_records(cells: DataFrame, size: float, flat_below: float = 0.01, faults: bool = False) -> DataFrame:
    """One row a polygon: mean and largest depth to spill (null where flat or empty), the shore
    estimate, range, cells inside, method; with ``faults`` what its tasks raised. Null keys are
    left out.

    The windows of all polygons are filled together, and no group holds a whole window.
    """
    d = materialize(_windows(cells), "depth-cells")
    own = d.where("inside AND value IS NOT NULL").groupBy("comid").agg(F.count(F.lit(1)).alias("n_inside"), (F.max("value") - F.min("value")).alias("range_m"))
    own = d.select("comid").distinct().join(own, "comid", "left").fillna(0, ["n_inside"]).fillna(0.0, ["range_m"])
    own = materialize(own.withColumn("flat", (F.col("n_inside") == 0) | (F.col("range_m") < flat_below)), "depth-ranges")
    steep = d.join(own.where("NOT flat").select("comid"), "comid", "left_semi")
    filled = fill_depressions(steep, by=("comid",)).select("comid", "row", "col", "depth")
    deep = steep.where("inside").select("comid", "row", "col").join(filled, ["comid", "row", "col"])
    deep = deep.groupBy("comid").agg(F.avg("depth").alias("mean_depth_m"), F.max("depth").alias("measured_max_m"))
    found = own.join(deep, "comid", "left").join(shore_estimates(d, size, faults), "comid")
    method = F.when(F.col("flat"), "flat").otherwise("measured").alias("method")
    return found.select("comid", "mean_depth_m", "measured_max_m", "hollister_max_m", "range_m", "n_inside", "flat", method, *(["fault"] if faults else []))


def chosen_windows(polygons: DataFrame, cells: DataFrame) -> DataFrame:
    """(comid, resolution): the window that a polygon reads, one row a polygon.

    A polygon (comid, resolution) that asks for 1m, in any of its rows, takes the 1m window where
    it has a cell and else the 10m one; the others take the 10m window. Null where there is none.
    """
    p = polygons.where("comid IS NOT NULL").groupBy(F.col("comid").cast("long").alias("comid")).agg(F.coalesce(F.max(F.col("resolution") == "1m"), F.lit(False)).alias("fine"))
    has = cells.groupBy(F.col("comid").cast("long").alias("comid")).agg(*[F.max(F.col("resolution") == s).alias(f"has_{s}") for s in ("1m", "10m")])
    best = F.when(F.col("fine") & F.col("has_1m"), "1m").when(F.col("has_10m"), "10m")
    return p.join(has, "comid", "left").select("comid", best.alias("resolution"))


def depth_job(polygons: DataFrame, cells: DataFrame, flat_below: float = 0.01) -> DataFrame:
    """One row a polygon (comid, resolution asked for): ``status``, ``fault``, the resolution read
    and the columns of ``depth_records``.

    ``cells`` is (comid, resolution, row, col, value, inside); values may be text. Status is
    ``read_failure`` for a polygon without a window, ``compute_error`` for one whose window is
    broken (a cell without a place, a cell twice, a value that is no number) or whose task raised,
    and ``done``. A polygon's fault is data: its depths are null, all others are as without it.
    Broken windows leave before the windows are filled together.
    """
    chosen = materialize(chosen_windows(polygons, cells), "depth-chosen")
    number = F.col("value").try_cast("double")
    d = cells.withColumn("comid", F.col("comid").cast("long")).join(chosen, ["comid", "resolution"], "left_semi")
    d = d.select("comid", "row", "col", number.alias("value"), "inside", (F.col("value").isNotNull() & number.isNull()).alias("bad"))
    d = materialize(d, "depth-windows")
    spots = d.groupBy("comid", "row", "col").agg((F.count(F.lit(1)) > 1).alias("twice"), F.max("bad").alias("bad"))
    nowhere = F.col("row").isNull() | F.col("col").isNull()
    seen = spots.groupBy("comid").agg(F.max(nowhere).alias("nowhere"), F.max("twice").alias("twice"), F.max("bad").alias("bad"))
    broken = F.when(F.col("nowhere"), "a cell without a place").when(F.col("twice"), "a cell twice").when(F.col("bad"), "a value that is no number")
    broken = materialize(seen.select("comid", broken.alias("broken")).where("broken IS NOT NULL"), "depth-broken")
    # The shore estimate is slope times distance, both in cells: it holds for any cell size.
    found = depth_records(d.join(broken, "comid", "left_anti"), 1.0, flat_below, faults=True)
    e = chosen.join(broken, "comid", "left").join(found, "comid", "left")
    fault = F.when(F.col("resolution").isNull(), "no window").otherwise(F.coalesce("broken", "fault"))
    status = F.when(F.col("resolution").isNull(), "read_failure").when(fault.isNotNull(), "compute_error").otherwise("done")
    kept = [F.when(fault.isNull(), F.col(c)).alias(c) for c in ("mean_depth_m", "measured_max_m", "hollister_max_m", "range_m", "n_inside", "flat", "method")]
    return e.select("comid", status.alias("status"), fault.alias("fault"), "resolution", *kept)


def job_summary(job: DataFrame, least: float = 0.9) -> DataFrame:
    """One row of a depth job's counts: polygons, failed reads, failed computations, windows
    read at 1m, the share done and ``warned`` where it is below ``least``."""
    n = job.agg(F.count(F.lit(1)).alias("n_polygons"), F.count_if(F.col("status") == "read_failure").alias("n_read_failure"), F.count_if(F.col("status") == "compute_error").alias("n_compute_error"), F.count_if(F.col("resolution") == "1m").alias("n_fine"), F.count_if(F.col("status") == "done").alias("done"))
    share = F.when(F.col("n_polygons") > 0, F.col("done") / F.col("n_polygons"))
    return n.select("n_polygons", "n_read_failure", "n_compute_error", "n_fine", share.alias("share"), F.coalesce(share < least, F.lit(False)).alias("warned"))


def batch_status(polygons: DataFrame, cells: DataFrame, least: float = 0.9) -> DataFrame:
    """One row of the batch's counts: polygons, those without any window cell (failed reads), those
    with no valid cell inside (failed computations), the share that succeeded, and ``warned``
    where it is below ``least``. A polygon counts once, however often it is listed."""
    valid = F.col("inside") & F.col("value").isNotNull()
    seen = _windows(cells).groupBy("comid").agg(F.max(valid).alias("valid"))
    d = polygons.where("comid IS NOT NULL").select(F.col("comid").cast("long").alias("comid")).distinct().join(seen, "comid", "left")
    n = F.count(F.lit(1))
    counts = d.agg(n.alias("n_polygons"), F.count_if(F.col("valid").isNull()).alias("n_unread"), F.count_if(~F.col("valid")).alias("n_failed"), F.count_if("valid").alias("done"))
    share = F.when(F.col("n_polygons") > 0, F.col("done") / F.col("n_polygons"))
    return counts.select("n_polygons", "n_unread", "n_failed", share.alias("share"), F.coalesce(share < least, F.lit(False)).alias("warned"))


def max_to_mean(maximum, shape: str = "cone"):
    return maximum * SHAPE_FACTORS[shape]


def oversized(polygons: DataFrame, cell: str = "resolution", limit: float = 2e8, pad: float = 400.0) -> DataFrame:
    """Adds ``downgraded``: 1m windows of more than ``limit`` cells, padded, are taken at 10m."""
    big = (F.col(cell) == "1m") & ((F.col("width") + pad) * (F.col("height") + pad) > limit)
    return polygons.withColumn("downgraded", big).withColumn(cell, F.when(big, "10m").otherwise(F.col(cell)))


def window_cost(polygons: DataFrame, overhead: float = 50_000.0) -> DataFrame:
    """Adds ``cost``: cells of the padded window at its resolution, and an overhead a polygon."""
    size = F.when(F.col("resolution") == "1m", 1.0).otherwise(10.0)
    return polygons.withColumn("cost", F.ceil((F.col("width") + 400) / size) * F.ceil((F.col("height") + 400) / size) + overhead)


def freeboard(records: DataFrame, cells: DataFrame) -> DataFrame:
    """(comid, freeboard): mean of filled less raw inside flat polygons, of cells with ``filled``."""
    flat = records.where("flat").select("comid")
    return cells.join(flat, "comid", "left_semi").where("inside").groupBy("comid").agg(F.avg(F.col("filled") - F.col("value")).alias("freeboard"))


def validation_sample(records: DataFrame, areas: DataFrame) -> DataFrame:
    """Measured polygons with area and the ratio of mean to largest depth."""
    return records.where("NOT flat").join(areas, "comid").withColumn("ratio", F.col("mean_depth_m") / F.col("measured_max_m"))


def tagged_polygons(polygons: DataFrame, regions: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Adds ecoregion (missing: unassigned) and the best resolution (missing: 10m), then guards sizes.

    ``regions`` is (comid, ecoregion), ``resolutions`` (comid, resolution), several rows a polygon
    allowed: the first region in text order, the finest resolution.
    """
    reg = regions.groupBy("comid").agg(F.min("ecoregion").alias("ecoregion"))
    res = resolutions.groupBy("comid").agg(F.max(F.col("resolution") == "1m").alias("fine"))
    d = polygons.join(reg, "comid", "left").join(res, "comid", "left")
    d = d.withColumn("ecoregion", F.coalesce("ecoregion", F.lit("unassigned"))).withColumn("resolution", F.when(F.col("fine"), "1m").otherwise("10m")).drop("fine")
    return oversized(d)


def densest_project(points: DataFrame, key: str = "project") -> DataFrame:
    """The project with the most points; ties take the first in text order."""
    n = points.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return n.orderBy(F.desc("n"), key).limit(1)
