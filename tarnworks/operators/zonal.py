"""Zonal aggregation: statistics of cells under zones, weighted by coverage.

Inputs are (zone, value or class, w) rows: a cell's coverage by a zone is ``w``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.core.io import materialize
from tarnworks.operators.ranks import weighted_quantiles


def continuous(cells: DataFrame, zone: str = "zone_id", value: str = "value", w: str = "w", quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count (sum of coverage), mean, std (population), min, quantiles, max, sum of each zone.

    A null value is no cell; a zone without a valid cell keeps its row with count 0 and null
    statistics. Quantile q: the smallest value whose weight, summed from below, reaches q of
    the zone's weight. Equal values of a zone are summed and written first; quantiles come from
    running weights over range partitions, and the deviation from a second pass about the mean,
    so that neither a zone of all cells nor values far from zero do harm.
    """
    by_value = materialize(cells.groupBy(F.col(zone).alias("zone"), F.col(value).cast("double").alias("value")).agg(F.sum(w).alias("n")), "zone-values")
    x, n = F.col("value"), F.col("n")
    valid = F.sum(F.when(x.isNotNull(), n))
    zones = by_value.groupBy("zone").agg(F.coalesce(valid, F.lit(0.0)).alias("count"), (F.sum(n * x) / valid).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"), F.sum(n * x).alias("sum"))
    zones = materialize(zones, "zone-means")
    keyed = lambda d: d.withColumnRenamed("zone", "_zone")
    same = F.equal_null("zone", "_zone")
    about = by_value.where(x.isNotNull()).join(keyed(zones.select("zone", "mean")), same).select("zone", (n * (x - F.col("mean")) ** 2).alias("square"), "n")
    std = about.groupBy("zone").agg(F.sqrt(F.sum("square") / F.sum("n")).alias("std"))
    cut = weighted_quantiles(by_value, "value", "n", list(quantiles), ["zone"])
    cut = cut.select("zone", *[F.get("q", F.lit(i)).alias(f"p{int(100 * q)}") for i, q in enumerate(quantiles)])
    out = zones.join(keyed(std), same, "left").drop("_zone").join(keyed(cut), same, "left").drop("_zone")
    return out.withColumnRenamed("zone", zone)


def histogram(cells: DataFrame, zone: str = "zone_id", klass: str = "class", w: str = "w") -> DataFrame:
    """(zone, class, n, total): covered cells of each class, and of the zone."""
    n = cells.where(F.col(klass).isNotNull()).groupBy(zone, klass).agg(F.sum(w).alias("n"))
    return n.withColumn("total", F.sum("n").over(Window.partitionBy(zone)))


def dominant(hist: DataFrame, zone: str = "zone_id", klass: str = "class", n: str = "n") -> DataFrame:
    """The class with the most cells; ties take the smallest class."""
    return hist.groupBy(zone).agg(F.max_by(klass, F.struct(F.col(n), -F.col(klass))).alias("dominant"))


def mean_parameter(cells: DataFrame, name: str, scale: float = 1.0, zone: str = "zone_id", value: str = "value", w: str = "w") -> DataFrame:
    """Weighted mean times ``scale``; null where no cell is valid."""
    valid = F.sum(F.when(F.col(value).isNotNull(), F.col(w)))
    return cells.groupBy(zone).agg((F.sum(F.col(w) * F.col(value)) / valid * scale).alias(name))


def mask_counts(cells: DataFrame, masks: dict, zone: str = "zone_id", w: str = "w") -> DataFrame:
    """Coverage of each mask (name -> condition) in one pass; 0 where none."""
    return cells.groupBy(zone).agg(*[F.coalesce(F.sum(F.when(c, F.col(w))), F.lit(0.0)).alias(k) for k, c in masks.items()])


def finalise_depth(ids: DataFrame, means: DataFrame, zone: str = "zone_id", mean: str = "mean", floor_in: float = 49.0, cap_in: float = 300.0) -> DataFrame:
    """Depth in inches for every id: null, not finite or not positive means take the floor, the
    cap bounds the rest; ``source`` says which."""
    inches = F.col(mean) * 39.3701
    bad = F.col(mean).isNull() | F.isnan(mean) | (inches <= 0)
    return ids.join(means, zone, "left").select(
        zone,
        F.when(bad, floor_in).otherwise(F.least(inches, F.lit(cap_in))).alias("depth_in"),
        F.when(F.col(mean).isNull(), "no_dprst_cells").when(bad, "unknown").otherwise("joined").alias("source"),
    )


def majority_label(pieces: DataFrame, zone: str = "zone_id", label: str = "method", area: str = "area") -> DataFrame:
    """The label with the largest summed area; ties take the first label in text order."""
    sums = pieces.groupBy(zone, label).agg(F.sum(area).alias("area"))
    best = F.struct(-F.col("area"), F.col(label))
    return sums.groupBy(zone).agg(F.min_by(label, best).alias(label), F.max("area").alias("area"))


def full_counts(num: DataFrame, den: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Numerator and denominator of every id of either side; 0 where missing."""
    a, b = num.select(zone, F.col("count").alias("num")), den.select(zone, F.col("count").alias("den"))
    return a.join(b, zone, "full").select(zone, F.coalesce("num", F.lit(0.0)).alias("num"), F.coalesce("den", F.lit(0.0)).alias("den"))


def ratio(num: DataFrame, den: DataFrame, clamp: bool = True, zone: str = "zone_id") -> DataFrame:
    """num / den of every id, 0 where den is 0, at most 1 if clamped."""
    r = F.when(F.col("den") == 0, 0.0).otherwise(F.col("num") / F.col("den"))
    return full_counts(num, den, zone).select(zone, (F.least(r, F.lit(1.0)) if clamp else r).alias("ratio"))


def ratio_quality(num: DataFrame, den: DataFrame, zone: str = "zone_id") -> DataFrame:
    """One row: ids, ids without denominator, ids whose ratio a clamp cuts."""
    return full_counts(num, den, zone).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("den") == 0).alias("n_zero_denom"),
        F.count_if((F.col("den") > 0) & (F.col("num") > F.col("den"))).alias("n_clamped"),
    )


#: Rows of cells that a task of the series' join takes from either side.
CELL_ROWS = 100_000


def cell_parts(spark: SparkSession, rows: int) -> int:
    """Tasks of ``series``' join for an input of at most ``rows`` rows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // CELL_ROWS))


def series(weights: DataFrame, grid: DataFrame, values: list[str], zone: str = "zone_id", date: str = "date", parts: int | None = None) -> DataFrame:
    """Per zone and day, for each variable: masked mean, std, min, max, sum and count over the
    valid cells, and the plain mean and sum, which are null where any cell is.

    ``weights`` is (zone, row, col, w), ``grid`` (date, row, col, variables). Deviations are taken
    from sums of squares; zones and days whose deviation is so much smaller than their mean that
    this loses digits get a second pass about the mean (equal cells have 0).

    A cell gives a row a zone and day, so tasks of the join that are cut by what they read grow in
    what they hold; ``parts`` is the number of tasks instead (``cell_parts`` of the larger input).
    """
    if parts is not None:
        weights, grid = (d.repartition(parts, "row", "col") for d in (weights, grid))
    j = weights.join(grid.hint("merge") if parts is not None else grid, ["row", "col"])
    out = []
    for v in values:
        x, w = F.col(v), F.col("w")
        n = F.sum(F.when(x.isNotNull(), w))
        mean, full = F.sum(w * x) / n, F.count_if(x.isNull()) == 0
        square = F.greatest(F.sum(w * x * x) / n - mean * mean, F.lit(0.0))
        out += [
            mean.alias(f"{v}_masked_mean"),
            F.when(F.min(x) == F.max(x), 0.0).otherwise(F.sqrt(square)).alias(f"{v}_masked_std"),
            F.min(x).alias(f"{v}_masked_min"),
            F.max(x).alias(f"{v}_masked_max"),
            F.sum(w * x).alias(f"{v}_masked_sum"),
            F.coalesce(n, F.lit(0.0)).alias(f"{v}_masked_count"),
            F.when(full, mean).alias(f"{v}_mean"),
            F.when(full, F.sum(w * x)).alias(f"{v}_sum"),
        ]
    found = materialize(j.groupBy(zone, date).agg(*out), "zone-series")
    # Sums of squares keep about 16 digits of mean squared.
    loses = lambda v: (F.col(f"{v}_masked_min") < F.col(f"{v}_masked_max")) & (F.col(f"{v}_masked_std") < 1e-3 * F.abs(f"{v}_masked_mean"))
    again = found.where(reduce(or_, [loses(v) for v in values])).select(zone, date, *[f"{v}_masked_mean" for v in values])
    if again.isEmpty():
        return found
    about = [F.sqrt(F.sum(F.col("w") * (F.col(v) - F.col(f"{v}_masked_mean")) ** 2) / F.sum(F.when(F.col(v).isNotNull(), F.col("w")))).alias(f"_{v}") for v in values]
    exact = j.join(again, [zone, date]).groupBy(zone, date).agg(*about)
    better = found.join(exact, [zone, date], "left")
    return better.withColumns({f"{v}_masked_std": F.when(loses(v), F.col(f"_{v}")).otherwise(F.col(f"{v}_masked_std")) for v in values}).select(*found.columns)


def snow_cover(swe):
    """1 where there is snow, 0 where there is none, null where unknown."""
    return F.when(swe.isNotNull(), (swe > 0).cast("double"))


def cells_per_zone(weights: DataFrame, zone: str = "zone_id") -> DataFrame:
    return weights.groupBy(zone).agg(F.count(F.lit(1)).alias("n_cells"))


def region_share(cells: DataFrame, region: str, condition) -> DataFrame:
    """Share of each region's cells under a condition; region 0 and null are none."""
    return cells.where((F.col(region) != 0) & F.col(region).isNotNull()).groupBy(region).agg(F.avg(F.when(condition, 1.0).otherwise(0.0)).alias("share"), F.count(F.lit(1)).alias("n_cells"))


def split_shares(rows: DataFrame, region: str, kind: str, area: str) -> DataFrame:
    """Count and area by region and kind, of a kind in all regions, and the share of the region."""
    n = rows.groupBy(region, kind).agg(F.count(F.lit(1)).alias("n"), F.sum(area).alias("area"))
    every = n.groupBy(kind).agg(F.sum("n").alias("n"), F.sum("area").alias("area")).select(F.lit("all").alias(region), kind, "n", "area")
    both = n.withColumn(region, F.col(region).cast("string")).unionByName(every)
    return both.withColumn("percent", 100 * F.col("n") / F.sum("n").over(Window.partitionBy(region)))


def overlap_by_key(pairs: DataFrame, key: str = "comid", segment: str = "seg_index", length: str = "overlap_m") -> DataFrame:
    """Distinct segments and summed overlap of each key, over positive pairs."""
    return pairs.where(F.col(length) > 1e-6).groupBy(key).agg(F.countDistinct(segment).alias("n_segments"), F.sum(length).alias("overlap_m"))


def inside_fraction(rows: DataFrame, key: str = "comid", inside: str = "inside_area", area: str = "area", least: float = 0.5) -> DataFrame:
    """Inside area over whole area, summed over a key's rows; a key without area raises."""
    from tarnworks.core.checks import assert_none

    sums = rows.groupBy(key).agg(F.sum(inside).alias("inside"), F.sum(area).alias("area"))
    assert_none(sums.where(F.col("area") <= 0).select(key), "no area")
    return sums.select(key, (F.col("inside") / F.col("area")).alias("fraction"), (F.col("inside") / F.col("area") > least).alias("flagged"))
