"""Key sets, audits, thresholds, model fits and gap filling over plain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.checks import assert_none
from tarnworks.core.io import materialize
from tarnworks.operators.ranks import exact_percentiles, numbered

# Key sets ---------------------------------------------------------------------------


def union_keys(*sets: DataFrame, key: str = "comid") -> DataFrame:
    return reduce(lambda a, b: a.union(b), [s.select(key) for s in sets]).distinct()


def subtract_keys(keys: DataFrame, other: DataFrame, key: str = "comid") -> DataFrame:
    return keys.select(key).distinct().join(other.select(key), key, "left_anti")


def either_key(rows: DataFrame, keys: DataFrame, row_id: str, key: str, member: str) -> DataFrame:
    """Rows whose key or whose member key is in the set: two semi joins and a union of row ids."""
    k = keys.select(F.col(key).alias("k")).distinct()
    hit = rows.join(k, rows[key] == k["k"], "left_semi").select(row_id).union(rows.join(k, rows[member] == k["k"], "left_semi").select(row_id)).distinct()
    return rows.join(hit, row_id, "left_semi")


def gated_keys(lines: DataFrame, network: DataFrame | None, key: str, own: str) -> DataFrame:
    """Distinct positive keys of lines, of lines in the network alone where one is given."""
    d = lines if network is None else lines.join(network.select(own), own, "left_semi")
    return d.where(F.col(key) > 0).select(key).distinct()


def evidence(candidates: DataFrame, second: DataFrame, key: str = "comid", least: float = 0.5) -> DataFrame:
    """(key, frac_own, by_terminus, by_second) of keys of either signal; a missing signal is false."""
    a = candidates.select(key, "frac_own").withColumn("by_terminus", F.col("frac_own") > least)
    b = second.select(key).distinct().withColumn("by_second", F.lit(True))
    j = a.join(b, key, "full")
    return j.select(key, "frac_own", F.coalesce("by_terminus", F.lit(False)).alias("by_terminus"), F.coalesce("by_second", F.lit(False)).alias("by_second"))


def set_sizes(a: DataFrame, b: DataFrame, c: DataFrame, key: str = "comid") -> DataFrame:
    """One row: sizes of three key sets and of their combinations."""
    tag = lambda s, n: s.select(key).distinct().withColumn(n, F.lit(1))
    j = tag(a, "a").join(tag(b, "b"), key, "full").join(tag(c, "c"), key, "full").na.fill(0)
    bc = (F.col("b") == 1) | (F.col("c") == 1)
    has = F.col("a") == 1
    return j.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("c").alias("c"), F.count_if(bc).alias("b_or_c"), F.count_if(has & bc).alias("a_and_bc"), F.count_if(has & ~bc).alias("a_only"), F.count_if(~has & bc).alias("bc_only"))


def repromoted(selected: DataFrame, demoted: DataFrame, key: str = "comid") -> DataFrame:
    return selected.select(key).intersect(demoted.select(key))


def network_keys(topology: DataFrame, key: str = "comid", down: str = "dnhydroseq") -> tuple[DataFrame, DataFrame]:
    """(network, routed): every key of the topology, and those that drain on; none raises."""
    network = topology.select(key).distinct()
    if network.isEmpty():
        raise ValueError("empty network")
    return network, topology.where(F.col(down) != 0).select(key).distinct()


# Audits -----------------------------------------------------------------------------


def gap_runs(ids: DataFrame, key: str) -> DataFrame:
    """(first, last, size) of each run of missing ids between present ones: gaps by lead, in
    range partitions whose first ids are handed to the partition before. The partitions are
    written, so that both readings agree."""
    d = materialize(ids.select(key).distinct().repartitionByRange(key).withColumn("part", F.spark_partition_id()), "gap-ranges")
    inner = d.withColumn("next", F.lead(key).over(Window.partitionBy("part").orderBy(key)))
    edge = d.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    edge = edge.withColumn("next", F.lead("low").over(Window.orderBy("part"))).select(F.col("high").alias(key), "next")
    both = inner.where("next IS NOT NULL").select(key, "next").union(edge.where("next IS NOT NULL"))
    return both.where(F.col("next") > F.col(key) + 1).select((F.col(key) + 1).alias("first"), (F.col("next") - 1).alias("last"), (F.col("next") - F.col(key) - 1).alias("size"))


def id_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row a column: min, max, count, distinct, unique, contiguous."""
    one = [F.struct(F.lit(c).alias("name"), F.min(c).cast("long").alias("low"), F.max(c).cast("long").alias("high"), F.count(c).alias("n"), F.countDistinct(c).alias("d")).alias(c) for c in columns]
    flat = df.agg(*one).select(F.explode(F.array(*columns)).alias("p")).select("p.*")
    return flat.select("name", "low", "high", "n", F.col("d").alias("n_distinct"), (F.col("n") == F.col("d")).alias("is_unique"), (F.col("high") - F.col("low") + 1 == F.col("d")).alias("is_contiguous"))


def shared_ids(parts: DataFrame, key: str, part: str) -> DataFrame:
    return parts.groupBy(key).agg(F.countDistinct(part).alias("n_parts")).where("n_parts > 1")


def null_census(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_null, n_rows) by one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns], F.count(F.lit(1)).alias("all_rows"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns]))
    return one.select(pairs.alias("p"), "all_rows").select("p.column", "p.n_null", F.col("all_rows").alias("n_rows"))


def undeclared(outputs: DataFrame, declared: DataFrame, allow: list[str], name: str = "name") -> DataFrame:
    d = outputs.join(declared.select(name), name, "left_anti")
    return d.where(~F.col(name).rlike("|".join(f"(?:{a})" for a in allow))) if allow else d


def bimodality(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value)
    n = F.count_if(v > 0)
    return df.agg(n.alias("n"), F.count_if(v >= 0.95).alias("n_high"), F.count_if(v.between(0.45, 0.55)).alias("n_mid"), *[F.count_if(v > t).alias(f"n_{int(t * 10)}") for t in (0.3, 0.5, 0.7)], ((F.count_if(v > 0.3) - F.count_if(v > 0.7)) / n).alias("swing"))


def seam_duplicates(rows: DataFrame, key: str, same: list[str], area: str, tolerance: float = 1e-6) -> DataFrame:
    """One row a key of rows repeated across parts; rows that disagree raise. The first by all
    its values stays."""
    g = rows.groupBy(key).agg(*[F.countDistinct(c).alias(f"n_{c}") for c in same], (F.max(area) - F.min(area)).alias("spread"))
    bad = reduce(lambda a, b: a | b, [F.col(f"n_{c}") > 1 for c in same], F.col("spread") > tolerance)
    assert_none(g.where(bad).select(key), "rows disagree")
    first = F.row_number().over(Window.partitionBy(key).orderBy(area, *same))
    return rows.withColumn("r", first).where("r = 1").drop("r")


def first_rows(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    return rows.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("r = 1").drop("r")


def named_dissolve(rows: DataFrame, region: str, name: str, key: str, kind: str, area: str) -> DataFrame:
    """Rows with one name in a region as one: key and kind of the largest, members in order, area
    summed; rows without a name stay."""
    has = F.col(name).isNotNull() & (F.trim(name) != "")
    largest = lambda c: F.max_by(c, F.struct(area, -F.col(key)))
    one = rows.where(has).groupBy(region, name).agg(largest(key).alias(key), largest(kind).alias(kind), F.array_join(F.sort_array(F.collect_set(key)), ",").alias("members"), F.sum(area).alias(area))
    rest = rows.where(~has).select(region, name, key, kind, F.col(key).cast("string").alias("members"), area)
    return one.select(region, name, key, kind, "members", area).unionByName(rest)


def stratified_sample(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """Up to n rows a stratum, those with the smallest seeded digest of the key."""
    order = Window.partitionBy(stratum).orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key)
    return rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n).drop("r")


# Thresholds -------------------------------------------------------------------------


def percentiles(df: DataFrame, value: str, at: list[float], by: list[str] | None = None) -> DataFrame:
    """Linear percentiles (0-100) of the valid values, over all rows or by columns."""
    found = exact_percentiles(df, value, [q / 100 for q in at], by)
    return found.select(*(by or []), *[F.get("q", F.lit(i)).alias(f"p{q:g}".replace(".", "_")) for i, q in enumerate(at)])


def rank_of(df: DataFrame, value: str, x: float) -> DataFrame:
    return df.where(F.col(value).isNotNull()).agg((100 * F.avg((F.col(value) <= x).cast("double"))).alias("rank"))


def reference_thresholds(df: DataFrame, region: str, value: str, p_low: float, p_high: float) -> DataFrame:
    """(scope, region, t_carea, t_smidx): percentiles of each region, and of all as ``pooled``."""
    own = percentiles(df.where(F.col(region).isNotNull()), value, [p_low, p_high], [region])
    both = percentiles(df.where(F.col(region).isNotNull()), value, [p_low, p_high])
    names = [c for c in own.columns if c != region]
    a = own.select(F.lit("region").alias("scope"), F.col(region).cast("string").alias(region), F.col(names[0]).alias("t_carea"), F.col(names[1]).alias("t_smidx"))
    b = both.select(F.lit("pooled").alias("scope"), F.lit(None).cast("string").alias(region), F.col(names[0]).alias("t_carea"), F.col(names[1]).alias("t_smidx"))
    return a.unionByName(b)


def zone_bins(df: DataFrame, zone: str, value: str, low: float, high: float, n: int) -> DataFrame:
    """(zone, bin, n) of n equal bins; values outside count in the edge bins."""
    b = F.least(F.greatest(F.floor((F.col(value) - low) / ((high - low) / n)), F.lit(0)), F.lit(n - 1)).cast("int")
    return df.where(F.col(value).isNotNull()).groupBy(zone, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def threshold_sweep(bins: DataFrame, totals: DataFrame, zone: str, low: float, width: float, thresholds: list[float]) -> DataFrame:
    """(t, mean, median, share_0, share_1) of (onstream + cells in bins whose centre is above t) /
    pervious over all zones. ``totals``: (zone, onstream, n_perv)."""
    t = F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("t")
    centre = low + (F.col("bin") + 0.5) * width
    every = totals.select(zone, "onstream", "n_perv", t)
    above = bins.select(zone, "bin", "n", t).where(centre > F.col("t")).groupBy(zone, "t").agg(F.sum("n").alias("above"))
    value = F.when(F.col("n_perv") > 0, (F.col("onstream") + F.coalesce("above", F.lit(0))) / F.col("n_perv")).otherwise(0.0)
    v = every.join(above, [zone, "t"], "left").select("t", F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)).alias("v"))
    v = materialize(v, "sweep")
    middle = percentiles(v, "v", [50], ["t"]).withColumnRenamed("p50", "median")
    return v.groupBy("t").agg(F.avg("v").alias("mean"), F.avg((F.col("v") == 0).cast("double")).alias("share_0"), F.avg((F.col("v") == 1).cast("double")).alias("share_1")).join(middle, "t")


def compare_parameters(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    j = a.select(key, F.col(value).alias("x")).join(b.select(key, F.col(value).alias("y")), key)
    return j.agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("r"), F.avg(F.abs(F.col("x") - F.col("y"))).alias("mean_abs"))


# Model fits and depth ---------------------------------------------------------------


def loglog_regression(df: DataFrame, by: str, x: str, y: str, least: int = 3) -> DataFrame:
    d = df.where((F.col(x) > 0) & (F.col(y) > 0)).select(by, F.log10(x).alias("lx"), F.log10(y).alias("ly"))
    g = d.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.regr_slope("ly", "lx").alias("slope"), F.regr_intercept("ly", "lx").alias("intercept"), F.regr_r2("ly", "lx").alias("r2"), F.min("lx").alias("lo"), F.max("lx").alias("hi"))
    return g.where(F.col("n") >= least)


def prediction_skill(df: DataFrame, observed: str, predicted: str) -> DataFrame:
    d = F.col(predicted) - F.col(observed)
    both = materialize(df.where(F.col(observed).isNotNull() & F.col(predicted).isNotNull()).select(F.col(observed).alias("o"), F.col(predicted).alias("p"), d.alias("d")), "skill")
    sums = both.agg(F.count(F.lit(1)).alias("n"), F.corr("o", "p").alias("r"), F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rmse"))
    return sums.join(percentiles(both, "d", [50]).select(F.col("p50").alias("median_bias")))  # one row each


def quartiles(df: DataFrame, ratio: Column, inside: float = 1 / 3) -> DataFrame:
    q = exact_percentiles(df.select(ratio.alias("r")), "r", [0.25, 0.5, 0.75])
    q1, median, q3 = (F.get("q", F.lit(i)) for i in range(3))
    return q.select("n", q1.alias("q1"), median.alias("median"), q3.alias("q3"), F.lit(inside).between(q1, q3).alias("has_inside"))


def flatness(cells: DataFrame, key: str = "comid", limit: float = 0.01) -> DataFrame:
    v = F.col("value")
    g = cells.where(v.isNotNull()).groupBy(key).agg((F.max(v) - F.min(v)).alias("range"), F.stddev_pop(v).alias("std"), F.countDistinct(F.round(v, 3)).alias("n_unique"))
    return g.withColumn("flat", F.col("range") < limit)


def volume_depth(cells: DataFrame, cell_area: float, key: str = "comid") -> DataFrame:
    g = cells.where("depth IS NOT NULL").groupBy(key).agg((F.sum("depth") * cell_area).alias("volume"), (F.count(F.lit(1)) * cell_area).alias("area"))
    return g.withColumn("mean_depth", F.col("volume") / F.col("area"))


#: Fixed values of the depth rules: shape factor of a cone, floor and cap in metres.
CONE, FLOOR_M, CAP_M, FOLDS, MIN_DONORS = 1 / 3, 49 / 39.3701, 300 / 39.3701, 5, 5


def donor_models(depths: DataFrame, folds: int = FOLDS, least: int = MIN_DONORS) -> DataFrame:
    """(ecoregion, ftype, n, median, slope, use_slope) from donors: rows not flat with depth > 0.

    The slope goes through the origin over shape * shore maximum. It is used only where its
    cross-validated error is below the median's, on the same folds: row numbers by a digest of
    the key, modulo ``folds``. Numbers and medians come from range partitions, so that a group
    of donors may be larger than a task.
    """
    group = ["ecoregion", "ftype"]
    d = depths.where("NOT flat AND dprst_depth_m > 0").select("ecoregion", "ftype", "comid", F.col("dprst_depth_m").alias("y"), (CONE * F.col("hollister_max_m")).alias("x"))
    d = numbered(d.withColumn("digest", F.md5(F.col("comid").cast("string"))), ["digest", "comid"], "place", group)
    d = materialize(d.select(*group, "x", "y", (F.col("place") % folds).cast("int").alias("fold")), "donor-folds")
    train = d.withColumn("test", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).where("test <> fold")
    k = (F.sum(F.col("x") * F.col("y")) / F.sum(F.col("x") * F.col("x"))).alias("k")
    fit = percentiles(train, "y", [50], [*group, "test"]).withColumnRenamed("p50", "m").join(train.groupBy(*group, "test").agg(k), [*group, "test"])
    held = d.withColumnRenamed("fold", "test").join(fit, ["ecoregion", "ftype", "test"])
    error = held.groupBy("ecoregion", "ftype").agg(F.avg((F.col("y") - F.col("m")) ** 2).alias("e_median"), F.avg((F.col("y") - F.col("k") * F.col("x")) ** 2).alias("e_slope"))
    middle = percentiles(d, "y", [50], group).select(F.col("ecoregion").alias("e"), F.col("ftype").alias("f"), F.col("p50").alias("median"))
    whole = d.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), k.alias("slope"))
    whole = whole.join(middle, F.equal_null("ecoregion", "e") & F.equal_null("ftype", "f")).drop("e", "f")
    return whole.where(F.col("n") >= least).join(error, ["ecoregion", "ftype"], "left").select("ecoregion", "ftype", "n", "median", "slope", F.coalesce(F.col("e_slope") < F.col("e_median"), F.lit(False)).alias("use_slope"))


def fill_depths(depths: DataFrame, models: DataFrame) -> DataFrame:
    """Adds depth_m and method: measured, or for flat and invalid rows the group's model, the
    ecoregion's median, the type's median, the floor; never above the cap."""
    donors = depths.where("NOT flat AND dprst_depth_m > 0")
    eco = percentiles(donors, "dprst_depth_m", [50], ["ecoregion"]).withColumnRenamed("p50", "eco_median")
    kind = percentiles(donors, "dprst_depth_m", [50], ["ftype"]).withColumnRenamed("p50", "ftype_median")
    d = depths.join(models.drop("n"), ["ecoregion", "ftype"], "left").join(eco, "ecoregion", "left").join(kind, "ftype", "left")
    measured = ~F.col("flat") & (F.coalesce("dprst_depth_m", F.lit(0.0)) > 0)
    slope = F.when(F.col("use_slope") & (F.col("hollister_max_m") > 0), F.col("slope") * CONE * F.col("hollister_max_m"))
    depth = F.when(measured, F.col("dprst_depth_m")).otherwise(F.coalesce(slope, "median", "eco_median", "ftype_median", F.lit(FLOOR_M)))
    method = (
        F.when(measured & (F.col("dprst_depth_m") > CAP_M), "measured_capped").when(measured, "measured").when(slope.isNotNull(), "calibrated_slope")
        .when(F.col("median").isNotNull(), "group_median").when(F.col("eco_median").isNotNull(), "ecoregion_median").when(F.col("ftype_median").isNotNull(), "ftype_median").otherwise("constant_floor")
    )
    return d.select(*depths.columns, F.least(depth, F.lit(CAP_M)).alias("depth_m"), method.alias("method"))


# Gap filling ------------------------------------------------------------------------


def fill_gaps(params: DataFrame, places: DataFrame, columns: list[str], key: str = "zone_id", k: int = 1) -> DataFrame:
    """One row for every place (key, x, y): each column's null or absent value becomes the mean of
    its k nearest rows that have one. Donors are searched per column; a place without coordinates
    gets none and stays null."""
    from tarnworks.operators.vector import nearest

    # A row a place on both sides: joins that move rows by key and none to the driver.
    spots = places.select(key, "x", "y").hint("merge")
    every = places.select(key).join(params.select(key, *columns).hint("merge"), key, "left")
    for c in columns:
        donors = every.where(F.col(c).isNotNull()).select(key, F.col(c).alias("v")).join(spots, key)
        missing = every.where(F.col(c).isNull()).select(key).join(spots, key)
        near = nearest(missing, donors, k, key).join(donors.select(F.col(key).alias("donor"), "v").hint("merge"), "donor")
        filled = near.groupBy(key).agg(F.avg("v").alias("filled"))
        every = every.join(filled.hint("merge"), key, "left").withColumn(c, F.coalesce(F.col(c).cast("double"), "filled")).drop("filled")
    return every


def copy_absent(params: DataFrame, fabric: DataFrame, key: str, column: str, source: str, scale: float = 1.0) -> DataFrame:
    """Null values from the fabric's column times a scale; an id that the fabric lacks raises."""
    j = params.join(fabric.select(key, F.col(source).alias("own")), key, "left")
    assert_none(j.where(F.col(column).isNull() & F.col("own").isNull()).select(key), "not in the fabric")
    return j.withColumn(column, F.coalesce(F.col(column), F.col("own") * scale)).drop("own")
