"""Land-cover parameters from class percentages and a crosswalk.

``perc`` is (zone, lu_code, perc); the crosswalk has one row a land-cover code, so that Catalyst
broadcasts it by its measured size. Codes the crosswalk lacks take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.functions.scalar import radiation_transmission, winter_density


def class_percentages(hist: DataFrame, zone: str = "zone_id", code: str = "lu_code", n: str = "n") -> DataFrame:
    """(zone, lu_code, perc): share of a zone's cells in percent; classes without cells go."""
    total = F.sum(n).over(Window.partitionBy(zone))
    return hist.withColumn("perc", 100 * F.col(n) / total).where("perc > 0").select(zone, code, "perc")


def unmatched_codes(perc: DataFrame, crosswalk: DataFrame) -> DataFrame:
    return perc.select("lu_code").distinct().join(crosswalk.select("lu_code"), "lu_code", "left_anti")


def _matched(perc: DataFrame, crosswalk: DataFrame) -> DataFrame:
    return perc.join(crosswalk, "lu_code").where("nhm_cov_type IS NOT NULL")


def _cover_type():
    """The decision over the aggregates bare, grass, shrub, tree and best."""
    c = {k: F.coalesce(F.col(k), F.lit(0.0)) for k in ("bare", "grass", "shrub", "tree")}
    return (
        F.when(c["bare"] >= 90, 0)
        .when(c["tree"] >= 20, 3)
        .when(c["shrub"] >= 20, 2)
        .when(c["shrub"] + c["tree"] >= 35, F.when(c["tree"] >= c["shrub"], 3).otherwise(2))
        .when(c["grass"] >= 50, 1)
        .otherwise(F.col("best"))
    )


def cover_type(perc: DataFrame, crosswalk: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Cover type 0 bare, 1 grass, 2 shrub, 3 tree ... of each zone; else the type with the
    largest share, the lowest one on ties."""
    by_type = _matched(perc, crosswalk).groupBy(zone, "nhm_cov_type").agg(F.sum("perc").alias("perc"))
    named = [F.sum(F.when(F.col("nhm_cov_type") == k, F.col("perc"))).alias(n) for k, n in enumerate(("bare", "grass", "shrub", "tree"))]
    best = F.max_by("nhm_cov_type", F.struct("perc", -F.col("nhm_cov_type"))).alias("best")
    return by_type.groupBy(zone).agg(*named, best).select(zone, _cover_type().cast("int").alias("cov_type"))


def _weighted(column: str):
    bare = F.col("nhm_cov_type") == 0
    return F.coalesce(F.sum(F.when(bare, 0.0).otherwise(F.col("perc") * 0.01 * F.col(column))), F.lit(0.0))


INTERCEPTION = ["srain_intcp", "wrain_intcp", "snow_intcp"]


def interception(perc: DataFrame, crosswalk: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Share-weighted interception coefficients; bare classes add nothing."""
    return _matched(perc, crosswalk).groupBy(zone).agg(*[_weighted(c).alias(c) for c in INTERCEPTION])


def cover_density(perc: DataFrame, crosswalk: DataFrame, canopy: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Summer density (share x canopy mean) and winter density (x class factor); a zone without
    canopy mean adds nothing but for its bare classes, which are 0 as well."""
    m = _matched(perc, crosswalk).join(canopy.select(zone, "canopy_mean"), zone, "left")
    part = F.when(F.col("nhm_cov_type") == 0, 0.0).otherwise(F.col("perc") * 0.01 * F.col("canopy_mean") * 0.01)
    return m.groupBy(zone).agg(
        F.coalesce(F.sum(part), F.lit(0.0)).alias("covden_sum"), F.coalesce(F.sum(part * F.col("nhm_covden_win")), F.lit(0.0)).alias("covden_win")
    )


def evergreen_retention(perc: DataFrame, crosswalk: DataFrame, zone: str = "zone_id") -> DataFrame:
    return _matched(perc, crosswalk).groupBy(zone).agg(_weighted("evergreen_retention").alias("retention"))


def cover_parameters(perc: DataFrame, crosswalk: DataFrame, canopy: DataFrame | None = None, zone: str = "zone_id") -> DataFrame:
    """All cover parameters of each zone: type, interception, densities, retention, radiation.

    The class rows are shuffled once, by zone.
    """
    m = _matched(perc, crosswalk)
    if canopy is None:
        m = m.withColumn("canopy_mean", F.lit(None).cast("double"))
    else:
        m = m.join(canopy.select(zone, "canopy_mean"), zone, "left")
    part = F.when(F.col("nhm_cov_type") == 0, 0.0).otherwise(F.col("perc") * 0.01 * F.col("canopy_mean") * 0.01)
    by_type = m.groupBy(zone, "nhm_cov_type").agg(
        F.sum("perc").alias("perc"),
        *[_weighted(c).alias(c) for c in [*INTERCEPTION, "evergreen_retention"]],
        F.sum(part).alias("sum"),
        F.sum(part * F.col("nhm_covden_win")).alias("win"),
    )
    named = [F.sum(F.when(F.col("nhm_cov_type") == k, F.col("perc"))).alias(n) for k, n in enumerate(("bare", "grass", "shrub", "tree"))]
    out = by_type.groupBy(zone).agg(
        *named,
        F.max_by("nhm_cov_type", F.struct("perc", -F.col("nhm_cov_type"))).alias("best"),
        *[F.sum(c).alias(c) for c in INTERCEPTION],
        F.sum("evergreen_retention").alias("retention"),
        F.coalesce(F.sum("sum"), F.lit(0.0)).alias("covden_sum"),
        F.coalesce(F.sum("win"), F.lit(0.0)).alias("covden_win"),
    )
    return out.select(zone, _cover_type().cast("int").alias("cov_type"), *INTERCEPTION, "covden_sum", "covden_win", "retention", radiation_transmission(100 * F.col("covden_win")).alias("rad_trncf"))


def derived_cover_parameters(means: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Parameters from zonal means of ready grids: (zone, cov_type, canopy, loss, srain, wrain, snow).

    Density is 0 for cover type 0; a null loss leaves the winter density null; null
    interceptions are 0.
    """
    summer = F.when(F.col("cov_type") == 0, 0.0).otherwise(F.col("canopy") / 100)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(f"{c}_intcp")
    out = means.select(zone, "cov_type", summer.alias("covden_sum"), winter_density(summer, F.col("loss")).alias("covden_win"), zero("srain"), zero("wrain"), zero("snow"))
    return out.withColumn("rad_trncf", radiation_transmission(100 * F.col("covden_win")))
