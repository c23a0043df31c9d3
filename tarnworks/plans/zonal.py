"""Queries of scans, zonal statistics, cover and flux."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnworks.core import checks
from tarnworks.functions import scalar
from tarnworks.operators import cover, flux, zonal
from tarnworks.plans.base import model, query
from tarnworks.core.io import table
from tarnworks.sources import scans, sinks


def r(df, digits=4, *columns):
    """Rounded doubles, so that sums in any order compare equal."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.round(c, digits) for c in (columns or df.columns) if kinds[c] == "double"})


COVER_SQL = """+ m AS (
  SELECT p.*, c.*, k.canopy_mean FROM perc p JOIN crosswalk c USING (lu_code) LEFT JOIN canopy k USING (zone_id)
), t AS (
  SELECT zone_id, nhm_cov_type AS t, sum(perc) AS perc FROM m GROUP BY zone_id, nhm_cov_type
), c AS (
  SELECT zone_id, coalesce(sum(perc) FILTER (t = 0), 0) AS bare, coalesce(sum(perc) FILTER (t = 1), 0) AS grass, coalesce(sum(perc) FILTER (t = 2), 0) AS shrub,
         coalesce(sum(perc) FILTER (t = 3), 0) AS tree, arg_max(t, (perc, -t)) AS best FROM t GROUP BY zone_id
), v AS (
  SELECT zone_id, CAST(CASE WHEN bare >= 90 THEN 0 WHEN tree >= 20 THEN 3 WHEN shrub >= 20 THEN 2 WHEN shrub + tree >= 35 THEN CASE WHEN tree >= shrub THEN 3 ELSE 2 END
         WHEN grass >= 50 THEN 1 ELSE best END AS INTEGER) AS cov_type FROM c
), s AS (
  SELECT zone_id, sum(CASE WHEN nhm_cov_type = 0 THEN 0 ELSE perc * 0.01 * srain_intcp END) AS srain_intcp, sum(CASE WHEN nhm_cov_type = 0 THEN 0 ELSE perc * 0.01 * wrain_intcp END) AS wrain_intcp,
         sum(CASE WHEN nhm_cov_type = 0 THEN 0 ELSE perc * 0.01 * snow_intcp END) AS snow_intcp, sum(CASE WHEN nhm_cov_type = 0 THEN 0 ELSE perc * 0.01 * evergreen_retention END) AS retention,
         coalesce(sum(CASE WHEN nhm_cov_type = 0 THEN 0 ELSE perc * 0.01 * canopy_mean * 0.01 END), 0) AS covden_sum,
         coalesce(sum(CASE WHEN nhm_cov_type = 0 THEN 0 ELSE perc * 0.01 * canopy_mean * 0.01 * nhm_covden_win END), 0) AS covden_win FROM m GROUP BY zone_id
)"""


@query("cover_parameters", COVER_SQL + """ SELECT v.zone_id, cov_type, round(srain_intcp, 4) AS srain_intcp, round(wrain_intcp, 4) AS wrain_intcp, round(snow_intcp, 4) AS snow_intcp,
 round(covden_sum, 4) AS covden_sum, round(covden_win, 4) AS covden_win, round(retention, 4) AS retention, round(exp(-2.7557 * covden_win) * 0.9917, 4) AS rad_trncf FROM v JOIN s USING (zone_id)""",
       ("perc", "crosswalk", "canopy"))
def agg07(spark, sf):
    perc = cover.class_percentages(zonal.histogram(model(spark, sf, "cells")).withColumnRenamed("class", "lu_code"))
    return r(cover.cover_parameters(perc, scans.checked_crosswalk(model(spark, sf, "crosswalk")), model(spark, sf, "canopy")))


@query("agg01_class_percentages", "SELECT zone_id, lu_code, round(perc, 4) AS perc FROM perc WHERE perc > 0", ("perc",))
def agg01(spark, sf):
    return r(cover.class_percentages(zonal.histogram(model(spark, sf, "cells")).withColumnRenamed("class", "lu_code")))


@query("agg02_unmatched_codes", "SELECT DISTINCT lu_code FROM perc WHERE lu_code NOT IN (SELECT lu_code FROM crosswalk)", ("perc", "crosswalk"))
def agg02(spark, sf):
    return cover.unmatched_codes(model(spark, sf, "perc"), model(spark, sf, "crosswalk"))


@query("agg03_cover_type", COVER_SQL + " SELECT * FROM v", ("perc", "crosswalk", "canopy"))
def agg03(spark, sf):
    return cover.cover_type(model(spark, sf, "perc"), model(spark, sf, "crosswalk"))


@query("agg04_interception", COVER_SQL + " SELECT zone_id, round(srain_intcp, 4) AS srain_intcp, round(wrain_intcp, 4) AS wrain_intcp, round(snow_intcp, 4) AS snow_intcp FROM s", ("perc", "crosswalk", "canopy"))
def agg04(spark, sf):
    return r(cover.interception(model(spark, sf, "perc"), model(spark, sf, "crosswalk")))


@query("agg05_cover_density", COVER_SQL + " SELECT zone_id, round(covden_sum, 4) AS covden_sum, round(covden_win, 4) AS covden_win FROM s", ("perc", "crosswalk", "canopy"))
def agg05(spark, sf):
    return r(cover.cover_density(model(spark, sf, "perc"), model(spark, sf, "crosswalk"), model(spark, sf, "canopy")))


@query("agg06_evergreen_retention", COVER_SQL + " SELECT zone_id, round(retention, 4) AS retention FROM s", ("perc", "crosswalk", "canopy"))
def agg06(spark, sf):
    return r(cover.evergreen_retention(model(spark, sf, "perc"), model(spark, sf, "crosswalk")))


DERIVED = """SELECT zone_id, CAST(zone_id % 5 AS INTEGER) AS cov_type, avg(value) / 1000 AS canopy, CASE WHEN zone_id % 7 = 0 THEN NULL ELSE avg(w) END AS loss,
  CASE WHEN zone_id % 6 = 0 THEN NULL ELSE avg(w) / 100 END AS srain, avg(w) / 90 AS wrain, avg(w) / 80 AS snow FROM cells GROUP BY zone_id"""


@query("agg08_derived_cover_parameters", f"""+ z AS ({DERIVED}), d AS (SELECT *, CASE WHEN cov_type = 0 THEN 0 ELSE canopy / 100 END AS cs FROM z)
 SELECT zone_id, cov_type, round(cs, 6) AS covden_sum, round(cs * (1 - loss / 100), 6) AS covden_win, round(coalesce(srain, 0), 6) AS srain_intcp, round(coalesce(wrain, 0), 6) AS wrain_intcp,
 round(coalesce(snow, 0), 6) AS snow_intcp, round(exp(-2.7557 * coalesce(cs * (1 - loss / 100), 0)) * 0.9917, 6) AS rad_trncf FROM d""", ("cells",))  # fmt: skip
def agg08(spark, sf):
    return r(cover.derived_cover_parameters(spark.sql(DERIVED.replace("FROM cells", "FROM {cells}"), cells=model(spark, sf, "cells"))), 6)


WEIGHTS = "SELECT l_suppkey AS zone_id, l_partkey AS flux_id, sum(l_quantity) AS area_weight FROM lineitem GROUP BY l_suppkey, l_partkey"
LITH = "SELECT p_partkey AS flux_id, CASE WHEN p_size % 9 = 0 THEN 0 ELSE -10 - p_size % 6 END AS k_perm, p_retailprice AS flux_id_area FROM part"
FLUX_SQL = f"""WITH weights AS ({WEIGHTS}), lith AS ({LITH}), k AS (
  SELECT zone_id, sum(pow(10.0, CASE WHEN k_perm = 0 THEN -16.48 ELSE k_perm END) * area_weight / flux_id_area) * 1e10 AS k FROM weights JOIN lith USING (flux_id) GROUP BY zone_id
), x AS (SELECT k.zone_id, k, tan(radians(s_acctbal / 1000 + 10)) AS s, 1000 + s_suppkey AS a, s_nationkey % 5 AS batch_id FROM k JOIN supplier ON s_suppkey = zone_id)"""


def _flux(spark, sf):
    li, pa, su = (table(spark, sf, t) for t in ("lineitem", "part", "supplier"))
    weights = spark.sql(WEIGHTS.replace("FROM lineitem", "FROM {li}"), li=li)
    lith = spark.sql(LITH.replace("FROM part", "FROM {pa}"), pa=pa)
    w = weights.join(lith.select("flux_id", "flux_id_area"), "flux_id")
    perm = flux.permeability(w, lith).withColumn("k_perm_wtd", F.col("k_perm_wtd") * 1e10)
    slope = su.select(F.col("s_suppkey").alias("zone_id"), (F.col("s_acctbal") / 1000 + 10).alias("mean"))
    area = su.select(F.col("s_suppkey").alias("zone_id"), (1000 + F.col("s_suppkey")).cast("double").alias("area"))
    return perm, slope, area, su.select(F.col("s_suppkey").alias("zone_id"), (F.col("s_nationkey") % 5).cast("int").alias("batch_id"))


@query("agg09_permeability", FLUX_SQL + " SELECT zone_id, round(k, 6) AS k_perm_wtd FROM x")
def agg09(spark, sf):
    return r(_flux(spark, sf)[0], 6)


@query("agg10_flux_raw", FLUX_SQL + """ SELECT zone_id, round(k ** 3, 6) AS soil2gw_max, round(k * (1 - s), 6) AS ssr2gw_rate, round(k * s / a, 6) AS slowcoef_lin, round(2 * k * s / a, 6) AS fastcoef_lin,
 round(k * s / a, 6) AS gwflow_coef, round(k * (1 - s), 6) AS dprst_seep_rate_open, round(2 * k * s / a, 6) AS dprst_flow_coef FROM x""")
def agg10(spark, sf):
    return r(flux.raw_parameters(*_flux(spark, sf)[:3]), 6)


@query("agg11_flux_rescaled", FLUX_SQL + """, v AS (SELECT zone_id, batch_id, k ** 3 AS p, k * s / a AS q FROM x)
 SELECT zone_id, CAST(batch_id AS INTEGER) AS batch_id,
 round(CASE WHEN max(p) OVER b = min(p) OVER b THEN 0.3 ELSE (p - min(p) OVER b) / (max(p) OVER b - min(p) OVER b) * 0.4 + 0.1 END, 4) AS soil2gw_max,
 round(CASE WHEN max(q) OVER b = min(q) OVER b THEN 0.026 ELSE (q - min(q) OVER b) / (max(q) OVER b - min(q) OVER b) * 0.048 + 0.002 END, 4) AS slowcoef_lin FROM v WINDOW b AS (PARTITION BY batch_id)""")
def agg11(spark, sf):
    perm, slope, area, batch = _flux(spark, sf)
    raw = flux.raw_parameters(perm, slope, area).select("zone_id", "soil2gw_max", "slowcoef_lin").join(batch, "zone_id")
    return r(flux.rescale(raw, {"soil2gw_max": (0.1, 0.5), "slowcoef_lin": (0.002, 0.05)}, "batch_id"))


@query("agg11_flux_rescaled_global", FLUX_SQL + ", v AS (SELECT zone_id, k ** 3 AS p FROM x) SELECT zone_id, round((p - min(p) OVER ()) / (max(p) OVER () - min(p) OVER ()) * 0.4 + 0.1, 4) AS soil2gw_max FROM v")
def agg11g(spark, sf):
    raw = flux.raw_parameters(*_flux(spark, sf)[:3]).select("zone_id", "soil2gw_max")
    return r(flux.rescale(raw, {"soil2gw_max": (0.1, 0.5)}))


@query("zon02_continuous", """+ o AS (SELECT zone_id, value, sum(w) OVER (PARTITION BY zone_id ORDER BY value) / sum(w) OVER (PARTITION BY zone_id) AS share FROM cells WHERE value IS NOT NULL)
 , q AS (SELECT zone_id, min(value) FILTER (share >= 0.25 - 1e-12) AS p25, min(value) FILTER (share >= 0.5 - 1e-12) AS p50, min(value) FILTER (share >= 0.75 - 1e-12) AS p75 FROM o GROUP BY zone_id)
 , s AS (SELECT zone_id, coalesce(sum(w) FILTER (value IS NOT NULL), 0) AS count, sum(w * value) / sum(w) FILTER (value IS NOT NULL) AS mean,
   sqrt(greatest(sum(w * value * value) / sum(w) FILTER (value IS NOT NULL) - (sum(w * value) / sum(w) FILTER (value IS NOT NULL)) ** 2, 0)) AS std, min(value) AS min, max(value) AS max, sum(w * value) AS sum FROM cells GROUP BY zone_id)
 SELECT zone_id, round(count, 3) AS count, round(mean, 3) AS mean, round(std, 3) AS std, round(min, 3) AS min, round(max, 3) AS max, round(sum, 3) AS sum, round(p25, 3) AS p25, round(p50, 3) AS p50, round(p75, 3) AS p75
 FROM s LEFT JOIN q USING (zone_id)""", ("cells",))  # fmt: skip
def zon02(spark, sf):
    return r(zonal.continuous(model(spark, sf, "cells")), 3)


@query("zon03_histogram", "SELECT zone_id, lu_code AS class, n, sum(n) OVER (PARTITION BY zone_id) AS total FROM hist", ("hist",))
def zon03(spark, sf):
    return zonal.histogram(model(spark, sf, "cells"))


@query("zon04_dominant", "SELECT zone_id, arg_max(lu_code, (n, -lu_code)) AS dominant FROM hist GROUP BY zone_id", ("hist",))
def zon04(spark, sf):
    return zonal.dominant(zonal.histogram(model(spark, sf, "cells")))


@query("zon05_mean_parameter", "SELECT zone_id, round(sum(w * value) / sum(w) FILTER (value IS NOT NULL), 4) AS elevation FROM cells GROUP BY zone_id", ("cells",))
def zon05(spark, sf):
    return r(zonal.mean_parameter(model(spark, sf, "cells"), "elevation"))


@query("zon06_scaled_mean", "SELECT zone_id, round(sum(w * value) / sum(w) FILTER (value IS NOT NULL) * 0.01, 4) AS srain FROM cells GROUP BY zone_id", ("cells",))
def zon06(spark, sf):
    return r(zonal.mean_parameter(model(spark, sf, "cells"), "srain", 0.01))


@query("zon07_mask_counts", """SELECT zone_id, coalesce(sum(w) FILTER (class = 1), 0) AS imperv, coalesce(sum(w) FILTER (value > 50000), 0) AS high, coalesce(sum(w) FILTER (flag = 'R'), 0) AS wet
 FROM cells GROUP BY zone_id""", ("cells",))  # fmt: skip
def zon07(spark, sf):
    return zonal.mask_counts(model(spark, sf, "cells"), {"imperv": F.col("class") == 1, "high": F.col("value") > 50000, "wet": F.col("flag") == "R"})


@query("zon08_float_mean", "SELECT zone_id, round(sum(w * value) / sum(w) FILTER (value IS NOT NULL), 4) AS mean FROM cells GROUP BY zone_id", ("cells",))
def zon08(spark, sf):
    return r(zonal.mean_parameter(model(spark, sf, "cells"), "mean"))


@query("zon09_depth_finalised", """+ c AS (SELECT zone_id, w, CASE WHEN zone_id % 4 <> 0 THEN value END AS value FROM cells), m AS (SELECT zone_id, sum(w * value) / sum(w) FILTER (value IS NOT NULL) / 10000 - 4.5 AS mean FROM c GROUP BY zone_id)
 SELECT z.zone_id, round(CASE WHEN mean IS NULL OR mean * 39.3701 <= 0 THEN 49 ELSE least(mean * 39.3701, 300) END, 4) AS depth_in,
 CASE WHEN mean IS NULL THEN 'no_dprst_cells' WHEN mean * 39.3701 <= 0 THEN 'unknown' ELSE 'joined' END AS source FROM zones z LEFT JOIN m USING (zone_id)""", ("cells", "zones"))  # fmt: skip
def zon09(spark, sf):
    cells = model(spark, sf, "cells").withColumn("value", F.when(F.col("zone_id") % 4 != 0, F.col("value")))
    means = zonal.mean_parameter(cells, "mean", 1e-4).withColumn("mean", F.col("mean") - 4.5)
    return r(zonal.finalise_depth(model(spark, sf, "zones").select("zone_id"), means))


@query("zon10_majority_label", """+ s AS (SELECT zone_id, flag AS method, sum(w) AS area FROM cells GROUP BY zone_id, flag)
 SELECT zone_id, arg_min(method, (-area, method)) AS method, max(area) AS area FROM s GROUP BY zone_id""", ("cells",))  # fmt: skip
def zon10(spark, sf):
    return zonal.majority_label(model(spark, sf, "cells").select("zone_id", F.col("flag").alias("method"), F.col("w").alias("area")))


def _num_den(spark, sf):
    c = model(spark, sf, "cells")
    pick = lambda cond: c.where(cond).groupBy("zone_id").agg(F.sum("w").alias("count"))
    return pick("class < 2 AND zone_id % 3 > 0"), pick("line = 1 AND zone_id % 5 > 0")


RATIO = """+ a AS (SELECT zone_id, sum(w) AS num FROM cells WHERE class < 2 AND zone_id % 3 > 0 GROUP BY zone_id), b AS (SELECT zone_id, sum(w) AS den FROM cells WHERE line = 1 AND zone_id % 5 > 0 GROUP BY zone_id)
 , f AS (SELECT zone_id, coalesce(num, 0) AS num, coalesce(den, 0) AS den FROM a FULL JOIN b USING (zone_id))"""


@query("zon11_ratio", RATIO + " SELECT zone_id, round(CASE WHEN den = 0 THEN 0 ELSE least(num / den, 1) END, 6) AS ratio FROM f", ("cells",))
def zon11(spark, sf):
    return r(zonal.ratio(*_num_den(spark, sf)), 6)


@query("zon11_ratio_unclamped", RATIO + " SELECT zone_id, round(CASE WHEN den = 0 THEN 0 ELSE num / den END, 6) AS ratio FROM f", ("cells",))
def zon11u(spark, sf):
    return r(zonal.ratio(*_num_den(spark, sf), clamp=False), 6)


@query("zon11_ratio_quality", RATIO + " SELECT count(*) AS n_total, count(*) FILTER (den = 0) AS n_zero_denom, count(*) FILTER (den > 0 AND num > den) AS n_clamped FROM f", ("cells",))
def zon11q(spark, sf):
    return zonal.ratio_quality(*_num_den(spark, sf))


@query("jon14_full_counts", RATIO + " SELECT * FROM f", ("cells",))
def jon14(spark, sf):
    return zonal.full_counts(*_num_den(spark, sf))


SERIES_W = "SELECT l_suppkey AS zone_id, CAST(l_partkey AS INTEGER) AS row, CAST(l_linenumber AS INTEGER) AS col, count(*) / 4.0 AS w FROM lineitem GROUP BY l_suppkey, l_partkey, l_linenumber"
SERIES_G = """SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_partkey AS INTEGER) AS row, CAST(l_linenumber AS INTEGER) AS col, CASE WHEN min(l_quantity) < 2 THEN NULL ELSE max(l_quantity) END AS swe
 FROM lineitem GROUP BY CAST(l_shipdate AS DATE), l_partkey, l_linenumber"""
_V = "sum(w * swe) / sum(w) FILTER (swe IS NOT NULL)"
SERIES_SQL = f"WITH weights AS ({SERIES_W}), series AS ({SERIES_G}), j AS (SELECT * FROM weights JOIN series USING (row, col)) "


def _series(spark, sf):
    li = table(spark, sf, "lineitem")
    return (spark.sql(t.replace("FROM lineitem", "FROM {li}"), li=li) for t in (SERIES_W, SERIES_G))


def _parts(spark, sf):
    """Weights and grid have at most a row each for one of these."""
    return zonal.cell_parts(spark, table(spark, sf, "lineitem").count())


@query("zon12_series", SERIES_SQL + f"""SELECT zone_id, date, round({_V}, 9) AS swe_masked_mean, round(sqrt(greatest(sum(w * swe * swe) / sum(w) FILTER (swe IS NOT NULL) - ({_V}) ** 2, 0)), 9) AS swe_masked_std,
 round(min(swe), 9) AS swe_masked_min, round(max(swe), 9) AS swe_masked_max, round(sum(w * swe), 9) AS swe_masked_sum, round(coalesce(sum(w) FILTER (swe IS NOT NULL), 0), 9) AS swe_masked_count,
 round(CASE WHEN bool_and(swe IS NOT NULL) THEN {_V} END, 9) AS swe_mean, round(CASE WHEN bool_and(swe IS NOT NULL) THEN sum(w * swe) END, 9) AS swe_sum FROM j GROUP BY zone_id, date""")
def zon12(spark, sf):
    return r(zonal.series(*_series(spark, sf), ["swe"], parts=_parts(spark, sf)), 9)


@query("zon13_series_std", SERIES_SQL + f"SELECT zone_id, date, round(sqrt(greatest(sum(w * swe * swe) / sum(w) FILTER (swe IS NOT NULL) - ({_V}) ** 2, 0)), 3) AS swe_std FROM j GROUP BY zone_id, date")
def zon13(spark, sf):
    return r(zonal.series(*_series(spark, sf), ["swe"], parts=_parts(spark, sf)).select("zone_id", "date", F.col("swe_masked_std").alias("swe_std")), 3)


@query("zon14_snow_cover", SERIES_SQL + "SELECT zone_id, date, round(sum(w * CASE WHEN swe IS NULL THEN NULL WHEN swe > 20 THEN 1 ELSE 0 END) / sum(w) FILTER (swe IS NOT NULL), 9) AS sca FROM j GROUP BY zone_id, date")
def zon14(spark, sf):
    w, g = _series(spark, sf)
    g = g.withColumn("sca", zonal.snow_cover(F.col("swe") - 20))
    return r(zonal.series(w, g, ["sca"], parts=_parts(spark, sf)).select("zone_id", "date", F.col("sca_masked_mean").alias("sca")), 9)


@query("zon15_cells_per_zone", SERIES_SQL + "SELECT zone_id, count(*) AS n_cells FROM weights GROUP BY zone_id")
def zon15(spark, sf):
    return zonal.cells_per_zone(next(iter(_series(spark, sf))))


@query("zon16_region_share", "SELECT region, avg(CASE WHEN wet THEN 1.0 ELSE 0 END) AS share, count(*) AS n_cells FROM grid WHERE region <> 0 GROUP BY region", ("grid",))
def zon16(spark, sf):
    return zonal.region_share(model(spark, sf, "grid"), "region", F.col("wet"))


@query("zon17_masked_percent", "SELECT region, 100 * avg(CASE WHEN paved THEN 1.0 ELSE 0 END) AS percent FROM grid WHERE region <> 0 GROUP BY region", ("grid",))
def zon17(spark, sf):
    return zonal.region_share(model(spark, sf, "grid"), "region", F.col("paved")).select("region", (100 * F.col("share")).alias("percent"))


@query("zon18_overlap_by_key", "SELECT l_partkey AS comid, count(DISTINCT l_suppkey) AS n_segments, round(sum(l_quantity - 10), 4) AS overlap_m FROM lineitem WHERE l_quantity - 10 > 1e-6 GROUP BY l_partkey")
def zon18(spark, sf):
    pairs = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("comid"), F.col("l_suppkey").alias("seg_index"), (F.col("l_quantity") - 10).alias("overlap_m"))
    return r(zonal.overlap_by_key(pairs))


@query("zon19_inside_fraction", "SELECT l_partkey AS comid, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity), 6) AS fraction, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity) > 0.5 AS flagged FROM lineitem GROUP BY l_partkey")
def zon19(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("comid"), F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0).alias("inside_area"), F.col("l_quantity").alias("area"))
    return r(zonal.inside_fraction(rows), 6)


@query("zon20_split_shares", """+ n AS (SELECT CAST(nation AS VARCHAR) AS region, ftype, count(*) AS n, sum(area) AS area FROM keys GROUP BY nation, ftype), b AS (SELECT * FROM n UNION ALL SELECT 'all', ftype, sum(n), sum(area) FROM n GROUP BY ftype)
 SELECT region, ftype, CAST(n AS BIGINT) AS n, round(area, 2) AS area, round(100 * n / sum(n) OVER (PARTITION BY region), 4) AS percent FROM b""", ("keys",))  # fmt: skip
def zon20(spark, sf):
    k = model(spark, sf, "keys").withColumnRenamed("nation", "region")
    s = zonal.split_shares(k, "region", "ftype", "area")
    return r(r(s, 2, "area"), 4, "percent")


@query("agg12_duplicate_keys", "SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def agg12(spark, sf):
    return checks.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


@query("agg13_missing_ids", "WITH p AS (SELECT l_orderkey AS id FROM lineitem) SELECT i AS id FROM (SELECT unnest(range(1, (SELECT max(id) FROM p) + 1)) AS i) WHERE i NOT IN (SELECT id FROM p)")
def agg13(spark, sf):
    return checks.missing_ids(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")), "id")


@query("src02_cells", "+ g AS (SELECT *, 100000.0 AS nodata FROM grid) SELECT CAST(1 AS BIGINT) AS grid_id, row, col, value, 1000.0 + (col + 0.5) * 30 AS x, 5000.0 + (row + 0.5) * -30 AS y FROM g WHERE value <> nodata", ("grid",))
def src02(spark, sf):
    cells = model(spark, sf, "grid").select(F.lit(1).cast("long").alias("grid_id"), "row", "col", "value")
    grids = spark.createDataFrame([(1, 30.0, 1000.0, -30.0, 5000.0, 100000.0)], "grid_id long, a double, c double, e double, f double, nodata double")
    return scans.scan_cells(cells, grids)


@query("src03_years", "SELECT zone_id, date, round(swe, 4) AS swe, CAST(year(date) AS INTEGER) AS year FROM daily WHERE year(date) IN (1997, 1998)", ("daily",))
def src03(spark, sf):
    return r(scans.scan_years(model(spark, sf, "daily").select("zone_id", "date", "swe"), [1997, 1998]))


@query("src06_resolved_columns", "SELECT c_custkey AS C_CUSTKEY_, c_nationkey AS nation FROM customer")
def src06(spark, sf):
    d = table(spark, sf, "customer").select(F.col("c_custkey").alias("c_custkey_"), F.col("c_nationkey").alias("NATION"))
    return checks.resolve_columns(d, ["C_CUSTKEY_", "nation"])


@query("src07_strict_cast", "SELECT CAST(substr(c_name, 10) AS BIGINT) AS comid, c_nationkey FROM customer")
def src07(spark, sf):
    d = table(spark, sf, "customer").select(F.substring("c_name", 10, 20).alias("comid"), "c_nationkey")
    return checks.strict_cast(d, "comid", "bigint")


@query("src08_union_parts", "SELECT c_custkey AS id, c_name AS name, 'c' AS part, NULL AS extra FROM customer UNION ALL SELECT s_suppkey, NULL, 's', s_acctbal FROM supplier")
def src08(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("extra"))
    return scans.union_parts({"c": a, "s": b})


@query("src09_offset_ids", """WITH k AS (SELECT c_custkey AS hru_id, CASE c_nationkey % 5 WHEN 0 THEN 'r10U' WHEN 1 THEN 'r10L' WHEN 2 THEN 'r02' WHEN 3 THEN 'rOR' ELSE 'r17' END AS folder FROM customer)
 , n AS (SELECT folder, count(*) AS n FROM k WHERE folder <> 'rOR' GROUP BY folder), o AS (SELECT folder, coalesce(sum(n) OVER (ORDER BY CAST(regexp_extract(folder, '^r(\\d+)', 1) AS INTEGER), regexp_extract(folder, '^r\\d+(.*)$', 1) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM n)
 SELECT folder, hru_id, CAST(hru_id + o AS BIGINT) AS zone_id FROM k JOIN o USING (folder)""".replace("\\\\", "\\"))
def src09(spark, sf):
    k = table(spark, sf, "customer").selectExpr("c_custkey AS hru_id", "CASE c_nationkey % 5 WHEN 0 THEN 'r10U' WHEN 1 THEN 'r10L' WHEN 2 THEN 'r02' WHEN 3 THEN 'rOR' ELSE 'r17' END AS folder")
    return scans.offset_ids(k, "folder", "hru_id")


@query("src10_selected_tables", "WITH d AS (SELECT DISTINCT p_brand AS parameter FROM part WHERE p_type = 'ECONOMY' AND p_size = 1) SELECT p_brand AS parameter, p_partkey FROM part WHERE p_brand IN (SELECT parameter FROM d)")
def src10(spark, sf):
    p = table(spark, sf, "part")
    dictionary = p.where("p_size = 1").select(F.col("p_brand").alias("parameter"), F.when(F.col("p_type") == "ECONOMY", "nhru").otherwise("one").alias("dimensions"))
    return scans.select_tables(dictionary, p.select(F.col("p_brand").alias("parameter"), "p_partkey"), "nhru")


@query("snk02_pinned_keys", "SELECT CAST(c_custkey AS BIGINT) AS comid, CAST(c_nationkey AS INTEGER) AS n_segments, c_acctbal AS overlap_m FROM customer")
def snk02(spark, sf):
    d = table(spark, sf, "customer").select(F.col("c_custkey").alias("comid"), F.col("c_nationkey").alias("n_segments"), F.col("c_acctbal").alias("overlap_m"))
    return sinks.pinned(d, {"comid": "long", "n_segments": "int", "overlap_m": "double"})


@query("snk04_constant_parameter", "SELECT zone_id, 1.0 AS sro_to_dprst FROM zones", ("zones",))
def snk04(spark, sf):
    return sinks.constant_parameter(model(spark, sf, "zones"), "zone_id", "sro_to_dprst")


LIBRARY = "SELECT s_suppkey + 1 AS deplcrv_id, s_acctbal AS a FROM supplier"


@query("snk05_flattened_library", "WITH l AS (SELECT s_suppkey + 1 AS d, s_acctbal AS a, unnest(range(0, 11)) AS i FROM supplier) SELECT CAST((d - 1) * 11 + i AS BIGINT) AS ndeplval, d AS deplcrv_id, round(1 - (10 - i) * 0.1 + a, 6) AS value FROM l")
def snk05(spark, sf):
    lib = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1).alias("deplcrv_id"), F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: 1 - i * 0.1 + F.col("s_acctbal")).alias("curve"))
    return r(sinks.flatten_library(lib), 6)
