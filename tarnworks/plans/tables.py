"""Queries of vector operators, key sets, audits, thresholds, depths and gap filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnworks.core.io import table
from tarnworks.functions import scalar
from tarnworks.operators import tables as t
from tarnworks.operators import vector
from tarnworks.operators.ranks import exact_percentiles
from tarnworks.plans.base import model, query
from tarnworks.plans.zonal import r

# L-shaped polygons on a grid of 10 x n places: a rectangle less its upper right corner.
SHAPE = """SELECT s_suppkey AS zone_id, (s_suppkey % 10) * 9 + 0.3 AS x0, floor(s_suppkey / 10) * 9 + 0.45 AS y0, (s_suppkey % 10) * 9 + 5.3 + (s_suppkey % 4) AS x1,
 floor(s_suppkey / 10) * 9 + 4.75 + (s_suppkey % 3) AS y1, (s_suppkey % 10) * 9 + 2.6 AS xm, floor(s_suppkey / 10) * 9 + 2.2 AS ym FROM supplier"""


def _edges(spark, sf):
    s = spark.sql(SHAPE.replace("FROM supplier", "FROM {su}"), su=table(spark, sf, "supplier"))
    ring = ["x0", "y0"], ["x1", "y0"], ["x1", "ym"], ["xm", "ym"], ["xm", "y1"], ["x0", "y1"]
    e = F.array(*[F.struct(*[F.col(c).cast("double").alias(n) for c, n in zip((*a, *b), ("x1", "y1", "x2", "y2"))]) for a, b in zip(ring, (*ring[1:], ring[0]))])
    return s.select("zone_id", F.explode(e).alias("e")).select("zone_id", "e.*")


def _points(spark, sf):
    return table(spark, sf, "customer").selectExpr("c_custkey AS point_id", "CAST((c_custkey * 37 % 9001) / 100.0 AS DOUBLE) AS x", "CAST((c_custkey * 53 % 8999) / 100.0 AS DOUBLE) AS y")


PTS = "pts AS (SELECT c_custkey AS point_id, CAST((c_custkey * 37 % 9001) / 100.0 AS DOUBLE) AS x, CAST((c_custkey * 53 % 8999) / 100.0 AS DOUBLE) AS y FROM customer)"
PIP = f"WITH sh AS ({SHAPE}), {PTS}, hit AS (SELECT point_id, zone_id FROM pts JOIN sh ON x >= x0 AND x < x1 AND y >= y0 AND y < y1 AND NOT (x >= xm AND y >= ym)) "


@query("zon01_coverage", f"""WITH sh AS ({SHAPE}), c AS (SELECT sh.*, rr AS row, cc AS col FROM sh, LATERAL (SELECT unnest(range(CAST(floor(y0) AS BIGINT), CAST(ceil(y1) AS BIGINT))) AS rr), LATERAL (SELECT unnest(range(CAST(floor(x0) AS BIGINT), CAST(ceil(x1) AS BIGINT))) AS cc)),
 a AS (SELECT zone_id, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, greatest(0, least(x1, col + 1) - greatest(x0, col)) * greatest(0, least(y1, row + 1) - greatest(y0, row))
  - greatest(0, least(x1, col + 1) - greatest(xm, col)) * greatest(0, least(y1, row + 1) - greatest(ym, row)) AS w FROM c) SELECT zone_id, row, col, round(w, 6) AS w FROM a WHERE w > 1e-9""")
def zon01(spark, sf):
    return r(vector.coverage(_edges(spark, sf)).where("w > 1e-9"), 6)


@query("scl14_measures", f"WITH sh AS ({SHAPE}) SELECT zone_id, round((x1 - x0) * (y1 - y0) - (x1 - xm) * (y1 - ym), 6) AS area, round(x0, 6) AS xmin, round(y0, 6) AS ymin, round(x1, 6) AS xmax, round(y1, 6) AS ymax FROM sh")
def scl14(spark, sf):
    return r(vector.measures(_edges(spark, sf)).drop("cx", "cy"), 6)


@query("scl14_centroids", f"""WITH sh AS ({SHAPE}), a AS (SELECT *, (x1 - x0) * (y1 - y0) AS p, (x1 - xm) * (y1 - ym) AS q FROM sh)
 SELECT zone_id, round((p * (x0 + x1) / 2 - q * (xm + x1) / 2) / (p - q), 5) AS cx, round((p * (y0 + y1) / 2 - q * (ym + y1) / 2) / (p - q), 5) AS cy FROM a""")
def scl14c(spark, sf):
    return r(vector.measures(_edges(spark, sf)).select("zone_id", "cx", "cy"), 5)


@query("jon04_points_in_polygons", PIP + "SELECT * FROM hit")
def jon04(spark, sf):
    return vector.points_in_polygons(_points(spark, sf), _edges(spark, sf))


@query("jon04_first_polygon", PIP + "SELECT p.point_id, coalesce(CAST(min(h.zone_id) AS VARCHAR), 'unassigned') AS zone_id FROM pts p LEFT JOIN hit h USING (point_id) GROUP BY p.point_id")
def jon04f(spark, sf):
    return vector.first_polygon(_points(spark, sf), _edges(spark, sf))


@query("jon05_points_per_polygon", PIP + "SELECT zone_id, count(*) AS n_points FROM hit GROUP BY zone_id")
def jon05(spark, sf):
    return vector.points_per_polygon(_points(spark, sf), _edges(spark, sf))


RASTER = f"""WITH sh AS ({SHAPE}), c AS (SELECT zone_id, CAST(rr AS INTEGER) AS row, CAST(cc AS INTEGER) AS col FROM sh, LATERAL (SELECT unnest(range(CAST(floor(y0) AS BIGINT), CAST(ceil(y1) AS BIGINT))) AS rr), LATERAL (SELECT unnest(range(CAST(floor(x0) AS BIGINT), CAST(ceil(x1) AS BIGINT))) AS cc)
 WHERE cc + 0.5 >= x0 AND cc + 0.5 < x1 AND rr + 0.5 >= y0 AND rr + 0.5 < y1 AND NOT (cc + 0.5 >= xm AND rr + 0.5 >= ym)) """


@query("grd06_rasterised", RASTER + "SELECT * FROM c")
def grd06(spark, sf):
    return vector.rasterise(_edges(spark, sf))


@query("grd08_rasterised_ids", RASTER + "SELECT row, col, max(zone_id) AS label FROM c GROUP BY row, col")
def grd08(spark, sf):
    return vector.last_polygon_wins(vector.rasterise(_edges(spark, sf)))


@query("jon12_nearest", f"""WITH {PTS}, m AS (SELECT * FROM pts WHERE point_id % 7 = 0), d AS (SELECT * FROM pts WHERE point_id % 7 <> 0),
 j AS (SELECT m.point_id AS zone_id, d.point_id AS donor, sqrt((m.x - d.x) ** 2 + (m.y - d.y) ** 2) AS distance FROM m, d), k AS (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY distance, donor) AS rank FROM j)
 SELECT zone_id, CAST(rank AS INTEGER) AS rank, donor, round(distance, 6) AS distance FROM k WHERE rank <= 3""")
def jon12(spark, sf):
    p = _points(spark, sf).withColumnRenamed("point_id", "zone_id")
    return r(vector.nearest(p.where("zone_id % 7 = 0"), p.where("zone_id % 7 <> 0"), 3), 6)


@query("agg49_gap_fill", f"""WITH {PTS}, v AS (SELECT point_id, x, y, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS a FROM pts JOIN customer ON c_custkey = point_id),
 j AS (SELECT m.point_id, d.a, row_number() OVER (PARTITION BY m.point_id ORDER BY sqrt((m.x - d.x) ** 2 + (m.y - d.y) ** 2), d.point_id) AS k FROM v m, v d WHERE m.a IS NULL AND d.a IS NOT NULL)
 SELECT v.point_id AS zone_id, round(coalesce(v.a, f.a), 6) AS a FROM v LEFT JOIN (SELECT point_id, avg(a) AS a FROM j WHERE k <= 2 GROUP BY point_id) f USING (point_id)""")
def agg49(spark, sf):
    p = _points(spark, sf).withColumnRenamed("point_id", "zone_id")
    params = table(spark, sf, "customer").where("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("zone_id"), F.col("c_acctbal").alias("a"))
    return r(t.fill_gaps(params, p, ["a"], k=2), 6)


@query("jon15_every_id", "SELECT c_custkey AS zone_id, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS v FROM customer")
def jon15(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("zone_id")).join(c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("zone_id"), F.col("c_acctbal").alias("v")), "zone_id", "left")


@query("jon16_copied_absent", "SELECT c_custkey AS zone_id, CASE WHEN c_custkey % 4 = 0 THEN (c_nationkey + 1) * 2.5 ELSE c_acctbal END AS v FROM customer")
def jon16(spark, sf):
    c = table(spark, sf, "customer")
    params = c.selectExpr("c_custkey AS zone_id", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS v")
    return t.copy_absent(params, c.selectExpr("c_custkey AS zone_id", "c_nationkey + 1 AS area"), "zone_id", "v", "area", 2.5)


@query("jon19_tile_membership", """WITH b AS (SELECT s_suppkey AS k, s_suppkey * 3.5 AS x0, s_nationkey * 4.0 AS y0 FROM supplier), f AS (SELECT DISTINCT c_custkey % 40 AS tx, c_nationkey AS ty FROM customer WHERE c_custkey % 3 = 0),
 t AS (SELECT k, tx, ty FROM b, LATERAL (SELECT unnest(range(CAST(floor(x0 / 10) AS BIGINT), CAST(floor((x0 + 14) / 10) AS BIGINT) + 1)) AS tx), LATERAL (SELECT unnest(range(CAST(floor(y0 / 10) AS BIGINT), CAST(floor((y0 + 9) / 10) AS BIGINT) + 1)) AS ty)),
 h AS (SELECT k, tx || '_' || ty AS tile, 'fine' AS resolution FROM t JOIN f USING (tx, ty)) SELECT * FROM h UNION ALL SELECT k, 'coarse', 'coarse' FROM b WHERE k NOT IN (SELECT k FROM h)""")
def jon19(spark, sf):
    b = table(spark, sf, "supplier").selectExpr("s_suppkey AS k", "s_suppkey * 3.5D AS xmin", "s_suppkey * 3.5D + 14 AS xmax", "s_nationkey * 4.0D AS ymin", "s_nationkey * 4.0D + 9 AS ymax")
    fine = table(spark, sf, "customer").where("c_custkey % 3 = 0").selectExpr("c_custkey % 40 AS tx", "CAST(c_nationkey AS BIGINT) AS ty")
    return vector.tile_membership(b, "k", 10.0, fine)


@query("par01_spatial_batches", f"""WITH RECURSIVE {PTS}, h AS (
 SELECT point_id AS zone_id, x, y, CAST(1 AS BIGINT) AS node, 0 AS level, CASE WHEN n > 100 THEN greatest(0, ceil(log2(greatest(1, n // 100)))) ELSE 0 END AS levels FROM pts, (SELECT count(*) AS n FROM pts)
 UNION ALL
 SELECT zone_id, x, y, 2 * node + CASE WHEN n > 50 AND lo < hi AND v > cut THEN 1 ELSE 0 END, level + 1, levels FROM (
  SELECT *, count(*) OVER (PARTITION BY node) AS n, min(v) OVER (PARTITION BY node) AS lo, max(v) OVER (PARTITION BY node) AS hi, quantile_cont(v, 0.5) OVER (PARTITION BY node) AS cut
  FROM (SELECT *, CASE WHEN level % 2 = 0 THEN x ELSE y END AS v FROM h WHERE level < levels)))
 SELECT zone_id, CAST(dense_rank() OVER (ORDER BY node) - 1 AS INTEGER) AS batch_id FROM h WHERE level = levels""")
def par01(spark, sf):
    return vector.spatial_batches(_points(spark, sf).withColumnRenamed("point_id", "zone_id"), 100)


K = ("keys",)
A, B, C = "nation < 12", "ftype = 'BUILDING'", "area > 5000"


def _sets(spark, sf):
    k = model(spark, sf, "keys")
    return k, k.where(A), k.where(B), k.where(C)


@query("set01_union", f"SELECT DISTINCT comid FROM keys WHERE {A} OR {B} OR {C}", K)
def set01(spark, sf):
    return t.union_keys(*_sets(spark, sf)[1:])


@query("set02_subtraction", f"SELECT comid FROM keys WHERE {A} AND NOT ({B})", K)
def set02(spark, sf):
    _, a, b, _ = _sets(spark, sf)
    return t.subtract_keys(a, b)


@query("set03_repromoted", f"SELECT comid FROM keys WHERE {A} AND {C}", K)
def set03(spark, sf):
    _, a, _, c = _sets(spark, sf)
    return t.repromoted(a, c)


@query("set04_evidence", f"SELECT comid, CASE WHEN {A} THEN area / 10000 END AS frac_own, coalesce({A} AND area / 10000 > 0.5, false) AS by_terminus, {B} AS by_second FROM keys WHERE {A} OR {B}", K)
def set04(spark, sf):
    _, a, b, _ = _sets(spark, sf)
    return t.evidence(a.withColumn("frac_own", F.col("area") / 10000), b)


@query("set06_routed_keys", "SELECT comid FROM keys WHERE nation <> 0", K)
def set06(spark, sf):
    return t.network_keys(model(spark, sf, "keys").withColumnRenamed("nation", "dnhydroseq"))[1]


@query("zon21_set_sizes", f"SELECT count(*) FILTER ({A}) AS a, count(*) FILTER ({B}) AS b, count(*) FILTER ({C}) AS c, count(*) FILTER ({B} OR {C}) AS b_or_c, count(*) FILTER (({A}) AND ({B} OR {C})) AS a_and_bc, count(*) FILTER (({A}) AND NOT ({B} OR {C})) AS a_only, count(*) FILTER (NOT ({A}) AND ({B} OR {C})) AS bc_only FROM keys", K)
def zon21(spark, sf):
    return t.set_sizes(*_sets(spark, sf)[1:])


@query("jon09_gated_keys", "SELECT DISTINCT l_partkey AS wb FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' AND l_partkey > 0")
def jon09(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr("l_partkey AS wb", "l_orderkey AS line")
    return t.gated_keys(lines, table(spark, sf, "orders").where("o_orderstatus = 'F'").selectExpr("o_orderkey AS line"), "wb", "line")


@query("jon10_either_key", "SELECT comid, nation FROM keys WHERE comid % 11 = 0 OR (comid * 3) % 700 % 11 = 0", K)
def jon10(spark, sf):
    k = model(spark, sf, "keys").withColumn("member", F.col("comid") * 3 % 700)
    return t.either_key(k.withColumn("rid", F.col("comid")), k.where("comid % 11 = 0").union(k.where("false")), "rid", "comid", "member").select("comid", "nation")


@query("agg14_gap_runs", """WITH p AS (SELECT o_orderkey AS id FROM orders WHERE o_custkey % 3 <> 0), n AS (SELECT id, lead(id) OVER (ORDER BY id) AS nx FROM p) SELECT id + 1 AS first, nx - 1 AS last, nx - id - 1 AS size FROM n WHERE nx > id + 1""")
def agg14(spark, sf):
    return t.gap_runs(table(spark, sf, "orders").where("o_custkey % 3 <> 0").select(F.col("o_orderkey").alias("id")), "id")


@query("agg15_id_profile", " UNION ALL ".join(f"SELECT '{c}' AS name, min({c})::BIGINT AS low, max({c})::BIGINT AS high, count({c}) AS n, count(DISTINCT {c}) AS n_distinct, count({c}) = count(DISTINCT {c}) AS is_unique, max({c}) - min({c}) + 1 = count(DISTINCT {c}) AS is_contiguous FROM orders" for c in ("o_orderkey", "o_custkey")))
def agg15(spark, sf):
    return t.id_profile(table(spark, sf, "orders"), ["o_orderkey", "o_custkey"])


@query("agg16_shared_ids", "SELECT l_orderkey, count(DISTINCT l_linenumber) AS n_parts FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linenumber) > 1")
def agg16(spark, sf):
    return t.shared_ids(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query("agg17_percentiles", "SELECT quantile_cont(value, 0.02) AS p2, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.98) AS p98 FROM grid", ("grid",))
def agg17(spark, sf):
    return r(t.percentiles(model(spark, sf, "grid"), "value", [2, 50, 98]), 9)


@query("agg18_rank", "SELECT 100 * avg(CASE WHEN value <= 200000 THEN 1.0 ELSE 0 END) AS rank FROM grid", ("grid",))
def agg18(spark, sf):
    return t.rank_of(model(spark, sf, "grid"), "value", 200000)


@query("agg19_reference_thresholds", """SELECT 'region' AS scope, CAST(region AS VARCHAR) AS region, round(quantile_cont(value, 0.8), 6) AS t_carea, round(quantile_cont(value, 0.95), 6) AS t_smidx FROM grid WHERE region IS NOT NULL GROUP BY region
 UNION ALL SELECT 'pooled', NULL, round(quantile_cont(value, 0.8), 6), round(quantile_cont(value, 0.95), 6) FROM grid WHERE region IS NOT NULL""", ("grid",))
def agg19(spark, sf):
    return r(t.reference_thresholds(model(spark, sf, "grid"), "region", "value", 80, 95), 6)


@query("agg20_zone_bins", "SELECT region, CAST(least(greatest(floor((value - 50000) / ((450000 - 50000) / 60.0)), 0), 59) AS INTEGER) AS bin, count(*) AS n FROM grid WHERE value IS NOT NULL GROUP BY ALL", ("grid",))
def agg20(spark, sf):
    return t.zone_bins(model(spark, sf, "grid"), "region", "value", 50000.0, 450000.0, 60)


@query("agg23_threshold_sweep", """+ b AS (SELECT zone_id, class AS bin, count(*) AS n FROM cells GROUP BY zone_id, class), z AS (SELECT zone_id, count(*) FILTER (flag = 'R') AS onstream, count(*) * 2 AS n_perv FROM cells GROUP BY zone_id), th AS (SELECT unnest([1.0, 3.0, 5.5]) AS t),
 v AS (SELECT z.zone_id, th.t, least(greatest((onstream + coalesce((SELECT sum(n) FROM b WHERE b.zone_id = z.zone_id AND b.bin + 0.5 > th.t), 0)) / n_perv, 0), 1) AS v FROM z, th)
 SELECT CAST(t AS DOUBLE) AS t, round(avg(v), 6) AS mean, round(median(v), 6) AS median, avg(CASE WHEN v = 0 THEN 1.0 ELSE 0 END) AS share_0, avg(CASE WHEN v = 1 THEN 1.0 ELSE 0 END) AS share_1 FROM v GROUP BY t""", ("cells",))
def agg23(spark, sf):
    c = model(spark, sf, "cells")
    bins = c.groupBy("zone_id", F.col("class").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    totals = c.groupBy("zone_id").agg(F.count_if(F.col("flag") == "R").alias("onstream"), (F.count(F.lit(1)) * 2).alias("n_perv"))
    return r(t.threshold_sweep(bins, totals, "zone_id", 0.0, 1.0, [1.0, 3.0, 5.5]), 6)


@query("agg25_compared_parameters", "SELECT count(*) AS n, round(corr(c_acctbal, c_acctbal * 0.5 + c_nationkey), 6) AS r, round(avg(abs(c_acctbal * 0.5 - c_nationkey)), 4) AS mean_abs FROM customer WHERE c_custkey % 3 = 0")
def agg25(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_acctbal AS v", "c_nationkey")
    return r(r(t.compare_parameters(c, c.where("id % 3 = 0").selectExpr("id", "v * 0.5 + c_nationkey AS v"), "id", "v"), 6, "r"), 4, "mean_abs")


@query("agg27_bimodality", "+ v AS (SELECT area / 10000 AS v FROM keys) SELECT count(*) FILTER (v > 0) AS n, count(*) FILTER (v >= 0.95) AS n_high, count(*) FILTER (v BETWEEN 0.45 AND 0.55) AS n_mid, count(*) FILTER (v > 0.3) AS n_3, count(*) FILTER (v > 0.5) AS n_5, count(*) FILTER (v > 0.7) AS n_7, (count(*) FILTER (v > 0.3) - count(*) FILTER (v > 0.7)) / count(*) FILTER (v > 0) AS swing FROM v", K)
def agg27(spark, sf):
    return t.bimodality(model(spark, sf, "keys").withColumn("v", F.col("area") / 10000), "v")


@query("agg29_named_dissolve", """+ k AS (SELECT *, CASE WHEN comid % 4 = 0 THEN NULL ELSE 'L' || (comid % 30) END AS name FROM keys)
 SELECT nation, name, arg_max(comid, (area, -comid)) AS comid, arg_max(ftype, (area, -comid)) AS ftype, string_agg(CAST(comid AS VARCHAR), ',' ORDER BY comid) AS members, round(sum(area), 2) AS area FROM k WHERE name IS NOT NULL GROUP BY nation, name
 UNION ALL SELECT nation, name, comid, ftype, CAST(comid AS VARCHAR), round(area, 2) FROM k WHERE name IS NULL""", K)
def agg29(spark, sf):
    k = model(spark, sf, "keys").withColumn("name", F.when(F.col("comid") % 4 != 0, F.concat(F.lit("L"), (F.col("comid") % 30).cast("string"))))
    return r(t.named_dissolve(k, "nation", "name", "comid", "ftype", "area"), 2)


@query("agg30_seam_duplicates", "SELECT comid, ftype, area FROM keys", K)
def agg30(spark, sf):
    k = model(spark, sf, "keys").select("comid", "ftype", "area")
    return t.seam_duplicates(k.union(k.where("comid % 5 = 0")), "comid", ["ftype"], "area")


@query("agg31_first_rows", "SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS rr FROM lineitem) WHERE rr = 1")
def agg31(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    return t.first_rows(li, "l_partkey", ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"])


@query("agg32_completeness", "SELECT avg(CASE WHEN dprst_depth_m IS NOT NULL THEN 1.0 ELSE 0 END) AS share FROM depths", ("depths",))
def agg32(spark, sf):
    return model(spark, sf, "depths").agg(F.avg(F.col("dprst_depth_m").isNotNull().cast("double")).alias("share"))


DONORS = """+ d AS (SELECT ecoregion, ftype, comid, dprst_depth_m AS y, hollister_max_m / 3.0 AS x FROM depths WHERE NOT flat AND dprst_depth_m > 0),
 f AS (SELECT *, (row_number() OVER (PARTITION BY ecoregion, ftype ORDER BY md5(CAST(comid AS VARCHAR)), comid) - 1) % 5 AS fold FROM d), k AS (SELECT unnest(range(0, 5)) AS test),
 fit AS (SELECT ecoregion, ftype, test, median(y) AS m, sum(x * y) / sum(x * x) AS k FROM f, k WHERE fold <> test GROUP BY ecoregion, ftype, test),
 err AS (SELECT f.ecoregion, f.ftype, avg((y - m) ** 2) AS em, avg((y - fit.k * x) ** 2) AS es FROM f JOIN fit ON f.ecoregion = fit.ecoregion AND f.ftype = fit.ftype AND f.fold = fit.test GROUP BY f.ecoregion, f.ftype),
 mod AS (SELECT ecoregion, ftype, count(*) AS n, median(y) AS median, sum(x * y) / sum(x * x) AS slope, coalesce(any_value(es) < any_value(em), false) AS use_slope FROM d LEFT JOIN err USING (ecoregion, ftype) GROUP BY ecoregion, ftype HAVING count(*) >= 5)"""
DP = ("depths",)


@query("agg34_donor_models", DONORS + " SELECT ecoregion, ftype, n, round(median, 6) AS median, round(slope, 6) AS slope, use_slope FROM mod", DP)
def agg34(spark, sf):
    return r(t.donor_models(model(spark, sf, "depths")), 6)


@query("agg35_filled_depths", DONORS + """, eco AS (SELECT ecoregion, median(y) AS em FROM d GROUP BY ecoregion), ft AS (SELECT ftype, median(y) AS fm FROM d GROUP BY ftype)
 SELECT p.comid, round(least(CASE WHEN NOT flat AND coalesce(dprst_depth_m, 0) > 0 THEN dprst_depth_m ELSE coalesce(CASE WHEN use_slope AND hollister_max_m > 0 THEN slope / 3.0 * hollister_max_m END, median, em, fm, 49 / 39.3701) END, 300 / 39.3701), 6) AS depth_m,
 CASE WHEN NOT flat AND dprst_depth_m > 300 / 39.3701 THEN 'measured_capped' WHEN NOT flat AND coalesce(dprst_depth_m, 0) > 0 THEN 'measured' WHEN use_slope AND hollister_max_m > 0 THEN 'calibrated_slope' WHEN median IS NOT NULL THEN 'group_median' WHEN em IS NOT NULL THEN 'ecoregion_median' WHEN fm IS NOT NULL THEN 'ftype_median' ELSE 'constant_floor' END AS method
 FROM depths p LEFT JOIN mod USING (ecoregion, ftype) LEFT JOIN eco USING (ecoregion) LEFT JOIN ft USING (ftype)""", DP)
def agg35(spark, sf):
    d = model(spark, sf, "depths")
    return r(t.fill_depths(d, t.donor_models(d)).select("comid", "depth_m", "method"), 6)


@query("agg36_flatness_summary", """+ f AS (SELECT class, zone_id, max(value) - min(value) AS range FROM cells WHERE value IS NOT NULL GROUP BY class, zone_id) SELECT class, count(*) AS n, round(median(range), 4) AS median_range, round(quantile_cont(range, 0.9), 4) AS p90_range FROM f GROUP BY class""", ("cells",))
def agg36(spark, sf):
    f = t.flatness(model(spark, sf, "cells").withColumn("k", F.struct("class", "zone_id")), "k")
    f = exact_percentiles(f.select(F.col("k.class").alias("class"), "range"), "range", [0.5, 0.9], ["class"])
    return r(f.select("class", "n", F.get("q", F.lit(0)).alias("median_range"), F.get("q", F.lit(1)).alias("p90_range")))


@query("dep01_flatness", "SELECT zone_id AS comid, round(max(value) - min(value), 4) AS range, round(stddev_pop(value), 4) AS std, count(DISTINCT round(value, 3)) AS n_unique, max(value) - min(value) < 0.01 AS flat FROM cells WHERE value IS NOT NULL GROUP BY zone_id", ("cells",))
def dep01(spark, sf):
    return r(t.flatness(model(spark, sf, "cells").withColumnRenamed("zone_id", "comid")))


@query("dep02_volume_depth", "SELECT l_partkey AS comid, round(sum(l_quantity) * 900, 4) AS volume, count(*) * 900.0 AS area, round(sum(l_quantity) / count(*), 6) AS mean_depth FROM lineitem GROUP BY l_partkey")
def dep02(spark, sf):
    return r(t.volume_depth(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("comid"), F.col("l_quantity").alias("depth")), 900.0), 6)


@query("agg37_loglog_regression", "SELECT ecoregion, count(*) AS n, round(regr_slope(log10(hollister_max_m), log10(area)), 5) AS slope, round(regr_intercept(log10(hollister_max_m), log10(area)), 4) AS intercept, round(regr_r2(log10(hollister_max_m), log10(area)), 5) AS r2, round(min(log10(area)), 6) AS lo, round(max(log10(area)), 6) AS hi FROM depths WHERE area > 0 GROUP BY ecoregion HAVING count(*) >= 3", DP)
def agg37(spark, sf):
    return r(r(r(t.loglog_regression(model(spark, sf, "depths"), "ecoregion", "area", "hollister_max_m"), 5, "slope", "r2"), 4, "intercept"), 6, "lo", "hi")


@query("agg38_prediction_skill", "SELECT count(*) AS n, round(corr(dprst_depth_m, hollister_max_m / 3.0), 6) AS r, round(sqrt(avg((hollister_max_m / 3.0 - dprst_depth_m) ** 2)), 6) AS rmse, round(median(hollister_max_m / 3.0 - dprst_depth_m), 6) AS median_bias FROM depths WHERE dprst_depth_m IS NOT NULL", DP)
def agg38(spark, sf):
    return r(t.prediction_skill(model(spark, sf, "depths").withColumn("guess", F.col("hollister_max_m") / 3), "dprst_depth_m", "guess"), 6)


@query("agg39_ratio_quartiles", "+ v AS (SELECT dprst_depth_m / hollister_max_m AS r FROM depths WHERE dprst_depth_m IS NOT NULL) SELECT count(*) AS n, round(quantile_cont(r, 0.25), 6) AS q1, round(quantile_cont(r, 0.5), 6) AS median, round(quantile_cont(r, 0.75), 6) AS q3, 1 / 3 BETWEEN quantile_cont(r, 0.25) AND quantile_cont(r, 0.75) AS has_inside FROM v", DP)
def agg39(spark, sf):
    return r(t.quartiles(model(spark, sf, "depths"), F.col("dprst_depth_m") / F.col("hollister_max_m")), 6)


@query("agg41_stratified_sample", "SELECT comid, ftype FROM (SELECT comid, ftype, row_number() OVER (PARTITION BY ftype ORDER BY md5(comid || ':7'), comid) AS rr FROM keys) WHERE rr <= 20", K)
def agg41(spark, sf):
    return t.stratified_sample(model(spark, sf, "keys").select("comid", "ftype"), "ftype", "comid", 20, 7)


@query("agg47_undeclared", "SELECT DISTINCT p_brand AS name FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 3 AND p_type = 'SMALL') AND NOT regexp_matches(p_brand, '#1|#2$')")
def agg47(spark, sf):
    p = table(spark, sf, "part")
    names = p.select(F.col("p_brand").alias("name")).distinct()
    return t.undeclared(names, p.where("p_size = 3 AND p_type = 'SMALL'").select(F.col("p_brand").alias("name")), ["#1", "#2$"])


@query("agg48_null_census", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null, count(*) AS n_rows FROM depths" for c in ("dprst_depth_m", "area")).replace("SELECT 'area'", "SELECT 'area'"), DP)
def agg48(spark, sf):
    return t.null_census(model(spark, sf, "depths"), ["dprst_depth_m", "area"])


@query("srt02_top_n", "SELECT ftype, count(*) AS n FROM keys GROUP BY ftype ORDER BY n DESC, ftype LIMIT 3", K)
def srt02(spark, sf):
    return model(spark, sf, "keys").groupBy("ftype").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "ftype").limit(3)


@query("scl01_degrees", "SELECT p_partkey, round(tan(radians(p_size)), 8) AS s FROM part")
def scl01(spark, sf):
    return r(table(spark, sf, "part").select("p_partkey", scalar.degrees_to_fraction(F.col("p_size")).alias("s")), 8)


@query("scl02_radiation", "SELECT p_partkey, round(exp(-2.7557 * CASE WHEN p_size % 7 = 0 THEN 0 ELSE p_size END / 100) * 0.9917, 8) AS v FROM part")
def scl02(spark, sf):
    return r(table(spark, sf, "part").select("p_partkey", scalar.radiation_transmission(F.when(F.col("p_size") % 7 != 0, F.col("p_size"))).alias("v")), 8)


@query("scl03_winter_density", "SELECT p_partkey, round(p_retailprice * (1 - p_size / 100.0), 6) AS v FROM part")
def scl03(spark, sf):
    return r(table(spark, sf, "part").select("p_partkey", scalar.winter_density(F.col("p_retailprice"), F.col("p_size")).alias("v")), 6)


@query("scl04_threshold_inches", "SELECT c_custkey, round(CASE WHEN c_acctbal > 1000 THEN (c_acctbal - 1000) / 25.4 ELSE 0 END, 6) AS v FROM customer")
def scl04(spark, sf):
    return r(table(spark, sf, "customer").select("c_custkey", scalar.threshold_inches(F.col("c_acctbal") - 1000).alias("v")), 6)


@query("scl10_tile_labels", "SELECT c_custkey, printf('n%02dw%03d', CAST(ceil(30 + c_nationkey / 3.0) AS INTEGER), CAST(ceil(90 + c_custkey % 17 / 2.0) AS INTEGER)) AS corner, printf('N%02dW%03d', CAST(floor(30 + c_nationkey / 3.0) AS INTEGER), CAST(-floor(-(90 + c_custkey % 17 / 2.0)) AS INTEGER)) AS low FROM customer")
def scl10(spark, sf):
    lat, lon = 30 + F.col("c_nationkey") / 3, -(90 + F.col("c_custkey") % 17 / 2)
    return table(spark, sf, "customer").select("c_custkey", scalar.corner_tile_label(lon, lat).alias("corner"), scalar.floor_tile_label(lon, lat).alias("low"))


@query("scl11_utm_zone", "SELECT c_custkey, CAST(floor((-(60 + c_custkey % 60) + 180) / 6.0) + 1 AS INTEGER) AS zone FROM customer")
def scl11(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", scalar.utm_zone(-(60 + F.col("c_custkey") % 60)).alias("zone"))


@query("scl13_region_code", "SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN '03' WHEN 1 THEN '10' ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS region FROM customer")
def scl13(spark, sf):
    label = F.when(F.col("c_nationkey") % 3 == 0, "3N").when(F.col("c_nationkey") % 3 == 1, "10U").otherwise(F.col("c_nationkey").cast("string"))
    return table(spark, sf, "customer").select("c_custkey", scalar.region_code(label).alias("region"))
