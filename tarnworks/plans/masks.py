"""Queries of waterbody masks, touched cells and threshold lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnworks.core.io import table
from tarnworks.operators import masks
from tarnworks.plans.base import model, query
from tarnworks.plans.tables import RASTER, SHAPE, _edges
from tarnworks.plans.zonal import r


@query("grd07_touched", RASTER + """, t AS (SELECT zone_id, CAST(rr AS INTEGER) AS row, CAST(cc AS INTEGER) AS col FROM sh, LATERAL (SELECT unnest(range(CAST(floor(y0) AS BIGINT), CAST(floor(y1) AS BIGINT) + 1)) AS rr), LATERAL (SELECT unnest(range(CAST(floor(x0) AS BIGINT), CAST(floor(x1) AS BIGINT) + 1)) AS cc)
 WHERE (rr = floor(y0)) OR (cc = floor(x0)) OR (cc = floor(x1) AND rr <= floor(ym)) OR (rr = floor(ym) AND cc >= floor(xm)) OR (cc = floor(xm) AND rr >= floor(ym)) OR (rr = floor(y1) AND cc <= floor(xm)))
 SELECT * FROM c UNION SELECT * FROM t""")
def grd07(spark, sf):
    return masks.rasterise_touched(_edges(spark, sf))


@query("grd09_region_codes", "SELECT row, col, CASE cell % 3 WHEN 0 THEN 3 WHEN 1 THEN 10 ELSE 17 END AS code FROM grid", ("grid",))
def grd09(spark, sf):
    g = model(spark, sf, "grid").withColumn("vpu", F.element_at(F.array(*[F.lit(x) for x in ("03S", "10L", "17")]), (F.col("cell") % 3 + 1).cast("int")))
    return masks.region_codes(g, "vpu")


WB = RASTER + ", land AS (SELECT row, col FROM c WHERE (row + col) % 5 > 0), w AS (SELECT s_suppkey AS zone_id, s_nationkey AS comid, s_nationkey + 7 AS member FROM supplier) "


@query("grd16_waterbody_masks", WB + """SELECT DISTINCT row, col, 'waterbody' AS kind FROM c WHERE (row + col) % 5 > 0 UNION ALL SELECT DISTINCT row, col, 'connected' FROM c WHERE (row + col) % 5 > 0 AND zone_id IN (SELECT zone_id FROM w WHERE comid < 9 OR member < 9)
 UNION ALL SELECT DISTINCT row, col, 'endorheic' FROM c WHERE (row + col) % 5 > 0 AND zone_id IN (SELECT zone_id FROM w WHERE comid % 4 = 1 AND comid < 25 OR member % 4 = 1 AND member < 25)""")
def grd16(spark, sf):
    from tarnworks.operators.vector import rasterise

    e = _edges(spark, sf)
    w = table(spark, sf, "supplier").selectExpr("s_suppkey AS zone_id", "CAST(s_nationkey AS BIGINT) AS comid", "CAST(s_nationkey + 7 AS BIGINT) AS member_comid")
    land = rasterise(e).where("(row + col) % 5 > 0").select("row", "col").distinct()
    keys = table(spark, sf, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS comid")
    return masks.waterbody_masks(w, e, keys.where("comid < 9"), keys.where("comid % 4 = 1"), land)


@query("set05_appended_sinks", "SELECT c_custkey AS comid, c_nationkey AS n FROM customer UNION ALL SELECT -1 - s_suppkey, NULL FROM supplier")
def set05(spark, sf):
    w = table(spark, sf, "customer").selectExpr("c_custkey AS comid", "c_nationkey AS n")
    s = table(spark, sf, "supplier").selectExpr("-1 - s_suppkey AS comid")
    return masks.append_sinks(w, s, w.selectExpr("comid AS seed", "comid AS key"))


@query("grd02_grid_mismatches", "SELECT n_nationkey AS grid_id, 'width' AS field FROM nation WHERE n_regionkey % 3 <> 0 UNION ALL SELECT n_nationkey, 'a' FROM nation WHERE n_nationkey % 5 <> 0")
def grd02(spark, sf):
    g = table(spark, sf, "nation").selectExpr("n_nationkey AS grid_id", "'5070' AS crs", "n_regionkey % 3 AS width", "1 AS height", "n_nationkey % 5 AS a", "0 AS b", "0 AS c", "0 AS d", "0 AS e", "0 AS f")
    return masks.grid_mismatches(g, 0)


@query("agg22_threshold_value", """+ b AS (SELECT zone_id, class AS bin, count(*) AS n FROM cells GROUP BY zone_id, class), z AS (SELECT zone_id, count(*) FILTER (flag = 'R') AS onstream, count(*) AS n_perv FROM cells GROUP BY zone_id)
 SELECT z.zone_id, least(greatest((onstream + coalesce((SELECT sum(n) FROM b WHERE b.zone_id = z.zone_id AND b.bin + 0.5 > 5.0), 0)) / n_perv, 0), 1) AS value FROM z""", ("cells",))
def agg22(spark, sf):
    c = model(spark, sf, "cells")
    bins = c.groupBy("zone_id", F.col("class").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    totals = c.groupBy("zone_id").agg(F.count_if(F.col("flag") == "R").alias("onstream"), F.count(F.lit(1)).alias("n_perv"))
    return masks.threshold_value(bins, totals, 5.0, 0.0, 1.0)


@query("agg24_reference_lookup", """WITH k AS (SELECT n_nationkey * 4 AS pct, n_nationkey * n_nationkey AS v FROM nation), p AS (SELECT p_partkey, p_size * 13.0 AS s FROM part)
 SELECT p_partkey, round(CASE WHEN s >= (SELECT max(v) FROM k) THEN (SELECT max(pct) FROM k) ELSE a.pct + (b.pct - a.pct) * (s - a.v) / (b.v - a.v) END, 6) AS looked_up FROM p
 LEFT JOIN LATERAL (SELECT max(v) AS v, arg_max(pct, v) AS pct FROM k WHERE v <= s) a ON true LEFT JOIN LATERAL (SELECT min(v) AS v, arg_min(pct, v) AS pct FROM k WHERE v > s) b ON true""")
def agg24(spark, sf):
    ref = table(spark, sf, "nation").selectExpr("n_nationkey * 4 AS pct", "n_nationkey * n_nationkey AS value")
    p = table(spark, sf, "part").selectExpr("p_partkey", "p_size * 13.0D AS s")
    return r(masks.reference_lookup(p, ref, "s").select("p_partkey", "looked_up"), 6)


@query("jon11_polygon_subtraction", "SELECT comid FROM keys WHERE ftype <> 'FURNITURE' AND (comid % 3 <> 0 OR ftype = 'MACHINERY')", ("keys",))
def jon11(spark, sf):
    k = model(spark, sf, "keys").where("ftype <> 'FURNITURE'")
    onstream = k.where("comid % 3 = 0 AND ftype <> 'MACHINERY'").select("comid")
    return k.select("comid").join(onstream, "comid", "left_anti")
