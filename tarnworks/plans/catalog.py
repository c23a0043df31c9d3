"""Queries of declared columns, guards, catalogs, lines and polygon overlaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnworks.core.io import table
from tarnworks.functions import scalar
from tarnworks.operators import catalog as c
from tarnworks.operators import lines, vector, zonal
from tarnworks.plans.base import model, query
from tarnworks.plans.tables import SHAPE, _edges
from tarnworks.plans.zonal import SERIES_SQL, _parts, _series, r

K = ("keys",)


@query("prj01_derived_columns", "SELECT p_partkey, p_size, round(tan(radians(p_size)), 8) AS slope, round(p_retailprice / 25.4, 6) AS inches FROM part")
def prj01(spark, sf):
    d = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    d = c.derived_columns(d, {"slope": ("p_size", "deg_to_fraction"), "inches": ("p_retailprice", "inches_from_mm")}).drop("p_retailprice")
    return r(r(d, 8, "slope"), 6, "inches")


@query("prj04_units", "SELECT p_partkey, p_retailprice / 100 AS m, round(p_size * 39.3701, 6) AS inches FROM part")
def prj04(spark, sf):
    return r(table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") / 100).alias("m"), (F.col("p_size") * scalar.INCHES_PER_M).alias("inches")), 6, "inches")


@query("prj05_categories", "SELECT comid, ftype FROM keys WHERE ftype IN ('BUILDING', 'MACHINERY')", K)
def prj05(spark, sf):
    return c.in_categories(model(spark, sf, "keys").select("comid", "ftype"), "ftype", ["BUILDING", "MACHINERY"])


@query("prj06_sink_rows", """WITH d AS (SELECT -1 - p_partkey AS poly_id, CASE p_size % 6 WHEN 0 THEN '4' WHEN 1 THEN '5.0' WHEN 2 THEN ' 8 ' WHEN 3 THEN 'nt' WHEN 4 THEN '' END AS p, CASE p_size % 4 WHEN 0 THEN 36100 WHEN 1 THEN 39004 WHEN 2 THEN 46600 ELSE 43600 END AS f FROM part)
 SELECT poly_id AS comid, CASE f WHEN 36100 THEN 'Playa' WHEN 39004 THEN 'LakePond' WHEN 46600 THEN 'SwampMarsh' ELSE 'Reservoir' END AS ftype, poly_id AS member_comid FROM d WHERE trim(p) IN ('4', '5.0', '8')""")
def prj06(spark, sf):
    d = table(spark, sf, "part").selectExpr("-1 - p_partkey AS poly_id", "CASE p_size % 6 WHEN 0 THEN '4' WHEN 1 THEN '5.0' WHEN 2 THEN ' 8 ' WHEN 3 THEN 'nt' WHEN 4 THEN '' END AS purp_code", "CASE p_size % 4 WHEN 0 THEN 36100 WHEN 1 THEN 39004 WHEN 2 THEN 46600 ELSE 43600 END AS f_code")
    return c.sink_rows(d)


@query("prj07_large_enough", "SELECT comid FROM keys WHERE ftype <> 'BUILDING' AND area >= 900", K)
def prj07(spark, sf):
    return c.large_enough(model(spark, sf, "keys"), "ftype", ["BUILDING"], "area").select("comid")


@query("prj08_region_filter", "SELECT c_custkey FROM customer WHERE c_nationkey % 4 IN (0, 1)")
def prj08(spark, sf):
    d = table(spark, sf, "customer").withColumn("vpu", F.element_at(F.array(*[F.lit(x) for x in ("03N", "3W", "10U", "17")]), F.col("c_nationkey") % 4 + 1))
    return c.in_region(d, "vpu", "03").select("c_custkey")


@query("prj14_overlap_guard", "SELECT c_custkey AS x, c_nationkey AS y FROM customer")
def prj14(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_custkey AS x", "c_nationkey AS y")
    c.require_overlap(a, table(spark, sf, "supplier").selectExpr("s_suppkey AS x", "s_nationkey AS y"))
    return a


@query("agg21_histogram_quantiles", """+ b AS (SELECT class AS bin, count(*) AS n FROM cells GROUP BY class), u AS (SELECT *, sum(n) OVER (ORDER BY bin) AS upto, sum(n) OVER () AS total FROM b), q AS (SELECT unnest([5.0, 50.0, 97.5]) AS pct),
 f AS (SELECT q.pct, arg_min(bin, bin) AS bin, arg_min(n, bin) AS n, arg_min(upto, bin) AS upto, max(total) AS total FROM q JOIN u ON q.pct / 100 * total <= upto GROUP BY q.pct)
 SELECT CAST(pct AS DOUBLE) AS pct, round(10 + (bin + (pct / 100 * total - (upto - n)) / n) * 2, 6) AS value FROM f""", ("cells",))
def agg21(spark, sf):
    b = model(spark, sf, "cells").groupBy(F.col("class").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return r(c.histogram_quantiles(b, 10.0, 2.0, [5, 50, 97.5]), 6)


@query("agg26_distribution", "SELECT count(*) AS n, round(avg(area), 4) AS mean, round(stddev_pop(area), 4) AS std, round(quantile_cont(area, 0.02), 4) AS p2, round(quantile_cont(area, 0.25), 4) AS p25, round(quantile_cont(area, 0.5), 4) AS p50, round(quantile_cont(area, 0.75), 4) AS p75, round(quantile_cont(area, 0.98), 4) AS p98 FROM keys", K)
def agg26(spark, sf):
    return r(c.distribution(model(spark, sf, "keys"), "area"))


@query("agg28_signal_counts", "SELECT count(*) FILTER (wet OR paved) AS total, count(*) FILTER (wet) AS wet, count(*) FILTER (paved) AS paved FROM grid", ("grid",))
def agg28(spark, sf):
    return c.signal_counts(model(spark, sf, "grid"), ["wet", "paved"], {"wet": 1, "paved": 1})


@query("agg33_achieved_shares", """WITH d AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN '1m' ELSE '10m' END AS t, CASE WHEN c_custkey % 10 = 0 THEN '1m' ELSE '10m' END AS a FROM customer), k AS (SELECT unnest(['1m', '10m']) AS resolution),
 s AS (SELECT resolution, 100 * avg(CASE WHEN t = resolution THEN 1.0 ELSE 0 END) AS tagged_pct, 100 * avg(CASE WHEN a = resolution THEN 1.0 ELSE 0 END) AS achieved_pct FROM k, d GROUP BY resolution) SELECT *, abs(tagged_pct - achieved_pct) > 20 AS off FROM s""")
def agg33(spark, sf):
    d = table(spark, sf, "customer").selectExpr("CASE WHEN c_custkey % 2 = 0 THEN '1m' ELSE '10m' END AS t", "CASE WHEN c_custkey % 10 = 0 THEN '1m' ELSE '10m' END AS a")
    return c.achieved_shares(d, "t", "a")


@query("agg44_shortfall", "SELECT count(*) AS n_expected, count(*) FILTER (o_custkey % 5 = 0) AS n_missing, 'warning' AS verdict FROM orders")
def agg44(spark, sf):
    o = table(spark, sf, "orders")
    return c.shortfall(o, o.where("o_custkey % 5 <> 0"), "o_orderkey")


def _catalog(spark, sf):
    p = table(spark, sf, "part")
    col = F.struct(F.col("p_type").alias("col"), F.concat(F.lit("prm_"), F.col("p_type")).alias("prms"), F.array_repeat(F.lit("flow"), (F.col("p_size") % 3).cast("int")).alias("processes"))
    g = p.groupBy(F.col("p_brand").alias("name")).agg(F.sort_array(F.collect_set(col)).alias("columns"), F.min("p_size").alias("k"))
    return g.withColumn("defects", F.when(F.col("k") % 2 == 0, F.array(F.lit("SMALL"))).otherwise(F.array().cast("array<string>"))).withColumn("builder", F.concat(F.lit("b"), (F.col("k") % 3).cast("string")))


CATALOG = """WITH p AS (SELECT DISTINCT p_brand AS name, p_type AS col, p_size % 3 AS np FROM part), k AS (SELECT p_brand AS name, min(p_size) AS k FROM part GROUP BY p_brand) """


@query("agg46_process_columns", CATALOG + "SELECT string_agg(col, ' or ' ORDER BY name, np) AS \"column\", 'prm_' || col AS param FROM p JOIN k USING (name) WHERE np > 0 AND NOT (k % 2 = 0 AND col = 'SMALL') GROUP BY col")
def agg46(spark, sf):
    return c.process_columns(_catalog(spark, sf), "flow")


@query("agg46_unused_columns", CATALOG + "SELECT name, col AS \"column\" FROM p WHERE np = 0")
def agg46u(spark, sf):
    return c.unused_columns(_catalog(spark, sf))


@query("agg45_catalog_rows", CATALOG + "SELECT name, col, 'prm_' || col AS prms FROM p")
def agg45(spark, sf):
    return _catalog(spark, sf).select("name", F.explode("columns").alias("c")).select("name", "c.col", "c.prms")


@query("agg54_entries_by_builder", CATALOG + "SELECT 'b' || (k % 3) AS builder, string_agg(name, ',' ORDER BY name) AS entries, count(*) AS n FROM k GROUP BY k % 3")
def agg54(spark, sf):
    return c.entries_by_builder(_catalog(spark, sf))


@query("agg53_unexpected_categories", "SELECT ftype, count(*) AS n FROM keys WHERE ftype NOT IN ('BUILDING', 'MACHINERY') GROUP BY ftype", K)
def agg53(spark, sf):
    return c.unexpected_categories(model(spark, sf, "keys"), "ftype", ["BUILDING", "MACHINERY"])


@query("zon24_layer_audit", """+ a AS (SELECT * FROM keys WHERE nation < 15), b AS (SELECT comid, area * 0.9 AS area FROM keys WHERE nation > 5), j AS (SELECT a.area AS x, b.area AS y FROM a FULL JOIN b USING (comid))
 SELECT (SELECT count(*) FROM a) AS n_rows, (SELECT count(*) FROM a) AS n_keys, (SELECT round(sum(area), 2) FROM a) AS area, 0 AS n_duplicates, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS n_shared, count(*) FILTER (y IS NULL) AS n_only_a, count(*) FILTER (x IS NULL) AS n_only_b,
 round(max(abs(x - y)), 4) AS max_gap, round(avg(abs(x - y)), 4) AS mean_gap FROM j""", K)
def zon24(spark, sf):
    k = model(spark, sf, "keys")
    d = c.layer_audit(k.where("nation < 15"), k.where("nation > 5").withColumn("area", F.col("area") * 0.9), "comid", "area")
    return r(r(d, 4, "max_gap", "mean_gap"), 2, "area")


def _faulty_edges(spark, sf):
    """Rings of which some lack their last edge and some take two corners in the wrong order."""
    s = spark.sql(SHAPE.replace("FROM supplier", "FROM {su}"), su=table(spark, sf, "supplier"))
    ring = ["x0", "y0"], ["x1", "y0"], ["x1", "ym"], ["xm", "ym"], ["xm", "y1"], ["x0", "y1"]
    turned = [ring[i] for i in (0, 3, 2, 1, 4, 5)]
    edges = lambda k: F.array(*[F.struct(*[F.col(c).cast("double").alias(n) for c, n in zip((*a, *b), ("x1", "y1", "x2", "y2"))]) for a, b in zip(k, (*k[1:], k[0]))])
    e = F.when(F.col("zone_id") % 5 == 1, edges(turned)).otherwise(edges(ring))
    e = F.when(F.col("zone_id") % 7 == 0, F.slice(e, 1, 5)).otherwise(e)
    return s.select("zone_id", F.explode(e).alias("e")).select("zone_id", "e.*")


@query("agg50_ring_screening", f"WITH sh AS ({SHAPE}) SELECT zone_id, CASE WHEN zone_id % 7 = 0 THEN 5 ELSE 6 END AS n_edges, zone_id % 7 = 0 AS unclosed, CASE WHEN zone_id % 5 = 1 THEN 1 ELSE 0 END AS n_crossings FROM sh")
def agg50(spark, sf):
    return c.ring_screening(_faulty_edges(spark, sf), size=3.0).drop("area")


@query("agg50_geometry_counts", """SELECT CASE WHEN s_nationkey % 6 = 5 THEN NULL WHEN s_nationkey % 6 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind, count(*) AS n_rows, count(*) FILTER (s_suppkey % 13 = 0) AS n_empty, count(*) FILTER (s_suppkey % 13 = 1) AS n_zero_area,
 count(*) FILTER (s_suppkey % 7 = 0 AND s_suppkey % 13 > 1) AS n_unclosed, count(*) FILTER (s_suppkey % 5 = 1 AND s_suppkey % 13 > 1) AS n_crossing FROM supplier GROUP BY 1""")
def agg50c(spark, sf):
    layer = table(spark, sf, "supplier").selectExpr("s_suppkey AS zone_id", "CASE WHEN s_nationkey % 6 = 5 THEN NULL WHEN s_nationkey % 6 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind")
    e = _faulty_edges(spark, sf).where("zone_id % 13 > 0")
    there, back = ("named_struct('x1', %s, 'y1', 0.5D, 'x2', %s, 'y2', 0.5D)" % x for x in (("0.5D", "3.5D"), ("3.5D", "0.5D")))
    flat = layer.where("zone_id % 13 = 1").selectExpr("zone_id", f"inline(array({there}, {back}))")
    return c.geometry_counts(layer, e.where("zone_id % 13 > 1").unionByName(flat), size=3.0)


@query("udf01_source_hook", SERIES_SQL + "SELECT zone_id, date, round(sum(w * swe * 2) / sum(w) FILTER (swe IS NOT NULL), 9) AS swe FROM j GROUP BY zone_id, date")
def udf01(spark, sf):
    w, g = _series(spark, sf)
    return r(c.Source(["swe"], hook=lambda d: d.withColumn("swe", F.col("swe") * 2)).aggregate(w, g, _parts(spark, sf)), 9)


DECLARED = """SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'p_cost' ELSE 'p_size' END AS source,
 CASE p_partkey % 6 WHEN 0 THEN 'deg_to_fraction' WHEN 1 THEN 'inches_from_mm' WHEN 2 THEN 'inches_from_m' WHEN 3 THEN 'copy' WHEN 4 THEN 'eval' END AS transform FROM part"""


@query("udf02_declared_transforms", f"""SELECT *, CASE WHEN transform IS NULL OR transform NOT IN ('deg_to_fraction', 'inches_from_mm', 'inches_from_m', 'copy') THEN 'unknown transform'
 WHEN source NOT IN ('p_size', 'p_retailprice') THEN 'missing source' ELSE 'ok' END AS status FROM ({DECLARED})""")
def udf02(spark, sf):
    declared = spark.sql(DECLARED.replace("FROM part", "FROM {p}"), p=table(spark, sf, "part"))
    return c.declared_status(declared, ["p_size", "p_retailprice"])


@query("udf03_runner_registry", "SELECT zone_id, arg_max(lu_code, (n, -lu_code)) AS dominant FROM hist GROUP BY zone_id", ("hist",))
def udf03(spark, sf):
    return c.RUNNERS["soils"](cells=model(spark, sf, "cells"))


LINES = "SELECT c_custkey AS line_id, (c_custkey * 17 % 700) / 10.0 + 0.013 AS a, (c_custkey * 17 % 700) / 10.0 + 0.013 + 3 + c_custkey % 15 AS b, (c_custkey * 29 % 8000) / 100.0 + 0.0037 AS y FROM customer"
OVER = f"""WITH sh AS ({SHAPE}), l AS ({LINES}), o AS (SELECT line_id, zone_id, a, b, x0, CASE WHEN y < ym THEN x1 ELSE xm END AS xe FROM l JOIN sh ON y >= y0 AND y < y1), v AS (SELECT *, least(b, xe) - greatest(a, x0) AS overlap FROM o) """


def _lines(spark, sf):
    l = spark.sql(LINES.replace("FROM customer", "FROM {cu}"), cu=table(spark, sf, "customer")).selectExpr("line_id", "CAST(a AS DOUBLE) AS a", "CAST(b AS DOUBLE) AS b", "CAST(y AS DOUBLE) AS y")
    mid = (F.col("a") + F.col("b")) / 2
    return l.select("line_id", F.posexplode(F.array(F.struct(F.col("a").alias("p"), mid.alias("q")), F.struct(mid.alias("p"), F.col("b").alias("q")))).alias("seq", "e"), "y").selectExpr("line_id", "seq", "e.p AS x1", "y AS y1", "e.q AS x2", "y AS y2")


@query("jon07_overlap_lengths", OVER + "SELECT line_id, zone_id, round(overlap, 6) AS overlap FROM v WHERE overlap > 1e-6")
def jon07(spark, sf):
    return r(lines.overlap_lengths(_lines(spark, sf), _edges(spark, sf), size=3.0), 6)


@query("jon08_flow_through", OVER + "SELECT DISTINCT zone_id FROM v WHERE overlap > 0 AND a < x0 AND b > xe")
def jon08(spark, sf):
    return lines.flow_through(_lines(spark, sf), _edges(spark, sf), size=3.0)


OTHER = SHAPE.replace("+ 0.3", "+ 2.11").replace("+ 5.3", "+ 4.37").replace("* 9 + 4.75", "* 9 + 6.91").replace("AS zone_id", "+ 1000 AS zone_id")


def _other(spark, sf):
    s = spark.sql(OTHER.replace("FROM supplier", "FROM {su}"), su=table(spark, sf, "supplier"))
    ring = ["x0", "y0"], ["x1", "y0"], ["x1", "y1"], ["x0", "y1"]
    e = F.array(*[F.struct(*[F.col(k).cast("double").alias(n) for k, n in zip((*a, *b), ("x1", "y1", "x2", "y2"))]) for a, b in zip(ring, (*ring[1:], ring[0]))])
    return s.where("zone_id % 3 > 0").select("zone_id", F.explode(e).alias("e")).select("zone_id", "e.*")


PAIRS = f"""WITH a AS ({SHAPE}), b AS (SELECT * FROM ({OTHER}) WHERE zone_id % 3 > 0), p AS (SELECT a.zone_id, b.zone_id AS source,
 greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) - greatest(0, least(a.x1, b.x1) - greatest(a.xm, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.ym, b.y0)) AS area FROM a, b) """


@query("jon17_overlap_areas", PAIRS + "SELECT zone_id, source, round(area, 6) AS area FROM p WHERE area > 1e-9")
def jon17(spark, sf):
    return r(lines.overlap_areas(_edges(spark, sf), _other(spark, sf), size=5.0), 6)


@query("jon06_intersecting", PAIRS + "SELECT DISTINCT zone_id FROM p WHERE area > 1e-9")
def jon06(spark, sf):
    return lines.intersecting(_edges(spark, sf), _other(spark, sf), size=5.0)


@query("jon18_grid_weights", f"""WITH sh AS ({SHAPE}), k AS (SELECT sh.*, rr AS row, cc AS col FROM sh, LATERAL (SELECT unnest(range(CAST(floor(y0) AS BIGINT), CAST(ceil(y1) AS BIGINT))) AS rr), LATERAL (SELECT unnest(range(CAST(floor(x0) AS BIGINT), CAST(ceil(x1) AS BIGINT))) AS cc)),
 a AS (SELECT zone_id, greatest(0, least(x1, col + 1) - greatest(x0, col)) * greatest(0, least(y1, row + 1) - greatest(y0, row)) - greatest(0, least(x1, col + 1) - greatest(xm, col)) * greatest(0, least(y1, row + 1) - greatest(ym, row)) AS w FROM k)
 SELECT zone_id, count(*) AS n_cells FROM a WHERE w > 1e-9 GROUP BY zone_id""")
def jon18(spark, sf):
    return zonal.cells_per_zone(vector.coverage(_edges(spark, sf)).where("w > 1e-9"))


KINDS = "SELECT s_suppkey AS zone_id, CASE WHEN s_nationkey % 6 = 0 THEN 'Playa' WHEN s_nationkey % 6 = 1 THEN 'Ice Mass' ELSE 'LakePond' END AS ftype FROM supplier"


@query("jon08_flowing_polygons", f"""{OVER}, c AS (SELECT * FROM ({OTHER}) WHERE zone_id % 3 > 0), x AS (SELECT zone_id FROM v WHERE overlap > 0 AND a < x0 AND b > xe UNION SELECT zone_id FROM l JOIN sh ON y >= y0 AND y < y1 AND l.a >= x0 AND l.a < CASE WHEN y < ym THEN x1 ELSE xm END WHERE line_id % 3 > 0
 UNION SELECT sh.zone_id FROM sh, c WHERE least(sh.x1, c.x1) > greatest(sh.x0, c.x0) AND least(sh.y1, c.y1) > greatest(sh.y0, c.y0) AND NOT (c.x0 >= sh.xm AND c.y0 >= sh.ym)) SELECT x.zone_id FROM x JOIN ({KINDS}) k USING (zone_id) JOIN (SELECT DISTINCT l_suppkey AS zone_id FROM lineitem) n USING (zone_id) WHERE ftype = 'LakePond'""")
def jon08f(spark, sf):
    kinds = spark.sql(KINDS.replace("FROM supplier", "FROM {su}"), su=table(spark, sf, "supplier"))
    l = _lines(spark, sf)
    network = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("zone_id"))
    return lines.flowing_polygons(l, _edges(spark, sf), kinds, _other(spark, sf), l.where("line_id % 3 > 0").select("line_id"), network, size=5.0)
