"""Queries of polygon depths."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnworks.core.io import table
from tarnworks.operators import depth
from tarnworks.plans.base import model, query
from tarnworks.plans.zonal import r

WINDOW = "SELECT CAST(floor(row / 16) * 4 + floor(col / 16) AS BIGINT) AS comid, row % 16 AS row, col % 16 AS col, value / 1000 AS value, row % 16 BETWEEN 4 AND 11 AND col % 16 BETWEEN 4 AND 11 AS inside FROM grid"


def _cells(spark, sf):
    return spark.sql(WINDOW.replace("FROM grid", "FROM {grid}"), grid=model(spark, sf, "grid"))


@query("dep06_depth_records")
def dep06(spark, sf):
    return r(depth.depth_records(_cells(spark, sf), 10.0), 6)


# The ring of two cells round the shore, its slopes, and the largest distance to the shore, cell by cell.
SHORE = f"""+ w AS ({WINDOW}), b AS (SELECT comid, min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1 FROM w GROUP BY comid), i AS (SELECT comid, row, col FROM w WHERE inside),
 pad AS (SELECT comid, y AS row, x AS col FROM b, LATERAL (SELECT unnest(range(r0 - 1, r1 + 2)) AS y), LATERAL (SELECT unnest(range(c0 - 1, c1 + 2)) AS x)), o AS (SELECT * FROM pad ANTI JOIN i USING (comid, row, col)),
 near AS (SELECT i.comid, i.row, i.col, min((i.row - o.row) * (i.row - o.row) + (i.col - o.col) * (i.col - o.col)) AS square FROM i JOIN o ON i.comid = o.comid GROUP BY i.comid, i.row, i.col), far AS (SELECT comid, sqrt(max(square)) AS distance FROM near GROUP BY comid),
 ring AS (SELECT DISTINCT o.comid, o.row, o.col, r0, r1, c0, c1 FROM o JOIN b ON b.comid = o.comid AND o.row BETWEEN r0 AND r1 AND o.col BETWEEN c0 AND c1 AND r1 > r0 AND c1 > c0 JOIN i ON i.comid = o.comid AND abs(i.row - o.row) <= 2 AND abs(i.col - o.col) <= 2),
 g AS (SELECT q.comid, CASE WHEN q.row = r0 THEN d.value - h.value WHEN q.row = r1 THEN h.value - u.value ELSE (d.value - u.value) / 2 END / 10 AS gy, CASE WHEN q.col = c0 THEN e.value - h.value WHEN q.col = c1 THEN h.value - l.value ELSE (e.value - l.value) / 2 END / 10 AS gx
  FROM ring q LEFT JOIN w h ON h.comid = q.comid AND h.row = q.row AND h.col = q.col LEFT JOIN w u ON u.comid = q.comid AND u.row = q.row - 1 AND u.col = q.col LEFT JOIN w d ON d.comid = q.comid AND d.row = q.row + 1 AND d.col = q.col
  LEFT JOIN w l ON l.comid = q.comid AND l.row = q.row AND l.col = q.col - 1 LEFT JOIN w e ON e.comid = q.comid AND e.row = q.row AND e.col = q.col + 1), s AS (SELECT comid, avg(sqrt(gx * gx + gy * gy)) AS slope FROM g GROUP BY comid)
 SELECT comid, round(coalesce(slope * distance * 10, 0), 6) AS hollister_max_m FROM b LEFT JOIN far USING (comid) LEFT JOIN s USING (comid)"""


@query("dep03_shore_slope", SHORE, ("grid",))
def dep03(spark, sf):
    return r(depth.shore_estimates(_cells(spark, sf), 10.0), 6)


@query("dep07_batch_status", f"""+ w AS ({WINDOW}), s AS (SELECT comid, bool_or(inside) AS valid FROM w GROUP BY comid), c AS (SELECT count(*) AS n, count(*) FILTER (valid IS NULL) AS u, count(*) FILTER (NOT valid) AS f FROM (SELECT DISTINCT c_custkey AS comid FROM customer) LEFT JOIN s USING (comid))
 SELECT n AS n_polygons, u AS n_unread, f AS n_failed, round((n - u - f) / n, 6) AS share, (n - u - f) / n < 0.9 AS warned FROM c""", ("grid",))
def dep07(spark, sf):
    return r(depth.batch_status(table(spark, sf, "customer").select(F.col("c_custkey").alias("comid")), _cells(spark, sf)), 6, "share")


# Windows at two resolutions, values as text; some polygons have broken windows.
JOB_WINDOWS = f"""SELECT comid, CASE WHEN comid % 3 = 0 THEN '1m' ELSE '10m' END AS resolution, CASE WHEN comid % 11 = 4 AND col = 3 THEN NULL ELSE row END AS row, col,
 CASE WHEN comid % 5 = 2 AND row = 7 AND col = 7 THEN 'n/a' WHEN comid % 13 = 1 THEN '7.5' ELSE CAST(value AS STRING) END AS value, inside FROM ({WINDOW}) UNION ALL SELECT comid, '10m', row, col, '1.0', inside FROM ({WINDOW}) WHERE comid % 7 = 1 AND row = 5"""
JOB = "SELECT c_custkey AS comid, CASE WHEN c_custkey % 2 = 0 THEN '1m' ELSE '10m' END AS resolution FROM customer"
JOB_SQL = f"""+ p AS ({JOB}), w AS ({JOB_WINDOWS}), h AS (SELECT comid, bool_or(resolution = '1m') AS h1, bool_or(resolution = '10m') AS h10 FROM w GROUP BY comid),
 c AS (SELECT comid, CASE WHEN p.resolution = '1m' AND h1 THEN '1m' WHEN h10 THEN '10m' END AS resolution FROM p LEFT JOIN h USING (comid)),
 s AS (SELECT comid, row, col, count(*) > 1 AS twice, bool_or(value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL) AS bad FROM w JOIN c USING (comid, resolution) GROUP BY comid, row, col),
 b AS (SELECT comid, CASE WHEN bool_or(row IS NULL OR col IS NULL) THEN 'a cell without a place' WHEN bool_or(twice) THEN 'a cell twice' WHEN bool_or(bad) THEN 'a value that is no number' END AS broken FROM s GROUP BY comid),
 v AS (SELECT comid, count(*) AS n, max(CAST(value AS DOUBLE)) - min(CAST(value AS DOUBLE)) AS range FROM w JOIN c USING (comid, resolution) JOIN b USING (comid) WHERE broken IS NULL AND inside AND value IS NOT NULL GROUP BY comid),
 j AS (SELECT comid, CASE WHEN resolution IS NULL THEN 'read_failure' WHEN broken IS NULL THEN 'done' ELSE 'compute_error' END AS status, CASE WHEN resolution IS NULL THEN 'no window' ELSE broken END AS fault, resolution, n, range FROM c LEFT JOIN b USING (comid) LEFT JOIN v USING (comid))"""


def _job(spark, sf):
    cells = spark.sql(JOB_WINDOWS.replace("FROM grid", "FROM {grid}"), grid=model(spark, sf, "grid"))
    return depth.depth_job(spark.sql(JOB.replace("FROM customer", "FROM {c}"), c=table(spark, sf, "customer")), cells)


@query("dep07_depth_job", JOB_SQL + """ SELECT comid, status, fault, resolution, CASE WHEN status = 'done' THEN coalesce(n, 0) END AS n_inside, CASE WHEN status = 'done' THEN coalesce(range, 0) < 0.01 END AS flat FROM j""", ("grid",))
def dep07_job(spark, sf):
    return _job(spark, sf).select("comid", "status", "fault", "resolution", "n_inside", "flat")


@query("dep07_job_summary", JOB_SQL + """ SELECT count(*) AS n_polygons, count(*) FILTER (status = 'read_failure') AS n_read_failure, count(*) FILTER (status = 'compute_error') AS n_compute_error, count(*) FILTER (resolution = '1m') AS n_fine,
 round(avg(CASE WHEN status = 'done' THEN 1.0 ELSE 0 END), 6) AS share, avg(CASE WHEN status = 'done' THEN 1.0 ELSE 0 END) < 0.9 AS warned FROM j""", ("grid",))
def dep07_summary(spark, sf):
    return r(depth.job_summary(_job(spark, sf)), 6, "share")


@query("dep05_interior_cells", f"+ w AS ({WINDOW}) SELECT comid, count(*) AS n FROM w WHERE inside GROUP BY comid", ("grid",))
def dep05(spark, sf):
    return _cells(spark, sf).where("inside").groupBy("comid").agg(F.count(F.lit(1)).alias("n"))


BOX = "SELECT p_partkey AS comid, p_size * 300.0 AS width, p_retailprice * 10 AS height, CASE WHEN p_partkey % 2 = 0 THEN '1m' ELSE '10m' END AS resolution FROM part"


@query("dep08_oversized", f"WITH b AS ({BOX}) SELECT comid, resolution = '1m' AND (width + 400) * (height + 400) > 1.5e8 AS downgraded, CASE WHEN resolution = '1m' AND NOT (width + 400) * (height + 400) > 1.5e8 THEN '1m' ELSE '10m' END AS resolution FROM b")
def dep08(spark, sf):
    b = spark.sql(BOX.replace("FROM part", "FROM {p}"), p=table(spark, sf, "part"))
    return depth.oversized(b, limit=1.5e8).select("comid", "downgraded", "resolution")


@query("dep09_window_cost", f"WITH b AS ({BOX}) SELECT comid, CAST(ceil((width + 400) / CASE resolution WHEN '1m' THEN 1.0 ELSE 10 END) * ceil((height + 400) / CASE resolution WHEN '1m' THEN 1.0 ELSE 10 END) + 50000 AS DOUBLE) AS cost FROM b")
def dep09(spark, sf):
    b = spark.sql(BOX.replace("FROM part", "FROM {p}"), p=table(spark, sf, "part"))
    return depth.window_cost(b).select("comid", F.col("cost").cast("double").alias("cost"))


@query("dep12_tagged_polygons", f"""WITH b AS ({BOX}), g AS (SELECT l_partkey AS comid, min(l_returnflag) AS ecoregion FROM lineitem WHERE l_partkey % 5 > 0 GROUP BY l_partkey), f AS (SELECT l_partkey AS comid, bool_or(l_linenumber = 7) AS fine FROM lineitem GROUP BY l_partkey)
 SELECT comid, coalesce(ecoregion, 'unassigned') AS ecoregion, CASE WHEN fine AND NOT (width + 400) * (height + 400) > 2e8 THEN '1m' ELSE '10m' END AS resolution FROM b LEFT JOIN g USING (comid) LEFT JOIN f USING (comid)""")
def dep12(spark, sf):
    b = spark.sql(BOX.replace("FROM part", "FROM {p}"), p=table(spark, sf, "part")).drop("resolution")
    li = table(spark, sf, "lineitem")
    g = li.where("l_partkey % 5 > 0").selectExpr("l_partkey AS comid", "l_returnflag AS ecoregion")
    f = li.selectExpr("l_partkey AS comid", "CASE WHEN l_linenumber = 7 THEN '1m' ELSE '10m' END AS resolution")
    return depth.tagged_polygons(b, g, f).select("comid", "ecoregion", "resolution")


@query("dep04_max_to_mean", "SELECT comid, hollister_max_m / 3.0 AS mean FROM (SELECT p_partkey AS comid, p_size / 2.0 + 0.5 AS hollister_max_m FROM part)")
def dep04(spark, sf):
    d = table(spark, sf, "part").selectExpr("p_partkey AS comid", "p_size / 2.0D + 0.5D AS m")
    return r(d.select("comid", depth.max_to_mean(F.col("m")).alias("mean")), 12)


@query("agg40_densest_project", "SELECT l_shipdate AS project, count(*) AS n FROM lineitem GROUP BY l_shipdate ORDER BY n DESC, project LIMIT 1")
def agg40(spark, sf):
    return depth.densest_project(table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("project")))
