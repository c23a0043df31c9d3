"""Queries of layer and table scans, written results and the scalar rules round them."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnworks.core.io import shared_dir, table
from tarnworks.functions import scalar
from tarnworks.operators import depth
from tarnworks.plans.base import model, query
from tarnworks.plans.zonal import r
from tarnworks.sources import scans, sinks

LAYER = "SELECT o_orderkey AS comid, o_custkey % 100 AS xmin, o_custkey % 100 + 5 AS xmax, o_orderkey % 90 AS ymin, o_orderkey % 90 + 3 AS ymax, o_orderstatus AS ftype, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS geom FROM orders"


def _folder(spark, name: str) -> str:
    """A new folder for what a query writes; it goes when the JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


@query("src01_layer_scan", f"WITH l AS ({LAYER}) SELECT comid, ftype FROM l WHERE xmax >= 20 AND xmin <= 60 AND ymax >= 10 AND ymin <= 50 AND ftype <> 'P' AND geom IS NOT NULL")
def src01(spark, sf):
    path = _folder(spark, "layer")
    spark.sql(LAYER.replace("FROM orders", "FROM {o}"), o=table(spark, sf, "orders")).write.parquet(path)
    return scans.scan_layer(spark, path, ["comid", "ftype"], "ftype <> 'P'", (20, 10, 60, 50), "geom")


@query("src01_laid_out_layer", f"WITH l AS ({LAYER}) SELECT comid, ftype FROM l WHERE xmax >= 20 AND xmin <= 30 AND ymax >= 10 AND ymin <= 25")
def src01_laid_out(spark, sf):
    """The layer along a Z curve, and a small box of it."""
    path = _folder(spark, "layer")
    sinks.write_layer(spark.sql(LAYER.replace("FROM orders", "FROM {o}"), o=table(spark, sf, "orders")), path)
    return scans.scan_layer(spark, path, ["comid", "ftype"], bbox=(20, 10, 30, 25))


@query("src04_parameter_csv", "SELECT p_partkey AS hru_id, p_size AS cov_type, p_retailprice AS srad FROM part")
def src04(spark, sf):
    path = _folder(spark, "parameters")
    table(spark, sf, "part").selectExpr("p_partkey AS hru_id", "p_size AS cov_type", "p_retailprice AS srad").write.csv(path, header=True)
    return scans.scan_parameter_csv(spark, path, "hru_id long, cov_type int, srad double", "hru_id")


@query("src05_checked_crosswalk", f"SELECT {', '.join(scans.CROSSWALK)} FROM crosswalk", ("crosswalk",))
def src05(spark, sf):
    return r(scans.checked_crosswalk(model(spark, sf, "crosswalk")), 9)


@query("snk01_sorted_ids", "SELECT o_orderkey AS hru_id, o_totalprice AS value, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS place FROM orders")
def snk01(spark, sf):
    """Each id with its place in the files as they are written: files in order of their names."""
    path = _folder(spark, "sorted")
    sinks.write_sorted(table(spark, sf, "orders").select(F.col("o_orderkey").alias("hru_id"), F.col("o_totalprice").alias("value")), "hru_id", path)
    d = spark.read.parquet(path).select("hru_id", "value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    files = d.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    offset = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return d.join(offset, "file").select("hru_id", "value", (F.col("offset") + F.col("at")).alias("place"))


@query("srt01_sorted_folders", """WITH n AS (SELECT DISTINCT 'r' || lpad(CAST(l_partkey % 18 + 1 AS VARCHAR), 2, '0') || CASE l_suppkey % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'L' ELSE '' END AS folder FROM lineitem)
 SELECT folder, CAST(row_number() OVER (ORDER BY CAST(folder[2:3] AS INT), folder[4:]) - 1 AS BIGINT) AS place FROM n""")
def srt01(spark, sf):
    from tarnworks.operators.ranks import numbered

    suffix = F.when(F.col("l_suppkey") % 3 == 0, "U").when(F.col("l_suppkey") % 3 == 1, "L").otherwise("")
    d = table(spark, sf, "lineitem").select(F.concat(F.lit("r"), F.lpad((F.col("l_partkey") % 18 + 1).cast("string"), 2, "0"), suffix).alias("folder")).distinct()
    d = d.withColumns({"n": F.regexp_extract("folder", r"^r(\d+)", 1).cast("int"), "s": F.regexp_extract("folder", r"^r\d+(.*)$", 1)})
    return numbered(d, ["n", "s"], "place").select("folder", "place")


@query("snk03_published", """SELECT 'raw' AS version, p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END AS p_size FROM part
 UNION ALL SELECT 'filled', p_partkey, CASE WHEN p_size % 5 = 0 THEN 7 ELSE p_size END FROM part""")
def snk03(spark, sf):
    """Published twice under one name: the raw copy stays the first one, the current version is the
    second, and whole numbers keep their type."""
    path, raw_path = _folder(spark, "published"), _folder(spark, "raw")
    raw = table(spark, sf, "part").selectExpr("p_partkey", "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END AS p_size")
    filled = raw.withColumn("p_size", F.coalesce(F.col("p_size").cast("double"), F.lit(7.0)))
    sinks.publish_filled(raw, raw.withColumn("p_size", F.lit(0)), path, raw_path)
    sinks.publish_filled(raw.withColumn("p_size", F.lit(1)), filled, path, raw_path)
    both = [d.select(F.lit(v).alias("version"), "p_partkey", "p_size") for d, v in ((spark.read.parquet(raw_path), "raw"), (sinks.published(spark, path), "filled"))]
    return both[0].unionByName(both[1])


@query("snk06_provenance", "SELECT comid, dprst_depth_m, ftype, ecoregion, hollister_max_m FROM depths", ("depths",))
def snk06(spark, sf):
    return r(sinks.provenance_rows(model(spark, sf, "depths")), 9)


@query("dep10_freeboard", "+ c AS (SELECT l_partkey AS comid, l_quantity * 1.5 AS filled, l_quantity AS value, l_linenumber < 5 AS inside FROM lineitem) SELECT comid, round(avg(filled - value), 6) AS freeboard FROM c JOIN depths USING (comid) WHERE flat AND inside GROUP BY comid", ("depths",))
def dep10(spark, sf):
    cells = table(spark, sf, "lineitem").selectExpr("l_partkey AS comid", "l_quantity * 1.5D AS filled", "l_quantity AS value", "l_linenumber < 5 AS inside")
    return r(depth.freeboard(model(spark, sf, "depths"), cells), 6)


@query("dep11_validation_sample", "SELECT comid, ftype, area, round(dprst_depth_m / hollister_max_m, 6) AS ratio FROM depths WHERE NOT flat", ("depths",))
def dep11(spark, sf):
    d = model(spark, sf, "depths")
    records = d.select("comid", "ftype", "flat", F.col("dprst_depth_m").cast("double").alias("mean_depth_m"), F.col("hollister_max_m").cast("double").alias("measured_max_m"))
    return r(depth.validation_sample(records, d.select("comid", "area")).select("comid", "ftype", "area", "ratio"), 6, "ratio")


@query("scl05_interpolate", "SELECT p_partkey, CASE WHEN p_size <= 5 THEN 0.0 WHEN p_size >= 45 THEN 1.0 WHEN p_size < 25 THEN (p_size - 5) * 0.4 / 20 ELSE 0.4 + (p_size - 25) * 0.6 / 20 END AS y FROM part")
def scl05(spark, sf):
    points = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((5.0, 0.0), (25.0, 0.4), (45.0, 1.0))])
    return r(table(spark, sf, "part").select("p_partkey", scalar.interpolate(points, F.col("p_size").cast("double")).alias("y")), 9)


@query("scl06_envelope", "WITH v AS (SELECT l_orderkey, l_linenumber, l_quantity / 40 AS v FROM lineitem) SELECT l_orderkey, l_linenumber, least(min(v) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, v), 1.0) AS y FROM v")
def scl06(spark, sf):
    """Cumulative minimum and clip over the lines of an order, read backwards from its reverse."""
    d = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", (F.col("l_quantity") / 40).alias("v")))).alias("rows"))
    low = scalar.clipped(scalar.running_minimum(F.transform("rows", lambda x: x["v"])))
    pairs = F.arrays_zip(F.reverse(F.transform("rows", lambda x: x["l_linenumber"])).alias("line"), F.reverse(low).alias("y"))
    return d.select("l_orderkey", F.explode(pairs).alias("p")).select("l_orderkey", F.col("p")["line"].alias("l_linenumber"), F.col("p")["y"].alias("y"))


@query("scl12_snapped_bounds", "SELECT c_custkey, floor((c_acctbal - 7.5) / 30 - 2) * 30 + 7.5 AS low, ceil((c_acctbal + 100 - 7.5) / 30 + 2) * 30 + 7.5 AS high FROM customer")
def scl12(spark, sf):
    low, high = scalar.snap_bounds(F.col("c_acctbal"), F.col("c_acctbal") + 100, 7.5, 30.0, 2)
    return table(spark, sf, "customer").select("c_custkey", low.alias("low"), high.alias("high"))
