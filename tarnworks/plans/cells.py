"""Queries of cell tables, rasters and flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnworks.functions import scalar
from tarnworks.operators import cells, flow, lines
from tarnworks.plans.base import model, query
from tarnworks.plans.tables import SHAPE, _edges
from tarnworks.plans.zonal import r

G = ("grid",)
WET, PAVED, LAND = "wet", "paved", "land"


def _masks(spark, sf):
    g = model(spark, sf, "grid")
    return g, cells.mask(g, WET), cells.mask(g, PAVED), cells.mask(g, LAND)


@query("prj02_missing_as_null", "SELECT row, col, CASE WHEN value > 400000 OR value <= 50000 THEN NULL ELSE value END AS value FROM (SELECT row, col, CASE WHEN value > 400000 THEN NULL ELSE value END AS value FROM grid)", G)
def prj02(spark, sf):
    g = model(spark, sf, "grid").select("row", "col", F.when(F.col("value") > 400000, float("nan")).otherwise(F.col("value")).alias("value"))
    return g.withColumn("value", scalar.missing_as_null(F.col("value"), None, 50000.0))


@query("prj03_threshold", "SELECT row, col FROM grid WHERE value >= 250000", G)
def prj03(spark, sf):
    return cells.mask(model(spark, sf, "grid"), F.col("value") >= 250000)


@query("prj09_subset", "SELECT cell FROM grid WHERE 1000 + (col + 0.5) * 1000 BETWEEN 9000 AND 32000 AND -(row + 0.5) * 1000 BETWEEN -52000 AND -18000", G)
def prj09(spark, sf):
    x, y = 1000 + (F.col("col") + 0.5) * 1000, -(F.col("row") + 0.5) * 1000
    return cells.subset_to_bounds(model(spark, sf, "grid"), x, y, (11000, -50000, 30000, -20000)).select("cell")


@query("prj10_conditional_product", "SELECT row, col, CASE WHEN cell % 5 >= 3 THEN value * (cell % 101) / 100 ELSE 0 END AS value FROM grid WHERE wet AND land", G)
def prj10(spark, sf):
    g = model(spark, sf, "grid")
    return cells.conditional_product(g.where(WET), g.where(LAND).withColumn("value", F.col("cell") % 101), g.withColumn("value", F.col("cell") % 5))


@query("prj11_product", "SELECT row, col, value * (cell % 13) AS value FROM grid WHERE wet AND paved", G)
def prj11(spark, sf):
    g = model(spark, sf, "grid")
    return cells.product(g.where(WET), g.where(PAVED).withColumn("value", F.col("cell") % 13))


@query("prj12_composite_class", "SELECT cell, CAST(CASE WHEN paved THEN 1 WHEN wet THEN 2 ELSE 0 END AS INTEGER) AS class FROM grid", G)
def prj12(spark, sf):
    return cells.composite_class(model(spark, sf, "grid"), F.col("paved"), F.col("wet")).select("cell", "class")


@query("prj13_topographic_index", "SELECT cell, round(ln((cell % 997 + 1) * 10 / (tan(radians(least(value / 5000, 60))) + 0.01)), 6) AS twi FROM grid WHERE land", G)
def prj13(spark, sf):
    g = model(spark, sf, "grid").where(LAND)
    return r(g.select("cell", cells.topographic_index(F.col("cell") % 997, F.col("value") / 5000).alias("twi")), 6)


@query("jon01_mask_intersection", "SELECT row, col FROM grid WHERE wet AND paved AND land", G)
def jon01(spark, sf):
    _, wet, paved, land = _masks(spark, sf)
    return cells.intersect(wet, paved, land)


@query("jon02_land_semi_join", "SELECT row, col FROM grid WHERE wet AND land", G)
def jon02(spark, sf):
    _, wet, _, land = _masks(spark, sf)
    return cells.on_land(wet, land)


@query("jon02_off_land_count", "SELECT count(*) AS n_dropped FROM grid WHERE wet AND NOT land", G)
def jon02n(spark, sf):
    _, wet, _, land = _masks(spark, sf)
    return cells.off_land_count(wet, land)


@query("jon03_region_threshold", "SELECT cell, region, coalesce(value > region * 100000 + 50000, false) AS passes FROM grid", G)
def jon03(spark, sf):
    g = model(spark, sf, "grid")
    t = g.where("region IS NOT NULL").select("region").distinct().withColumn("t", F.col("region") * 100000.0 + 50000)
    return cells.above_region_threshold(g, t).select("cell", "region", "passes")


@query("grd01_cell_centres", "SELECT cell, 1000 + (col + 0.5) * 30 AS x, 5000 - (row + 0.5) * 30 AS y FROM grid", G)
def grd01(spark, sf):
    return model(spark, sf, "grid").select("cell", (1000 + (F.col("col") + 0.5) * 30).alias("x"), (5000 - (F.col("row") + 0.5) * 30).alias("y"))


@query("grd03_nearest_regrid", "SELECT CAST(t.row AS INTEGER) AS row, CAST(t.col AS INTEGER) AS col, s.value FROM grid t JOIN grid s ON s.row = floor((t.row + 0.5) * 0.4) AND s.col = floor((t.col + 0.5) * 0.4)", G)
def grd03(spark, sf):
    g = model(spark, sf, "grid")
    return cells.nearest_regrid(g, g.select("row", "col"), 0.4)


@query("grd04_bilinear_regrid", """+ t AS (SELECT row, col, (row + 0.5) * 0.5 - 0.5 AS pr, (col + 0.5) * 0.5 - 0.5 AS pc FROM grid), k AS (SELECT t.*, i, j, CAST(floor(pr) + i AS INTEGER) AS sr, CAST(floor(pc) + j AS INTEGER) AS sc,
 (1 - abs(pr - floor(pr) - i)) * (1 - abs(pc - floor(pc) - j)) AS w FROM t, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j))
 SELECT k.row, k.col, round(sum(w * s.value) / sum(w), 6) AS value FROM k JOIN grid s ON s.row = sr AND s.col = sc WHERE w > 0 GROUP BY k.row, k.col""", G)
def grd04(spark, sf):
    g = model(spark, sf, "grid")
    return r(cells.bilinear_regrid(g, g.select("row", "col"), 0.5), 6)


@query("grd05_overview_average", "SELECT CAST(floor(row / 4) AS INTEGER) AS row, CAST(floor(col / 4) AS INTEGER) AS col, round(avg(value), 6) AS value FROM grid GROUP BY floor(row / 4), floor(col / 4)", G)
def grd05(spark, sf):
    return r(cells.coarse(model(spark, sf, "grid"), 4), 6)


@query("grd05_overview_nearest", "SELECT CAST(floor(row / 4) AS INTEGER) AS row, CAST(floor(col / 4) AS INTEGER) AS col, value FROM grid WHERE row % 4 = 2 AND col % 4 = 2", G)
def grd05n(spark, sf):
    return cells.coarse(model(spark, sf, "grid"), 4, "nearest")


@query("grd10_code_boxes", "SELECT region, min(row) AS r0, max(row) + 1 AS r1, min(col) AS c0, max(col) + 1 AS c1 FROM grid WHERE region IS NOT NULL GROUP BY region", G)
def grd10(spark, sf):
    return cells.code_boxes(model(spark, sf, "grid"), "region")


@query("grd11_gated_burn", "SELECT row, col, value FROM grid WHERE land AND wet", G)
def grd11(spark, sf):
    g, wet, _, land = _masks(spark, sf)
    return cells.gated_burn(g.select("row", "col", "value"), land, wet)


@query("grd12_pervious", "SELECT row, col FROM grid WHERE land AND NOT paved AND NOT wet", G)
def grd12(spark, sf):
    _, wet, paved, land = _masks(spark, sf)
    return cells.pervious(land, paved, wet)


@query("grd13_contributing", "SELECT row, col, cell % 7 = 0 OR value > 300000 AS carea, cell % 7 = 0 OR value > 450000 AS smidx FROM grid WHERE land AND NOT paved AND NOT wet", G)
def grd13(spark, sf):
    g, wet, paved, land = _masks(spark, sf)
    return cells.contributing(cells.pervious(land, paved, wet), g, cells.mask(g, F.col("cell") % 7 == 0), {"carea": 300000.0, "smidx": 450000.0})


REGION = """, lab AS (SELECT row, col, cell, CAST(floor(cell / 5) AS BIGINT) AS label FROM grid WHERE wet)"""
DEPRESSION = f"""+ w AS (SELECT * FROM grid){REGION}, con AS (SELECT cell FROM grid WHERE cell % 11 = 0), endo AS (SELECT cell FROM grid WHERE cell % 4 = 0),
 touched AS (SELECT DISTINCT label FROM lab JOIN con USING (cell)), dry AS (SELECT cell FROM lab WHERE label NOT IN (SELECT label FROM touched) UNION SELECT cell FROM lab WHERE cell IN (SELECT cell FROM endo) AND cell NOT IN (SELECT cell FROM con))"""


def _regions(spark, sf):
    g, wet, paved, land = _masks(spark, sf)
    lab = g.where(WET).select("row", "col", F.floor(F.col("cell") / 5).cast("long").alias("label"))
    return g, paved, land, lab, cells.mask(g, F.col("cell") % 11 == 0), cells.mask(g, F.col("cell") % 4 == 0)


@query("grd14_depression_classes", DEPRESSION + """ SELECT g.row, g.col, 'depression' AS kind FROM grid g WHERE cell IN (SELECT cell FROM dry) AND land AND NOT paved
 UNION ALL SELECT g.row, g.col, 'onstream' FROM grid g WHERE wet AND land AND cell NOT IN (SELECT cell FROM dry)""", G)
def grd14(spark, sf):
    _, paved, land, lab, con, endo = _regions(spark, sf)
    return cells.depression_classes(lab, con, endo, paved, land)


@query("grd15_regions_touching", DEPRESSION + " SELECT label FROM touched", G)
def grd15(spark, sf):
    _, _, _, lab, con, _ = _regions(spark, sf)
    return cells.regions_touching(lab, con)


@query("grd15_cells_of_regions", DEPRESSION + " SELECT row, col FROM lab WHERE label IN (SELECT label FROM touched)", G)
def grd15c(spark, sf):
    _, _, _, lab, con, _ = _regions(spark, sf)
    return cells.cells_of_regions(lab, cells.regions_touching(lab, con))


NEAR = """+ s(code, i, j) AS (VALUES (1, 0, 1), (2, 1, 1), (4, 1, 0), (8, 1, -1), (16, 0, -1), (32, -1, -1), (64, -1, 0), (128, -1, 1)),
 n AS (SELECT g.row, g.col, g.value, s.code, h.value AS n_value FROM grid g, s JOIN grid h ON h.row = g.row + s.i AND h.col = g.col + s.j)"""


@query("grd17_slope_aspect", NEAR + """, z AS (SELECT row, col, coalesce(max(n_value) FILTER (code = 1), first(value)) z1, coalesce(max(n_value) FILTER (code = 2), first(value)) z2, coalesce(max(n_value) FILTER (code = 4), first(value)) z4,
 coalesce(max(n_value) FILTER (code = 8), first(value)) z8, coalesce(max(n_value) FILTER (code = 16), first(value)) z16, coalesce(max(n_value) FILTER (code = 32), first(value)) z32, coalesce(max(n_value) FILTER (code = 64), first(value)) z64, coalesce(max(n_value) FILTER (code = 128), first(value)) z128 FROM n GROUP BY row, col),
 d AS (SELECT row, col, ((z128 + 2 * z1 + z2) - (z32 + 2 * z16 + z8)) / (8 * 30000.0) AS dx, ((z8 + 2 * z4 + z2) - (z32 + 2 * z64 + z128)) / (8 * 30000.0) AS dy FROM z)
 SELECT row, col, round(degrees(atan(sqrt(dx * dx + dy * dy))), 5) AS slope, round(CASE WHEN dx = 0 AND dy = 0 THEN NULL ELSE (degrees(atan2(-dx, dy)) + 360) % 360 END, 5) AS aspect FROM d""", G)
def grd17(spark, sf):
    return r(cells.slope_aspect(model(spark, sf, "grid"), 30000.0), 5)


@query("grd18_flow_pointer", NEAR + """, b AS (SELECT row, col, arg_max(code, ((value - n_value) / CASE WHEN code IN (2, 8, 32, 128) THEN sqrt(2.0) ELSE 1 END, -code)) AS code FROM n WHERE n_value < value GROUP BY row, col)
 SELECT g.row, g.col, CAST(coalesce(b.code, 0) AS INTEGER) AS code FROM grid g LEFT JOIN b USING (row, col)""", G)
def grd18(spark, sf):
    return cells.flow_pointer(model(spark, sf, "grid"))


CODES = "SELECT row, col, cell, region, land, wet, CAST(CASE (row * 7 + col * 13 + cell % 5) % 9 WHEN 0 THEN 0 ELSE pow(2, (row * 7 + col * 13 + cell % 5) % 9 - 1) END AS INT) AS code FROM grid"
FLOW = f"""+ cod AS ({CODES}), s(code, i, j) AS (VALUES (1, 0, 1), (2, 1, 1), (4, 1, 0), (8, 1, -1), (16, 0, -1), (32, -1, -1), (64, -1, 0), (128, -1, 1)),
 ptr AS (SELECT c.cell, t.cell AS nxt FROM cod c LEFT JOIN s USING (code) LEFT JOIN cod t ON t.row = c.row + s.i AND t.col = c.col + s.j),
 pour AS (SELECT cell, cell % 97 + 1 AS label FROM cod WHERE cell % 23 = 0), bar AS (SELECT cell FROM cod WHERE cell % 31 = 0), stop AS (SELECT cell FROM pour UNION SELECT cell FROM bar),
 hop AS (SELECT cell, CASE WHEN cell IN (SELECT cell FROM stop) THEN NULL ELSE nxt END AS nxt FROM ptr),
 walk(cell, cur) AS (SELECT cell, cell FROM hop UNION SELECT w.cell, h.nxt FROM walk w JOIN hop h ON h.cell = w.cur WHERE h.nxt IS NOT NULL),
 fin AS (SELECT w.cell, max(w.cur) AS fin FROM walk w JOIN hop h ON h.cell = w.cur WHERE h.nxt IS NULL GROUP BY w.cell)"""


def _flow(spark, sf):
    codes = spark.sql(CODES.replace("FROM grid", "FROM {grid}"), grid=model(spark, sf, "grid"))
    pour = codes.where("cell % 23 = 0").select("cell", (F.col("cell") % 97 + 1).alias("label"))
    return codes, flow.in_tiles(flow.pointers(codes, 64), 64), pour, codes.where("cell % 31 = 0").select("cell")


@query("grd19_terminal_cells", f"+ cod AS ({CODES}) SELECT row, col FROM cod WHERE code = 0", G)
def grd19(spark, sf):
    return cells.mask(_flow(spark, sf)[0], F.col("code") == 0)


@query("grd20_region_pointers", f"""+ cod AS ({CODES}), s(code, i, j) AS (VALUES (1, 0, 1), (2, 1, 1), (4, 1, 0), (8, 1, -1), (16, 0, -1), (32, -1, -1), (64, -1, 0), (128, -1, 1))
 SELECT c.cell, t.cell AS next FROM cod c LEFT JOIN s USING (code) LEFT JOIN cod t ON t.row = c.row + s.i AND t.col = c.col + s.j AND coalesce(t.region, -1) = coalesce(c.region, -1)""", G)
def grd20(spark, sf):
    return flow.pointers(_flow(spark, sf)[0], 64, "region")


@query("grf02_downstream_reach", FLOW + " SELECT c.cell, CAST(CASE WHEN f.fin IN (SELECT cell FROM pour) THEN 1 ELSE 0 END AS INTEGER) AS drains, f.fin IS NULL AS cyclic FROM cod c LEFT JOIN fin f USING (cell)", G)
def grf02(spark, sf):
    _, ptr, pour, bar = _flow(spark, sf)
    return flow.downstream_reach(ptr, pour, bar)


LABELLED = FLOW + ", lab AS (SELECT c.cell, c.land, CAST(coalesce(p.label, 0) AS BIGINT) AS label FROM cod c LEFT JOIN fin f USING (cell) LEFT JOIN pour p ON p.cell = f.fin)"


@query("grf03_labelled_reach", LABELLED + " SELECT cell, label FROM lab", G)
def grf03(spark, sf):
    _, ptr, pour, bar = _flow(spark, sf)
    return flow.labelled_reach(ptr, pour, bar)


@query("grf04_label_counts", LABELLED + " SELECT label, count(*) AS n_cells FROM lab WHERE label > 0 GROUP BY label", G)
def grf04(spark, sf):
    _, ptr, pour, bar = _flow(spark, sf)
    return flow.label_counts(flow.labelled_reach(ptr, pour, bar))


@query("grf04_same_zone", LABELLED + " SELECT cell, label FROM lab WHERE label > 0 AND label = cell % 97 + 1 AND land", G)
def grf04z(spark, sf):
    codes, ptr, pour, bar = _flow(spark, sf)
    return flow.same_zone(flow.labelled_reach(ptr, pour, bar), codes.select("cell", (F.col("cell") % 97 + 1).alias("zone_id")), codes.where("land"))


@query("grf10_routing_job", FLOW + " SELECT c.cell FROM cod c JOIN fin f USING (cell) WHERE f.fin IN (SELECT cell FROM pour) AND c.land", G)
def grf10(spark, sf):
    codes, ptr, pour, bar = _flow(spark, sf)
    return flow.downstream_reach(ptr, pour, bar).where("drains = 1").select("cell").join(codes.where("land").select("cell"), "cell", "left_semi")


@query("grf06_flow_accumulation", f"""+ cod AS ({CODES}), s(code, i, j) AS (VALUES (1, 0, 1), (2, 1, 1), (4, 1, 0), (8, 1, -1), (16, 0, -1), (32, -1, -1), (64, -1, 0), (128, -1, 1)),
 hop AS (SELECT c.cell, t.cell AS nxt FROM cod c LEFT JOIN s USING (code) LEFT JOIN cod t ON t.row = c.row + s.i AND t.col = c.col + s.j),
 walk(cell, cur) AS (SELECT cell, cell FROM hop UNION SELECT w.cell, h.nxt FROM walk w JOIN hop h ON h.cell = w.cur WHERE h.nxt IS NOT NULL),
 good AS (SELECT DISTINCT w.cell FROM walk w JOIN hop h ON h.cell = w.cur WHERE h.nxt IS NULL)
 SELECT cur AS cell, count(*) - 1 AS upslope FROM walk WHERE cell IN (SELECT cell FROM good) GROUP BY cur""", G)
def grf06(spark, sf):
    return flow.flow_accumulation(_flow(spark, sf)[1])


@query("grf07_own_terminus", FLOW + """, e AS (SELECT w.cell, max(w.cur) AS fin FROM walk w JOIN hop h ON h.cell = w.cur WHERE h.nxt IS NULL GROUP BY w.cell)
 SELECT CAST(floor(c.cell / 7) AS BIGINT) AS comid, avg(CASE WHEN floor(e.fin / 7) = floor(c.cell / 7) AND fw.wet THEN 1.0 ELSE 0 END) AS share FROM cod c LEFT JOIN e USING (cell) LEFT JOIN cod fw ON fw.cell = e.fin WHERE c.wet GROUP BY floor(c.cell / 7)""", G)
def grf07(spark, sf):
    codes, ptr, pour, bar = _flow(spark, sf)
    poly = codes.where("wet").select("cell", F.floor(F.col("cell") / 7).cast("long").alias("comid"))
    return flow.own_terminus_share(flow.path_ends(ptr, pour.select("cell").union(bar)), poly)


@query("grf07_within_window", FLOW + """, wb AS (SELECT cell, min(floor(cur / 64)) AS p0, max(floor(cur / 64)) AS p1, min(cur % 64) AS q0, max(cur % 64) AS q1 FROM walk GROUP BY cell),
 pb AS (SELECT floor(cell / 7) AS k, min(floor(cell / 64)) AS y0, max(floor(cell / 64)) AS y1, min(cell % 64) AS x0, max(cell % 64) AS x1 FROM cod WHERE wet GROUP BY floor(cell / 7)), pr AS (SELECT *, greatest(1, greatest(y1 - y0, x1 - x0) / 2) AS pad FROM pb)
 SELECT CAST(floor(c.cell / 7) AS BIGINT) AS comid, avg(CASE WHEN floor(e.fin / 7) = floor(c.cell / 7) AND fw.wet AND p0 >= y0 - pad AND p1 <= y1 + pad AND q0 >= x0 - pad AND q1 <= x1 + pad THEN 1.0 ELSE 0 END) AS share
 FROM cod c LEFT JOIN fin e USING (cell) LEFT JOIN cod fw ON fw.cell = e.fin LEFT JOIN wb ON wb.cell = c.cell JOIN pr ON pr.k = floor(c.cell / 7) WHERE c.wet GROUP BY floor(c.cell / 7)""", G)
def grf07w(spark, sf):
    codes, ptr, pour, bar = _flow(spark, sf)
    poly = codes.where("wet").select("cell", F.floor(F.col("cell") / 7).cast("long").alias("comid"))
    return flow.own_terminus_share(flow.path_ends(ptr, pour.select("cell").union(bar), width=64), poly, pad=1, width=64)


LEAST = """w(a, b) USING KEY (a) AS (SELECT n, n FROM v UNION SELECT e.b, min(w.b) FROM w JOIN e ON e.a = w.a JOIN recurring.w r ON r.a = e.b WHERE w.b < r.b GROUP BY e.b)"""


@query("grf01_regions", f"""+ m AS (SELECT row, col, cell FROM grid WHERE cell % 3 = 0 OR cell % 10 = 1), v AS (SELECT cell AS n FROM m), o AS (SELECT unnest(range(-1, 2)) AS d),
 e AS MATERIALIZED (SELECT a.cell AS a, b.cell AS b FROM m a, o i, o j, m b WHERE b.row = a.row + i.d AND b.col = a.col + j.d AND a.cell <> b.cell), {LEAST}
 SELECT m.row, m.col, CAST(w.b + 1 AS BIGINT) AS label FROM m JOIN w ON w.a = m.cell""", G)
def grf01(spark, sf):
    return flow.regions(model(spark, sf, "grid").where("cell % 3 = 0 OR cell % 10 = 1"), 64)


@query("grf08_filled_depressions")
def grf08(spark, sf):
    return flow.fill_depressions(model(spark, sf, "grid").select("row", "col", "value"))


@query("grf09_tile_components", f"""WITH RECURSIVE m AS (SELECT DISTINCT l_orderkey AS polygon, l_partkey * 5 + l_orderkey % 5 AS tile FROM lineitem), v AS (SELECT DISTINCT tile AS n FROM m),
 e AS MATERIALIZED (SELECT DISTINCT a.tile AS a, b.tile AS b FROM m a JOIN m b USING (polygon)), {LEAST} SELECT a AS tile, b AS component FROM w""")
def grf09(spark, sf):
    from tarnworks.core.io import table

    return flow.tile_components(table(spark, sf, "lineitem").selectExpr("l_orderkey AS polygon", "l_partkey * 5 + l_orderkey % 5 AS tile").distinct())


#: A cell's diagonal, the distance up to which polygons of a layer are neighbours.
DIAGONAL = 2**0.5


@query("grf05_transitive_reach", f"""WITH RECURSIVE sh AS MATERIALIZED ({SHAPE}), part AS (SELECT zone_id, x0 AS a0, y0 AS b0, x1 AS a1, ym AS b1 FROM sh UNION ALL SELECT zone_id, x0, y0, xm, y1 FROM sh),
 e AS MATERIALIZED (SELECT DISTINCT p.zone_id AS a, q.zone_id AS b FROM part p, part q WHERE p.zone_id <> q.zone_id AND sqrt(greatest(0, p.a0 - q.a1, q.a0 - p.a1) ** 2 + greatest(0, p.b0 - q.b1, q.b0 - p.b1) ** 2) <= sqrt(2)),
 w(seed, node) AS (SELECT zone_id, zone_id FROM sh WHERE zone_id % 5 < 2 UNION SELECT w.seed, e.b FROM w JOIN e ON e.a = w.node) SELECT seed, min(node) AS key FROM w WHERE node % 7 = 3 GROUP BY seed""")
def grf05(spark, sf):
    e = _edges(spark, sf)
    ids = e.select("zone_id").distinct()
    return flow.transitive_reach(ids.where("zone_id % 5 < 2").withColumnRenamed("zone_id", "seed"), lines.near_links(e, DIAGONAL, size=3.0), ids.where("zone_id % 7 = 3").withColumnRenamed("zone_id", "key"))


@query("zon22_gained_lost", "SELECT region, count(*) FILTER (wet AND NOT paved) AS gained, count(*) FILTER (paved AND NOT wet) AS lost, count(*) FILTER (wet AND paved) AS both, (count(*) FILTER (wet AND NOT paved) - count(*) FILTER (paved AND NOT wet)) * 900.0 AS net_area FROM grid WHERE wet OR paved GROUP BY region", G)
def zon22(spark, sf):
    g = model(spark, sf, "grid")
    return cells.gained_lost(g.where(WET), g.where(PAVED), "region", 900.0)


@query("zon23_recoverable", "SELECT count(*) AS n_cells, count(*) * 900.0 AS area FROM grid WHERE wet AND land AND NOT paved AND cell % 11 <> 0 AND cell % 4 <> 0", G)
def zon23(spark, sf):
    _, wet, paved, land = _masks(spark, sf)
    g = model(spark, sf, "grid")
    return cells.recoverable(wet, cells.mask(g, F.col("cell") % 11 == 0), cells.mask(g, F.col("cell") % 4 == 0), paved, land, 900.0)


TILES = "SELECT row, col, value, 0 AS tile FROM grid WHERE col < 40 UNION ALL SELECT row, col, value * 0.9 + 20000, 1 FROM grid WHERE col >= 30"


@query("agg42_mosaic_min", f"+ t AS ({TILES}) SELECT row, col, min(value) AS value FROM t GROUP BY row, col", G)
def agg42(spark, sf):
    return cells.overlap_mosaic(_tiles(spark, sf))


@query("agg42_mosaic_first", f"+ t AS ({TILES}) SELECT row, col, arg_min(value, tile) AS value FROM t GROUP BY row, col", G)
def agg42f(spark, sf):
    return cells.overlap_mosaic(_tiles(spark, sf), "first")


def _tiles(spark, sf):
    return spark.sql(TILES.replace("FROM grid", "FROM {grid}"), grid=model(spark, sf, "grid"))


@query("agg43_priority_mosaic", "SELECT row, col, CASE WHEN wet THEN value ELSE value / 2 END AS value, NOT wet AS filled FROM grid WHERE wet OR paved", G)
def agg43(spark, sf):
    g = model(spark, sf, "grid")
    return cells.priority_mosaic(g.where(WET), g.where(PAVED).withColumn("value", F.col("value") / 2))


@query("agg43_fill_zone", "SELECT row, col FROM grid WHERE paved AND NOT wet", G)
def agg43z(spark, sf):
    g = model(spark, sf, "grid")
    return cells.fill_zone(g.where(WET), g.where(PAVED))


@query("agg51_difference_statistics", """+ j AS (SELECT region, value - (value * 0.5 + cell % 3) AS d FROM grid WHERE wet AND land) SELECT region, count(*) AS n, round(avg(d), 6) AS mean, round(avg(abs(d)), 6) AS mean_abs, round(stddev_pop(d), 6) AS std,
 round(quantile_cont(d, 0.01), 6) AS p1, round(quantile_cont(d, 0.5), 6) AS p50, round(quantile_cont(d, 0.95), 6) AS p95, round(quantile_cont(d, 0.99), 6) AS p99, round(avg(CASE WHEN abs(d) <= 0.1 THEN 1.0 ELSE 0 END), 6) AS within FROM j GROUP BY region""", G)
def agg51(spark, sf):
    g = model(spark, sf, "grid")
    return r(cells.difference_statistics(g.where(WET), g.where(LAND).withColumn("value", F.col("value") * 0.5 + F.col("cell") % 3)), 6)
