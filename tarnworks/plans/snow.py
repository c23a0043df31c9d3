"""Queries of depletion curves and their library."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnworks.functions import scalar
from tarnworks.operators import snow
from tarnworks.plans.base import model, query
from tarnworks.plans.zonal import r

DEFAULT = [round(1 - i / 10, 1) for i in range(11)]
SEASON = """+ d AS (SELECT *, CAST(year(date) + CASE WHEN month(date) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS wy FROM daily),
 t AS (SELECT *, max(swe) OVER y AS top, min(date) OVER y AS first_day FROM d WINDOW y AS (PARTITION BY zone_id, wy)),
 p AS (SELECT *, min(date) FILTER (swe = top) OVER y AS peak_day FROM t WINDOW y AS (PARTITION BY zone_id, wy)),
 e AS (SELECT *, min(date) FILTER (date >= peak_day AND swe <= 0) OVER y AS end_day FROM p WINDOW y AS (PARTITION BY zone_id, wy)),
 season AS (SELECT zone_id, wy, date, CAST(row_number() OVER (PARTITION BY zone_id, wy ORDER BY date) AS INTEGER) AS day, swe, sca FROM e
   WHERE top > 0 AND peak_day > first_day AND end_day IS NOT NULL AND date >= peak_day AND date <= end_day),
 env AS (SELECT zone_id, wy, date, day, swe, sca FROM (SELECT *, min(sca) OVER (PARTITION BY zone_id, wy ORDER BY day) AS low FROM season WHERE sca IS NOT NULL) WHERE sca <= low),
 nor AS (SELECT *, first(sca) OVER o AS sca_first, CASE WHEN first(swe) OVER o > 0 THEN swe / first(swe) OVER o ELSE 0 END AS x, CASE WHEN first(sca) OVER o > 0 THEN sca / first(sca) OVER o ELSE 0 END AS y FROM env WINDOW o AS (PARTITION BY zone_id, wy ORDER BY day)),
 good AS (SELECT zone_id, wy FROM nor GROUP BY zone_id, wy HAVING count(*) >= 2 AND max(sca_first) > 0),
 lev AS (SELECT i AS level, 1 - i / 10.0 AS lx FROM (SELECT unnest(range(0, 11)) AS i)),
 ip AS (SELECT g.zone_id, g.wy, l.level, l.lx, arg_max(n.x, (n.x, n.day)) FILTER (n.x <= round(l.lx, 1)) AS ax, arg_max(n.y, (n.x, n.day)) FILTER (n.x <= round(l.lx, 1)) AS ay,
   arg_min(n.x, (n.x, n.day)) FILTER (n.x > round(l.lx, 1)) AS bx, arg_min(n.y, (n.x, n.day)) FILTER (n.x > round(l.lx, 1)) AS by_
   FROM good g JOIN nor n USING (zone_id, wy), lev l GROUP BY g.zone_id, g.wy, l.level, l.lx),
 raw AS (SELECT zone_id, wy, level, CASE WHEN ax IS NULL THEN by_ WHEN bx IS NULL THEN ay ELSE ay + (by_ - ay) * (round(lx, 1) - ax) / (bx - ax) END AS v FROM ip),
 cur AS (SELECT zone_id, wy, level, greatest(0, least(1, min(v) OVER (PARTITION BY zone_id, wy ORDER BY level))) AS value FROM raw),
 med AS (SELECT zone_id, level, median(value) AS median FROM cur GROUP BY zone_id, level),
 dis AS (SELECT zone_id, wy, avg(abs(value - median)) AS distance FROM cur JOIN med USING (zone_id, level) GROUP BY zone_id, wy),
 sim AS (SELECT zone_id, avg(distance) AS similarity, count(*) AS n_seasons FROM dis GROUP BY zone_id),
 rep AS (SELECT zone_id, arg_min(wy, (round(distance, 12), wy)) AS wy FROM dis GROUP BY zone_id),
 pk AS (SELECT zone_id, wy, swe, swe_std FROM (SELECT *, row_number() OVER (PARTITION BY zone_id, wy ORDER BY swe DESC, date) AS rr FROM d WHERE swe IS NOT NULL) WHERE rr = 1 AND swe > 0 AND swe_std IS NOT NULL),
 pks AS (SELECT zone_id, median(swe_std / swe) AS cv_subgrid, median(swe) AS peak_swe_mm, count(*) AS n_peak_years FROM pk GROUP BY zone_id),
 con AS (SELECT zone_id, coalesce(avg(CASE WHEN swe > 0 THEN CASE WHEN sca >= top - 1e-9 THEN 1.0 ELSE 0 END END), 1) AS constant_frac FROM (SELECT *, max(sca) FILTER (swe > 0) OVER (PARTITION BY zone_id) AS top FROM daily) GROUP BY zone_id),
 zs AS (SELECT zone_id, coalesce(max(swe), 0) > 0 AS has_snow, coalesce(max(sca), 0) AS sca_max, count(*) AS n_days FROM daily GROUP BY zone_id),
 st AS (SELECT *, CASE WHEN NOT has_snow THEN 'default_no_snow' WHEN n_cells < 15 THEN 'default_too_few_cells' WHEN water_frac > 0.5 THEN 'default_water_dominated' WHEN sca_max < 0.5 THEN 'default_low_sca'
   WHEN constant_frac > 0.8 THEN 'default_constant_sca' WHEN similarity IS NULL OR similarity > 0.1 THEN 'default_dissimilar' ELSE 'derived' END AS sdc_status
   FROM (SELECT zs.*, con.constant_frac, sim.similarity, coalesce(sim.n_seasons, 0) AS n_seasons, 12 + zs.zone_id AS n_cells, (zs.zone_id % 10) / 15.0 AS water_frac FROM zs JOIN con USING (zone_id) LEFT JOIN sim USING (zone_id)))
"""
D = ("daily",)


def lognormal_sql(coefficients: str, name: str = "lg") -> str:
    """CTEs that end in ``name``(cv, level, value): the lognormal curve at the eleven levels for each cv of
    the query. The normal distribution's integral is the series of the error function."""
    phi = "0.5 * (1 + sign({0}) * list_sum(list_transform(range(0, 90), lambda k: exp((2 * k + 1) * ln(greatest(abs({0}) / sqrt(2), 1e-300)) - lgamma(k + 1.5) - {0} * {0} / 2))))"
    return f""" {name}_cv AS (SELECT DISTINCT CAST(cv AS DOUBLE) AS cv FROM ({coefficients}) WHERE cv IS NOT NULL),
 {name}_m AS (SELECT cv, z, i, -6 * z + i * (12 * z / 3999) AS m FROM (SELECT cv, sqrt(ln(1 + greatest(cv, 1e-4) * greatest(cv, 1e-4))) AS z FROM {name}_cv), (SELECT unnest(range(0, 4000)) AS i)),
 {name}_a AS (SELECT cv, i, m, (-z * z / 2 - m) / z AS a, (z * z / 2 - m) / z AS b FROM {name}_m),
 {name}_y AS (SELECT cv, i, m, {phi.format("a")} AS y, {phi.format("b")} AS b FROM {name}_a),
 {name}_x AS (SELECT cv, b - exp(m) * y AS x, y, i FROM {name}_y),
 {name}_n AS (SELECT *, lead(x) OVER o AS nx, lead(y) OVER o AS ny FROM (SELECT cv, x, y, -i AS i FROM {name}_x UNION ALL SELECT cv, 1.0, 1.0, 1 FROM {name}_cv) WINDOW o AS (PARTITION BY cv ORDER BY i)),
 {name}_l AS (SELECT cv, 10 - j AS level, j / 10.0 AS lx FROM {name}_cv, (SELECT unnest(range(1, 10)) AS j)),
 {name} AS (SELECT l.cv, l.level, greatest(0, least(1, arg_max(n.y + (n.ny - n.y) * (l.lx - n.x) / (n.nx - n.x), n.i))) AS value
   FROM {name}_l l JOIN {name}_n n ON n.cv = l.cv AND n.x <= l.lx AND n.nx > l.lx GROUP BY l.cv, l.level
   UNION ALL SELECT cv, 0, 1.0 FROM {name}_cv UNION ALL SELECT cv, 10, 0.0 FROM {name}_cv)"""


GRID = "SELECT round(0.05 * unnest(range(1, 61)), 2) AS cv"
#: (zone_id, cv_empirical) over the representative curves.
FITTED = """ SELECT zone_id, arg_min(cv, (gap, cv)) AS cv_empirical FROM (SELECT c.zone_id, lg.cv, round(sum((c.value - lg.value) ** 2), 12) AS gap
   FROM cur c JOIN rep USING (zone_id, wy) JOIN lg ON lg.level = c.level WHERE c.level BETWEEN 1 AND 9 GROUP BY c.zone_id, lg.cv) GROUP BY zone_id"""


@query("win01_water_year", SEASON + " SELECT zone_id, date, wy FROM d", D)
def win01(spark, sf):
    return snow.with_water_year(model(spark, sf, "daily")).select("zone_id", "date", "wy")


@query("win02_melt_seasons", SEASON + " SELECT zone_id, wy, date, day, round(swe, 4) AS swe, round(sca, 4) AS sca FROM season", D)
def win02(spark, sf):
    return r(snow.melt_seasons(model(spark, sf, "daily")))


@query("win03_reversals_removed", SEASON + " SELECT zone_id, wy, date, day, round(swe, 4) AS swe, round(sca, 4) AS sca FROM env", D)
def win03(spark, sf):
    return r(snow.without_reversals(snow.melt_seasons(model(spark, sf, "daily"))))


@query("win04_normalised", SEASON + " SELECT zone_id, wy, day, round(x, 6) AS swe_n, round(y, 6) AS sca_n FROM nor", D)
def win04(spark, sf):
    return r(snow.normalised(snow.without_reversals(snow.melt_seasons(model(spark, sf, "daily")))).select("zone_id", "wy", "day", "swe_n", "sca_n"), 6)


@query("win05_annual_curves", SEASON + " SELECT zone_id, wy, CAST(level AS INTEGER) AS level, round(value, 12) AS value FROM cur", D)
def win05(spark, sf):
    return r(snow.annual_curves(model(spark, sf, "daily")).select("zone_id", "wy", F.posexplode("curve").alias("level", "value")), 12)


@query("win06_median_curve", SEASON + " SELECT zone_id, CAST(level AS INTEGER) AS level, round(median, 6) AS median FROM med", D)
def win06(spark, sf):
    return r(snow.median_curve(snow.annual_curves(model(spark, sf, "daily"))), 6)


@query("win07_similarity", SEASON + " SELECT zone_id, round(similarity, 6) AS similarity, n_seasons FROM sim", D)
def win07(spark, sf):
    return r(snow.similarity(snow.annual_curves(model(spark, sf, "daily"))), 6)


@query("win08_representative", SEASON + " SELECT zone_id, wy FROM rep", D)
def win08(spark, sf):
    return snow.representative(snow.annual_curves(model(spark, sf, "daily"))).select("zone_id", "wy")


@query("win09_peak_statistics", SEASON + " SELECT zone_id, round(cv_subgrid, 6) AS cv_subgrid, round(peak_swe_mm, 4) AS peak_swe_mm, n_peak_years FROM pks", D)
def win09(spark, sf):
    return r(r(snow.peak_statistics(model(spark, sf, "daily")), 4, "peak_swe_mm"), 6, "cv_subgrid")


@query("win10_constant_cover", SEASON + " SELECT zone_id, round(constant_frac, 6) AS constant_frac FROM con", D)
def win10(spark, sf):
    return r(snow.constant_cover(model(spark, sf, "daily")), 6)


def _records(spark, sf):
    d = model(spark, sf, "daily")
    z = d.select("zone_id").distinct()
    return snow.zone_records(d, z.withColumn("n_cells", 12 + F.col("zone_id")), z.withColumn("water_frac", (F.col("zone_id") % 10) / 15), DEFAULT)


@query("win11_selection_status", SEASON + " SELECT zone_id, sdc_status FROM st", D)
def win11(spark, sf):
    return _records(spark, sf).select("zone_id", "sdc_status")


CLASS = "SELECT c.zone_id, CASE WHEN value < 0.45 THEN 'low' WHEN value > 0.55 THEN 'high' ELSE 'mid' END AS sca_class FROM cur c JOIN rep USING (zone_id, wy) WHERE level = 5"


@query("win12_curve_class", SEASON + CLASS, D)
def win12(spark, sf):
    return snow.representative(snow.annual_curves(model(spark, sf, "daily"))).select("zone_id", snow.curve_class(F.col("curve")).alias("sca_class"))


@query("win13_zone_records", SEASON + f""" SELECT st.zone_id, sdc_status, CASE WHEN sdc_status = 'derived' THEN k.sca_class ELSE 'mid' END AS sca_class, round(similarity, 6) AS similarity, n_seasons, coalesce(n_peak_years, 0) AS n_peak_years,
 round(peak_swe_mm, 4) AS peak_swe_mm, round(cv_subgrid, 6) AS cv_subgrid, round(CASE WHEN sdc_status = 'derived' THEN v.s ELSE 5.5 END, 12) AS curve_sum
 FROM st LEFT JOIN ({CLASS}) k USING (zone_id) LEFT JOIN pks USING (zone_id) LEFT JOIN (SELECT zone_id, sum(value) AS s FROM cur JOIN rep USING (zone_id, wy) GROUP BY zone_id) v USING (zone_id)""", D)
def win13(spark, sf):
    d = _records(spark, sf).withColumn("curve_sum", F.aggregate("curve", F.lit(0.0), lambda a, x: a + x)).drop("curve")
    return r(r(r(d, 4, "peak_swe_mm"), 12, "curve_sum"), 6, "similarity", "cv_subgrid")


BINS = """SELECT p_partkey, p_retailprice + p_size AS cv FROM part"""


@query("win14_equal_bins", f"WITH v AS ({BINS}), k AS (SELECT *, row_number() OVER (ORDER BY cv, p_partkey) - 1 AS r, count(*) OVER () AS n FROM v) SELECT p_partkey, cv, CAST(floor(r * 8 / n) AS INTEGER) AS bin FROM k")
def win14(spark, sf):
    from tarnworks.core.io import table

    d = table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") + F.col("p_size")).alias("cv"))
    return snow.equal_bins(d, "cv", 8, "p_partkey")


@query("win15_quantile_calibration", """WITH v AS (SELECT p_partkey AS zone_id, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size / 50.0 END AS s, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice / 1000.0 END AS e FROM part)
 , q AS (SELECT unnest(range(0, 101)) / 100.0 AS q), x AS (SELECT q, (SELECT quantile_cont(s, list_transform(range(0, 101), lambda i: i / 100.0)) FROM v WHERE s IS NOT NULL AND e IS NOT NULL)[CAST(round(q * 100) AS INTEGER) + 1] AS x,
   (SELECT quantile_cont(e, list_transform(range(0, 101), lambda i: i / 100.0)) FROM v WHERE s IS NOT NULL AND e IS NOT NULL)[CAST(round(q * 100) AS INTEGER) + 1] AS y FROM q)
 , k AS (SELECT x, arg_min(y, q) AS y FROM x GROUP BY x)
 SELECT zone_id, round(CASE WHEN s IS NULL THEN NULL WHEN s < (SELECT min(x) FROM k) THEN (SELECT arg_min(y, x) FROM k) WHEN s >= (SELECT max(x) FROM k) THEN (SELECT arg_max(y, x) FROM k)
  ELSE a.y + (b.y - a.y) * (s - a.x) / (b.x - a.x) END, 6) AS cv_calibrated FROM v
 LEFT JOIN LATERAL (SELECT max(x) AS x, arg_max(y, x) AS y FROM k WHERE k.x <= v.s) a ON true LEFT JOIN LATERAL (SELECT min(x) AS x, arg_min(y, x) AS y FROM k WHERE k.x > v.s) b ON true""")
def win15(spark, sf):
    from tarnworks.core.io import table

    d = table(spark, sf, "part").selectExpr("p_partkey AS zone_id", "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size / 50.0D END AS cv_subgrid", "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice / 1000.0D END AS cv_empirical")
    out, _ = snow.quantile_calibration(d, mode="on")
    return r(out.select("zone_id", "cv_calibrated"), 6)


OWN = "SELECT cv_subgrid AS cv FROM st JOIN pks USING (zone_id) WHERE sdc_status = 'derived'"


@query("win16_reconstruction_error", SEASON + "," + lognormal_sql(OWN) + """ SELECT round(sum(s) / (11 * count(*)), 6) AS mean_error, round(quantile_cont(t, 0.95), 6) AS p95_error FROM (
 SELECT c.zone_id, sum(abs(c.value - lg.value)) AS s, max(abs(c.value - lg.value)) AS t FROM cur c JOIN rep USING (zone_id, wy) JOIN st USING (zone_id) JOIN pks USING (zone_id)
   JOIN lg ON lg.cv = cv_subgrid AND lg.level = c.level WHERE sdc_status = 'derived' GROUP BY c.zone_id)""", D)
def win16(spark, sf):
    rec = _records(spark, sf)
    return r(snow.reconstruction_error(rec.where("sdc_status = 'derived'"), "cv_subgrid", "curve"), 6)


LIBRARY = SEASON + "," + lognormal_sql(GRID) + f""", emp AS ({FITTED}),
 z AS (SELECT st.zone_id, sdc_status, n_seasons, similarity, cv_subgrid, peak_swe_mm, coalesce(n_peak_years, 0) AS n_peak_years, CASE WHEN sdc_status = 'derived' THEN k.sca_class ELSE 'mid' END AS sca_class,
   CASE WHEN sdc_status = 'derived' THEN cv_empirical END AS cv_empirical FROM st LEFT JOIN pks USING (zone_id) LEFT JOIN emp USING (zone_id) LEFT JOIN ({CLASS}) k USING (zone_id)),
 pair AS (SELECT cv_subgrid AS s, cv_empirical AS e FROM z WHERE cv_subgrid IS NOT NULL AND cv_empirical IS NOT NULL),
 qs AS (SELECT unnest(quantile_cont(s, list_transform(range(0, 101), lambda i: i / 100.0))) AS x, unnest(quantile_cont(e, list_transform(range(0, 101), lambda i: i / 100.0))) AS y, unnest(range(0, 101)) AS q FROM pair),
 kn AS (SELECT x, arg_min(y, q) AS y FROM qs GROUP BY x),
 cal AS (SELECT count(*) >= 2 AND abs(median(s) - median(e)) > 0.1 AND (SELECT count(*) FROM kn) >= 2 AS told FROM pair),
 lo AS (SELECT z.zone_id, max(x) AS x, arg_max(y, x) AS y FROM z JOIN kn ON x <= cv_subgrid GROUP BY z.zone_id),
 hi AS (SELECT z.zone_id, min(x) AS x, arg_min(y, x) AS y FROM z JOIN kn ON x > cv_subgrid GROUP BY z.zone_id),
 c AS (SELECT z.*, told, CASE WHEN NOT told OR cv_subgrid IS NULL THEN cv_subgrid WHEN lo.x IS NULL THEN hi.y WHEN hi.x IS NULL THEN lo.y ELSE lo.y + (hi.y - lo.y) * (cv_subgrid - lo.x) / (hi.x - lo.x) END AS cv_calibrated
   FROM z CROSS JOIN cal LEFT JOIN lo USING (zone_id) LEFT JOIN hi USING (zone_id)),
 a AS (SELECT *, coalesce(cv_calibrated, cv_empirical) AS cv_assign,
   CASE WHEN cv_calibrated IS NOT NULL THEN CASE WHEN told THEN 'subgrid_calibrated' ELSE 'subgrid' END WHEN cv_empirical IS NOT NULL THEN 'empirical' ELSE 'default_no_snow' END AS cv_source FROM c),
 bin AS (SELECT cv_assign, floor((row_number() OVER (ORDER BY cv_assign, zone_id) - 1) * 4 / count(*) OVER ()) AS bin FROM a WHERE cv_assign IS NOT NULL),
 lib AS (SELECT CAST(bin + 2 AS INTEGER) AS id, quantile_cont(cv_assign, 0.5) AS mid FROM bin GROUP BY bin),
 near AS (SELECT zone_id, arg_min(id, (abs(mid - cv_assign), id)) AS id FROM a, lib WHERE cv_assign IS NOT NULL GROUP BY zone_id),"""


@query("win17_library_parameters", LIBRARY + lognormal_sql("SELECT mid AS cv FROM lib", "lib_lg") + """
 SELECT a.zone_id, coalesce(near.id, 1) AS hru_deplcrv, round(CASE WHEN peak_swe_mm > 0 THEN peak_swe_mm / 25.4 ELSE 0 END, 4) AS snarea_thresh, round(cv_assign, 6) AS cv_assign, round(cv_subgrid, 6) AS cv_subgrid,
   round(cv_empirical, 6) AS cv_empirical, cv_source, sdc_status, sca_class, round(similarity, 6) AS similarity, n_seasons, n_peak_years, round(peak_swe_mm, 4) AS peak_swe_mm, round(coalesce(s, 5.5), 6) AS curve_sum
 FROM a LEFT JOIN near USING (zone_id) LEFT JOIN lib ON lib.id = near.id LEFT JOIN (SELECT cv, sum(value) AS s FROM lib_lg GROUP BY cv) v ON v.cv = lib.mid""", D)
def win17(spark, sf):
    d = snow.library_pipeline(_records(spark, sf), 4, DEFAULT)[1].withColumn("curve_sum", F.aggregate("curve", F.lit(0.0), lambda a, x: a + x)).drop("curve")
    return r(r(d, 4, "snarea_thresh", "peak_swe_mm"), 6, "cv_assign", "cv_subgrid", "cv_empirical", "similarity", "curve_sum")


@query("win18_yearly_merge", SEASON + " SELECT zone_id, date, wy FROM d", D)
def win18(spark, sf):
    from functools import reduce

    d = snow.with_water_year(model(spark, sf, "daily")).select("zone_id", "date", "wy")
    parts = [d.where(f"year(date) % 3 = {k}") for k in range(3)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("win19_best_year", SEASON + ", pe AS (SELECT zone_id, wy, max(swe) AS peak FROM d GROUP BY zone_id, wy) SELECT zone_id, arg_max(wy, (peak, -wy)) AS wy FROM pe JOIN (SELECT DISTINCT zone_id, wy FROM cur) USING (zone_id, wy) GROUP BY zone_id", D)
def win19(spark, sf):
    d = model(spark, sf, "daily")
    return snow.best_year(snow.annual_curves(d), d)


@query("agg52_status_shares", SEASON + " SELECT sdc_status, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM st GROUP BY sdc_status", D)
def agg52(spark, sf):
    return snow.status_shares(_records(spark, sf))


@query("jon13_nearest_curve", """WITH v AS (SELECT p_partkey AS zone_id, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size / CAST(25 AS DOUBLE) END AS cv FROM part),
 k AS (SELECT cv, floor((row_number() OVER (ORDER BY cv, zone_id) - 1) * 8 / count(*) OVER ()) AS bin FROM v WHERE cv IS NOT NULL),
 b AS (SELECT CAST(bin + 2 AS INTEGER) AS id, quantile_cont(cv, 0.5) AS mid FROM k GROUP BY bin)
 SELECT v.zone_id, v.cv, coalesce(arg_min(b.id, (abs(b.mid - v.cv), b.id)), 1) AS hru_deplcrv FROM v LEFT JOIN b ON v.cv IS NOT NULL GROUP BY v.zone_id, v.cv""")
def jon13(spark, sf):
    from tarnworks.core.io import table

    d = table(spark, sf, "part").selectExpr("p_partkey AS zone_id", "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size / 25.0D END AS cv")
    return snow.nearest_curve(d, snow.curve_library(d, 8, DEFAULT))


CVS = "SELECT p_size / CAST(25 AS DOUBLE) AS cv FROM part"


@query("scl07_lognormal_curve", f"WITH {lognormal_sql(CVS)} SELECT p_partkey, CAST(level AS INTEGER) AS level, round(value, 6) AS value FROM part JOIN lg ON lg.cv = p_size / CAST(25 AS DOUBLE)")
def scl07(spark, sf):
    from tarnworks.core.io import table

    return r(snow.lognormal_curves(table(spark, sf, "part").selectExpr("p_partkey", "p_size / 25.0D AS cv")).select("p_partkey", F.posexplode("curve").alias("level", "value")), 6)


@query("scl08_best_cv", SEASON + "," + lognormal_sql(GRID) + FITTED, D)
def scl08(spark, sf):
    return snow.best_cv(snow.representative(snow.annual_curves(model(spark, sf, "daily"))))


@query("scl09_valid_curves", SEASON + " SELECT zone_id, wy, true AS valid FROM cur GROUP BY zone_id, wy", D)
def scl09(spark, sf):
    return snow.annual_curves(model(spark, sf, "daily")).select("zone_id", "wy", scalar.valid_curve(F.col("curve")).alias("valid"))
