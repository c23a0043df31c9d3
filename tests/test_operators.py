"""Literal cases of single operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plain_depth import fill_window
from tarnworks.core import checks
from tarnworks.core.graph import connected_components
from tarnworks.functions import scalar
from tarnworks.operators import cells, cover, flow, flux, snow, zonal
from tarnworks.sources import scans, sinks

LINE = [round(1 - i / 10, 1) for i in range(11)]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_class_percentages(spark):
    hist = spark.createDataFrame([(101, 0, 10.0), (101, 1, 30.0), (101, 3, 60.0), (102, 0, 0.0), (102, 1, 50.0), (102, 3, 50.0)], "zone_id long, lu_code int, n double")
    assert rows(cover.class_percentages(hist), "zone_id", "lu_code", "perc") == [(101, 0, 10.0), (101, 1, 30.0), (101, 3, 60.0), (102, 1, 50.0), (102, 3, 50.0)]


CROSS = "lu_code int, lu_desc string, nhm_cov_type int, srain_intcp double, wrain_intcp double, snow_intcp double, nhm_covden_win double, evergreen_retention double"


def test_crosswalk_guards(spark):
    good = [(0, "a", 0, 0.0, 0.0, 0.0, 1.0, 0.0)]
    with pytest.raises(ValueError):
        scans.checked_crosswalk(spark.createDataFrame(good, CROSS).drop("snow_intcp"))
    with pytest.raises(ValueError):
        scans.checked_crosswalk(spark.createDataFrame(good * 2, CROSS))


@pytest.mark.parametrize(
    "shares, expected",
    [
        ({0: 92.0, 3: 8.0}, 0), ({3: 25.0, 1: 75.0}, 3), ({2: 22.0, 1: 78.0}, 2), ({2: 18.0, 3: 18.0, 1: 64.0}, 3), ({2: 19.0, 3: 17.0, 1: 64.0}, 2),
        ({1: 55.0, 0: 45.0}, 1), ({1: 45.0, 0: 45.0, 2: 10.0}, 0), ({4: 80.0, 1: 20.0}, 4),
    ],
)
def test_cover_type(spark, shares, expected):
    perc = spark.createDataFrame([(1, k, v) for k, v in shares.items()], "zone_id long, lu_code int, perc double")
    cw = spark.createDataFrame([(k, str(k), k, 0.1, 0.2, 0.3, 0.5, 0.4) for k in range(5)], CROSS)
    assert rows(cover.cover_type(perc, cw), "zone_id", "cov_type") == [(1, expected)]


def daily(spark, swe, sca=None, start=1):
    sca = sca or [None if v is None else min(1.0, v / 10) for v in swe]
    return spark.createDataFrame([(1, f"2001-03-{start + i:02d}", None if s is None else float(s), None if c is None else float(c)) for i, (s, c) in enumerate(zip(swe, sca))], "zone_id long, date string, swe double, sca double").withColumn("date", F.to_date("date"))


def test_melt_trim(spark):
    assert [r[1] for r in rows(snow.melt_seasons(daily(spark, [1, 3, 10, 6, 2, 0, 0, 4])), "day", "swe")] == [10, 6, 2, 0]
    assert [r[1] for r in rows(snow.melt_seasons(daily(spark, [3, 10, 9, None, 6, 0])), "day", "swe")][0] == 10
    assert snow.melt_seasons(daily(spark, [10, 6, 2, 0])).count() == 0
    assert snow.melt_seasons(daily(spark, [1, 10, 6, 2])).count() == 0


def test_reversals(spark):
    season = spark.createDataFrame([(1, 2001, i + 1, 1.0, v) for i, v in enumerate([1.0, 0.6, 0.9, 0.4, 0.0])], "zone_id long, wy int, day int, swe double, sca double")
    assert [r[1] for r in rows(snow.without_reversals(season), "day", "sca")] == [1.0, 0.6, 0.4, 0.0]


def test_selection_and_class(spark):
    d = spark.createDataFrame([(True, 20, 0.1, 0.9, 0.1, 0.05), (True, 3, 0.1, 0.9, 0.1, 0.05), (False, 20, 0.1, 0.9, 0.1, 0.05), (True, 20, 0.1, 0.9, 0.1, None)], "has_snow boolean, n_cells int, water_frac double, sca_max double, constant_frac double, similarity double")
    assert [r[0] for r in d.select(snow.selection_status()).collect()] == ["derived", "default_too_few_cells", "default_no_snow", "default_dissimilar"]


def test_lognormal_curve():
    c = snow.lognormal_curve([0.1, 0.5, 1.5])
    assert c.shape == (3, 11) and (c[:, 0] == 1).all() and (c[:, -1] < 1e-6).all()
    assert (abs(c[:, :-1]) >= c[:, 1:] - 1e-9).all() and c[0, 5] > c[1, 5] > c[2, 5]


def chain(spark, codes, width):
    r = [(i // width, i % width, c) for i, c in enumerate(codes)]
    return flow.pointers(spark.createDataFrame(r, "row int, col int, code int"), width)


def cell(spark, ids, label=None):
    return spark.createDataFrame([(i, label or 1) for i in ids], "cell long, label long")


def test_d8_reach(spark):
    none = cell(spark, [99])
    assert rows(flow.downstream_reach(chain(spark, [1, 1, 1, 255], 4), cell(spark, [3]), none), "cell", "drains") == [(0, 1), (1, 1), (2, 1), (3, 1)]
    assert rows(flow.downstream_reach(chain(spark, [16, 16, 16, 255], 4), cell(spark, [3]), none), "cell", "drains") == [(0, 0), (1, 0), (2, 0), (3, 1)]
    got = flow.downstream_reach(chain(spark, [1, 4, 64, 16], 2), none, none)
    assert rows(got, "drains", "cyclic") == [(0, True)] * 4
    both = flow.downstream_reach(chain(spark, [1, 1, 1, 255], 4), cell(spark, [2]), cell(spark, [2]))
    assert rows(both, "cell", "drains") == [(0, 1), (1, 1), (2, 1), (3, 0)]


def test_own_terminus_within_window(spark):
    # Out along the first row, back along the second: both ends in one polygon.
    ptr = chain(spark, [*[1] * 8, 4, 255, *[16] * 8], 9)
    ends = flow.path_ends(ptr, cell(spark, [9]), width=9)
    polygon = spark.createDataFrame([(0, 5), (9, 5)], "cell long, comid long")
    share = lambda **limit: rows(flow.own_terminus_share(ends, polygon, **limit), "comid", "share")
    assert share() == [(5, 1.0)] and share(pad=8, width=9) == [(5, 1.0)] and share(pad=7, width=9) == [(5, 0.5)]


def test_accumulation(spark):
    assert rows(flow.flow_accumulation(chain(spark, [1, 1, 1, 255], 4)), "cell", "upslope") == [(0, 0), (1, 1), (2, 2), (3, 3)]


def test_fill(spark):
    z = [(i // 3, i % 3, v) for i, v in enumerate([5.0, 5.0, 5.0, 5.0, 1.0, 3.0, 5.0, 5.0, 5.0])]
    got = flow.fill_depressions(spark.createDataFrame(z, "row int, col int, value double"))
    assert [r for r in rows(got, "row", "col", "depth") if r[2]] == [(1, 1, 2.0)]


def test_ratio_rules(spark):
    num = spark.createDataFrame([(1, 5.0), (2, 3.0), (3, 9.0)], "zone_id long, count double")
    den = spark.createDataFrame([(1, 10.0), (2, 0.0), (3, 6.0), (4, 2.0)], "zone_id long, count double")
    assert rows(zonal.ratio(num, den), "zone_id", "ratio") == [(1, 0.5), (2, 0.0), (3, 1.0), (4, 0.0)]
    assert rows(zonal.ratio(num, den, clamp=False), "zone_id", "ratio")[2] == (3, 1.5)


def test_area_weighted_mean(spark):
    grid = spark.createDataFrame([(d, i, j, float(v), float(10 * v)) for d in (0, 1) for i in range(4) for j in range(4) for v in [1 if d == 0 else (2 if j < 2 else 0)]], "date int, row int, col int, swe double, x double")
    w = spark.createDataFrame([(1 + (j >= 2), i, j, 1.0) for i in range(4) for j in range(4)], "zone_id long, row int, col int, w double")
    got = zonal.series(w, grid, ["swe", "x"])
    assert rows(got, "date", "zone_id", "swe_masked_mean", "x_masked_mean") == [(0, 1, 1.0, 10.0), (0, 2, 1.0, 10.0), (1, 1, 2.0, 20.0), (1, 2, 0.0, 0.0)]


def test_rescale_without_spread(spark):
    d = spark.createDataFrame([(1, 2.0), (2, 2.0)], "zone_id long, p double")
    assert rows(flux.rescale(d, {"p": (0.0, 1.0)}), "zone_id", "p") == [(1, 0.5), (2, 0.5)]


def test_components_in_one_task_and_in_rounds(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (3, 3), (7, 9)], "a long, b long")
    want = [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7)]
    assert rows(connected_components(edges), "node", "component") == want
    assert rows(connected_components(edges, small=0), "node", "component") == want
    path = spark.range(0, 300).selectExpr("id AS a", "id + 1 AS b")
    assert rows(connected_components(path, small=0), "component") == [(0,)] * 301


def test_checks(spark):
    d = spark.createDataFrame([("1",), ("x",)], "k string")
    with pytest.raises(ValueError):
        checks.strict_cast(d, "k", "bigint")
    with pytest.raises(ValueError):
        checks.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")
    ids = spark.createDataFrame([(1,), (4,)], "id long")
    assert rows(checks.missing_ids(ids, "id"), "id") == [(2,), (3,)]


def test_library_sink(spark):
    lib = spark.createDataFrame([(1, LINE), (2, LINE)], "deplcrv_id int, curve array<double>")
    flat = rows(sinks.flatten_library(lib), "ndeplval", "value")
    assert len(flat) == 22 and flat[0] == (0, 0.0) and flat[10] == (10, 1.0)
    with pytest.raises(ValueError):
        sinks.flatten_library(lib.where("deplcrv_id = 2"))


def test_scalars(spark):
    d = spark.createDataFrame([(45.0, 25.4, None)], "a double, b double, c double")
    r = d.select(scalar.degrees_to_fraction(F.col("a")), scalar.threshold_inches(F.col("b")), scalar.threshold_inches(F.col("c")), scalar.radiation_transmission(F.col("c"))).first()
    assert math.isclose(r[0], 1) and r[1] == 1 and r[2] == 0 and math.isclose(r[3], 0.9917)
    t = spark.createDataFrame([("3",), ("03N",), ("10U",), ("17",)], "v string").select(scalar.region_code(F.col("v"))).collect()
    assert [x[0] for x in t] == ["03", "03", "10", "17"]


def test_sorted_sink_and_publish(spark, tmp_path):
    d = spark.createDataFrame([(3, 1), (1, None), (2, 5)], "id long, v int")
    sinks.write_sorted(d, "id", str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3
    filled = d.withColumn("v", F.coalesce(F.col("v").cast("double"), F.lit(2.2)))
    sinks.publish_filled(d, filled, str(tmp_path / "f"), str(tmp_path / "raw"))
    old = sinks.published(spark, str(tmp_path / "f"))
    assert dict(old.dtypes)["v"] == "int"
    sinks.publish_filled(d.where("id < 2"), filled.where("id < 3").withColumn("v", F.lit(9)), str(tmp_path / "f"), str(tmp_path / "raw"))
    assert [r["v"] for r in sinks.published(spark, str(tmp_path / "f")).collect()] == [9, 9]
    assert sorted(r["v"] for r in old.collect()) == [1, 2, 5]  # an open reader keeps its version
    assert spark.read.parquet(str(tmp_path / "raw")).where("v IS NULL").count() == 1


def test_empty_inputs(spark):
    cells_ = spark.createDataFrame([], "zone_id long, class int, w double, value double")
    assert zonal.continuous(cells_).count() == 0 and zonal.dominant(zonal.histogram(cells_)).count() == 0
    g = spark.createDataFrame([], "row int, col int, value double")
    assert cells.flow_pointer(g).count() == 0 and flow.regions(g, 10).count() == 0


def test_reach_and_fill_have_no_silent_limit(spark):
    chain = spark.range(260).selectExpr("id AS a", "id + 1 AS b")
    seeds, keys = spark.createDataFrame([(0,), (900,)], "seed long"), spark.createDataFrame([(259,), (260,), (900,), (901,)], "key long")
    assert rows(flow.transitive_reach(seeds, chain, keys), "seed", "key") == [(0, 259), (900, 900)]
    # A low channel of four cells to the edge of the table.
    pit = [(i, j, 1.0 if i == 2 and j > 0 else 9.0) for i in range(5) for j in range(6)]
    d = spark.createDataFrame(pit, "row int, col int, value double")
    assert {r["filled"] for r in flow.fill_depressions(d).where("row = 2 AND col > 0").collect()} == {1.0}
    # Three pits in a row behind each other: one contraction does not empty them.
    row = [9.0, 1.0, 5.0, 2.0, 6.0, 3.0, 4.0, 0.0, 7.0, 9.0]
    d = spark.createDataFrame([(i, j, row[j] if i == 2 else 9.0) for i in range(5) for j in range(10)], "row int, col int, value double")
    with pytest.raises(RuntimeError):
        flow.fill_depressions(d, rounds=1)


def test_fill_is_the_priority_flood(spark):
    rng = np.random.default_rng(5)
    grids = {1: rng.integers(0, 6, (17, 23)).astype(float), 2: rng.random((9, 30)), 3: np.full((6, 6), 2.0), 4: rng.integers(0, 90, (25, 25)).astype(float)}
    grids[2][rng.random((9, 30)) < 0.08] = np.nan
    grids[3][2:4, 2:4] = 1.0
    cells_ = [(k, i, j, None if np.isnan(v) else float(v)) for k, g in grids.items() for (i, j), v in np.ndenumerate(g)]
    d = spark.createDataFrame(cells_, "comid long, row int, col int, value double").repartition(5)
    got = {tuple(r)[:3]: r["filled"] for r in flow.fill_depressions(d, by=("comid",)).collect()}
    want = {(k, i, j): v for k, g in grids.items() for (i, j), v in np.ndenumerate(fill_window(g)) if not np.isnan(v)}
    assert got == want


def test_a_template_grid_named_twice_raises(spark):
    from tarnworks.operators import masks

    grid = lambda name, width: (name, "m", width, 4, 30.0, 0.0, 0.0, 0.0, -30.0, 0.0)
    schema = "grid_id string, crs string, width int, height int, a double, b double, c double, d double, e double, f double"
    once = spark.createDataFrame([grid("t", 5), grid("u", 6), grid("v", 5)], schema)
    assert [tuple(r) for r in masks.grid_mismatches(once, "t").collect()] == [("u", "width")]
    with pytest.raises(ValueError, match="named twice"):
        masks.grid_mismatches(once.unionByName(once), "t").collect()
