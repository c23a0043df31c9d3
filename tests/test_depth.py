"""Depth windows, lines and polygons on literal cases."""

import numpy as np
import pandas as pd
import plain_depth
from pyspark.sql import functions as F

from tarnworks.operators import depth, lines, vector
from tarnworks.operators import tables as t


def test_fill_window():
    z = np.full((5, 5), 5.0)
    z[1:4, 1:4] = 2.0
    z[2, 4] = 3.0  # the way out
    assert (plain_depth.fill_window(z)[1:4, 1:4] == 3).all()
    z[2, 2] = np.nan  # an outlet inside
    assert np.nanmax(plain_depth.fill_window(z)[1:4, 1:4]) == 2


def test_shore_distance_and_ring():
    inside = np.zeros((7, 7), bool)
    inside[2:5, 2:5] = True
    assert plain_depth.shore_distance(inside, 10.0) == 20.0
    z = np.add.outer(np.zeros(7), np.arange(7.0)) * 10
    assert np.isclose(plain_depth.ring_slope(z, inside, 10.0), 1.0)
    assert plain_depth.ring_slope(z, np.ones((7, 7), bool), 10.0) == 0.0


def test_depth_records(spark):
    rows = [(1, i, j, 5.0 if i in (0, 4) or j in (0, 4) else 2.0 + (i == 2 and j == 2), 0 < i < 4 and 0 < j < 4) for i in range(5) for j in range(5)]
    rows += [(2, i, j, 1.0, True) for i in range(3) for j in range(3)] + [(None, 0, 0, 1.0, True), (3, 0, 0, None, True)]
    d = spark.createDataFrame(rows, "comid long, row int, col int, value double, inside boolean")
    got = {r["comid"]: r for r in depth.depth_records(d, 10.0).collect()}
    assert got[1]["measured_max_m"] == 3.0 and not got[1]["flat"] and got[2]["flat"] and got[2]["mean_depth_m"] is None and got[3]["flat"]
    assert set(got) == {1, 2, 3}


def test_depth_records_are_the_plain_ones(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k, (n, m) in enumerate([(20, 90), (13, 9), (1, 6), (30, 30), (8, 8)]):
        z = rng.random((n, m)) * 5
        z[rng.random((n, m)) < 0.03] = np.nan
        inside = rng.random((n, m)) < (0.97 if k != 4 else 0)
        inside[:3] &= k == 2
        rows += [(k, i + 5, j - 3, float(z[i, j]) if k != 1 or j else None, bool(inside[i, j])) for i in range(n) for j in range(m) if k != 3 or (i + j) % 41]
    schema = "comid long, row int, col int, value double, inside boolean"
    frame = pd.DataFrame(rows, columns=["comid", "row", "col", "value", "inside"])
    want = pd.concat([plain_depth.polygon_record(g, 10.0) for _, g in frame.groupby("comid")]).set_index("comid")
    got = depth.depth_records(spark.createDataFrame(rows, schema).repartition(4), 10.0).toPandas().set_index("comid").loc[want.index]
    assert list(got["method"]) == list(want["method"]) and list(got["n_inside"]) == list(want["n_inside"])
    for c in ("mean_depth_m", "measured_max_m", "hollister_max_m", "range_m"):
        assert np.allclose(got[c].astype(float), want[c].astype(float), equal_nan=True), c


def test_batch_status(spark):
    d = spark.createDataFrame([(1, 0, 0, 1.0, True), (2, 0, 0, float("nan"), True), (3, 0, 0, 1.0, None)], "comid long, row int, col int, value double, inside boolean")
    p = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (None,)], "comid long")
    assert tuple(depth.batch_status(p, d).first()) == (4, 1, 2, 0.25, True)
    assert tuple(depth.batch_status(p.limit(0), d).first()) == (0, 0, 0, None, False)


def test_depth_fill_ladder(spark):
    rows = [(1, "LakePond", "17", 1.0, 3.0, False), (2, "LakePond", "17", 2.0, 3.0, False), (3, "LakePond", "17", None, 3.0, True), (4, "LakePond", "9", None, 3.0, True), (5, "Playa", "2", None, None, True), (6, "LakePond", "17", 900.0, 3.0, False)]
    d = spark.createDataFrame(rows, "comid long, ftype string, ecoregion string, dprst_depth_m double, hollister_max_m double, flat boolean")
    got = {r["comid"]: (r["method"], round(r["depth_m"], 3)) for r in t.fill_depths(d, t.donor_models(d)).collect()}
    assert got[1] == ("measured", 1.0) and got[3] == ("ecoregion_median", 2.0) and got[4] == ("ftype_median", 2.0)
    assert got[5] == ("constant_floor", round(49 / 39.3701, 3)) and got[6] == ("measured_capped", round(300 / 39.3701, 3))


def ring(spark, zone, points):
    return [(zone, *map(float, (*a, *b))) for a, b in zip(points, (*points[1:], points[0]))]


E = "zone_id long, x1 double, y1 double, x2 double, y2 double"


def test_coverage_of_slanted_polygons_and_holes(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for z in range(8):
        angle = np.sort(rng.random(7)) * 2 * np.pi
        pts = [(4 + 3.5 * rng.uniform(0.3, 1) * np.cos(a), 4 + 3.5 * rng.uniform(0.3, 1) * np.sin(a)) for a in angle]
        rows += ring(spark, z, pts)
        x, y = np.array(pts).T
        want[z] = abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2
    hole = [(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (1, 3), (3, 3), (3, 1)]
    rows += ring(spark, 99, hole[0]) + ring(spark, 99, hole[1])
    want[99] = 12.0
    c = vector.coverage(spark.createDataFrame(rows, E))
    got = {r["zone_id"]: r["s"] for r in c.groupBy("zone_id").agg(F.sum("w").alias("s")).collect()}
    assert all(np.isclose(got[z], want[z]) for z in want)
    assert c.where("w > 1 + 1e-9").count() == 0 and c.where("zone_id = 99 AND row = 1 AND col = 1").count() == 0


def test_overlap_areas_and_lengths(spark):
    a = spark.createDataFrame(ring(spark, 1, [(0, 0), (4, 0), (0, 4)]) + ring(spark, 2, [(10, 0), (12, 0), (12, 2), (10, 2)]), E)
    b = spark.createDataFrame(ring(spark, 7, [(0, 0), (2, 0), (2, 2), (0, 2)]) + ring(spark, 8, [(3, 3), (5, 3), (5, 5), (3, 5)]), E)
    got = [(r["zone_id"], r["source"], round(r["area"], 9)) for r in lines.overlap_areas(a, b, size=2.0).collect()]
    assert got == [(1, 7, 4.0)]
    line = spark.createDataFrame([(1, 0, -1.0, 1.0, 5.0, 1.0), (2, 0, 0.5, 0.5, 1.0, 1.0), (3, 0, -1.0, 0.0, 6.0, 0.0), (4, 0, 4.0, 4.0, 5.0, 4.0)], "line_id long, seq int, x1 double, y1 double, x2 double, y2 double")
    got = {r["line_id"]: round(r["overlap"], 9) for r in lines.overlap_lengths(line, a, size=2.0).where("zone_id = 1").collect()}
    assert got == {1: 3.0, 2: round(0.5**0.5, 9), 3: 4.0}  # line 3 runs along the shore


def test_overlap_areas_of_holes_shores_and_random_triangles(spark):
    rng = np.random.default_rng(8)
    square = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    a = ring(spark, 1, square(0, 0, 6)) + ring(spark, 1, square(2, 2, 2)[::-1]) + ring(spark, 2, square(6, 0, 2))
    b = ring(spark, 7, square(1, 1, 4)[::-1]) + ring(spark, 8, square(0, 0, 6)) + ring(spark, 9, square(2, 2, 2))
    want = {(1, 7): 12.0, (1, 8): 32.0}
    tri = rng.random((12, 3, 2)) * 4 + 20
    inside = lambda t, p: len({np.sign((t[i][0] - t[i - 1][0]) * (p[1] - t[i - 1][1]) - (t[i][1] - t[i - 1][1]) * (p[0] - t[i - 1][0])) for i in range(3)}) == 1
    for i in range(6):
        a, b = a + ring(spark, 20 + i, tri[i].tolist()), b + ring(spark, 40 + i, tri[6 + i].tolist())
    g = (np.arange(240) + 0.5) / 60 + 20
    masks = [np.array([[inside(t, (x, y)) for x in g] for y in g]) for t in tri]
    got = {(r["zone_id"], r["source"]): r["area"] for r in lines.overlap_areas(spark.createDataFrame(a, E), spark.createDataFrame(b, E), size=2.0).collect()}
    assert {k: round(v, 9) for k, v in got.items() if k[0] < 20} == want
    for i in range(6):
        for j in range(6):
            assert abs(got.get((20 + i, 40 + j), 0.0) - (masks[i] & masks[6 + j]).sum() / 3600) < 0.05


def test_batches_keep_all(spark):
    rng = np.random.default_rng(1)
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((100, 2)))] + [(200 + i, 0.5, 0.5) for i in range(30)], "zone_id long, x double, y double")
    b = vector.spatial_batches(p, 20).toPandas()
    assert len(b) == 130 and b["zone_id"].is_unique and sorted(b["batch_id"].unique()) == list(range(b["batch_id"].nunique()))
    assert vector.spatial_batches(p, 500).select("batch_id").distinct().count() == 1


def test_nearest_far_away(spark):
    d = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0)], "zone_id long, x double, y double")
    m = spark.createDataFrame([(9, 500.0, 500.0), (8, 0.4, 0.4)], "zone_id long, x double, y double")
    got = sorted(tuple(r)[:3] for r in vector.nearest(m, d, 2).select("zone_id", "rank", "donor").collect())
    assert got == [(8, 1, 1), (8, 2, 2), (9, 1, 2), (9, 2, 1)]


def test_lower_envelope_against_all_places():
    rng = np.random.default_rng(9)
    for n in (1, 2, 3, 17, 60):
        for top in (2, 40, 5000):
            h = [int(x) for x in rng.integers(0, top, n)]
            assert depth.farthest(h) == max(min(v + (q - p) ** 2 for p, v in enumerate(h)) for q in range(n))
    flat = [10**8] * 20_000  # a wide column: each place looks at all others no more
    flat[0] = flat[-1] = 0
    assert depth.farthest(flat) == 9999**2


def test_depth_job_holds_faults_as_data(spark):
    def window(comid, resolution, value=lambda i, j: 5.0 if i in (0, 4) or j in (0, 4) else 2.0):
        return [(comid, resolution, i, j, str(value(i, j)), 0 < i < 4 and 0 < j < 4) for i in range(5) for j in range(5)]

    bowl = lambda i, j: 5.0 if i in (0, 4) or j in (0, 4) else 2.0 + (i == 2 and j == 2)
    rows = window(1, "1m", bowl) + window(2, "10m", bowl) + window(3, "1m", bowl) + window(4, "10m") + [(4, "10m", 2, 2, "oops", True)]
    rows += window(5, "10m", lambda i, j: "oops" if i == j == 2 else 1.0) + window(6, "10m") + [(6, "10m", None, 1, "1.0", True)]
    rows += window(7, "10m", bowl) + [(7, "10m", 10**8, 2, "1.0", True)] + window(8, "10m", lambda i, j: "NaN") + window(1, "10m", lambda i, j: "oops")
    cells = spark.createDataFrame(rows, "comid long, resolution string, row int, col int, value string, inside boolean")
    asked = [(1, "1m"), (1, "10m"), (2, "1m"), (3, "10m"), (4, "10m"), (5, "10m"), (6, None), (7, "10m"), (8, "10m"), (9, "1m"), (None, "1m")]
    job = depth.depth_job(spark.createDataFrame(asked, "comid long, resolution string"), cells)
    got = {r["comid"]: r for r in job.collect()}
    assert set(got) == set(range(1, 10)) and len(got) == job.count()
    assert {k: r["status"] for k, r in got.items()} == {1: "done", 2: "done", 3: "read_failure", 4: "compute_error", 5: "compute_error", 6: "compute_error", 7: "compute_error", 8: "done", 9: "read_failure"}
    assert [got[k]["fault"] for k in (1, 3, 4, 5, 6)] == [None, "no window", "a cell twice", "a value that is no number", "a cell without a place"]
    assert got[7]["fault"].startswith("ValueError: a strip of") and got[7]["mean_depth_m"] is None
    assert [got[k]["resolution"] for k in (1, 2, 3, 9)] == ["1m", "10m", None, None]
    alone = depth.depth_records(cells.where("comid = 1 AND resolution = '1m'"), 10.0).first()
    for c in ("mean_depth_m", "measured_max_m", "hollister_max_m", "range_m", "n_inside", "flat", "method"):
        assert got[1][c] == got[2][c] and (got[1][c] == alone[c] or np.isclose(got[1][c], alone[c])), c
    assert got[8]["flat"] and got[8]["n_inside"] == 0
    assert tuple(depth.job_summary(job).first()) == (9, 2, 4, 1, 3 / 9, True)
    none = depth.depth_job(spark.createDataFrame([], "comid long, resolution string"), cells)
    assert none.count() == 0 and tuple(depth.job_summary(none).first()) == (0, 0, 0, 0, None, False)
