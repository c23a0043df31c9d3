"""Nearest donors, near polygons, self-crossing rings and differences against plain versions."""

import itertools
import math

import numpy as np
import pytest

from tarnworks.operators import catalog, cells, flow, lines, ranks, tables, vector, zonal

E = "zone_id long, x1 double, y1 double, x2 double, y2 double"
P = "zone_id long, x double, y double"


def ring(zone, xy):
    return [(zone, *map(float, a), *map(float, b)) for a, b in zip(xy, [*xy[1:], xy[0]])]


def box(zone, x, y, w=1.0, h=1.0):
    return ring(zone, [(x, y), (x + w, y), (x + w, y + h), (x, y + h)])


@pytest.mark.parametrize("k", [1, 4])
def test_nearest_against_all_distances(spark, k):
    rng = np.random.default_rng(1)
    xy = np.concatenate([rng.uniform(0, 100, (150, 2)), rng.normal(50, 1e-4, (120, 2)), np.full((40, 2), 7.0), rng.integers(0, 9, (60, 2))])
    donors = [(i, float(x), float(y)) for i, (x, y) in enumerate(xy)]
    far = [(-5e6, 3e6), (1e9, 50.0), (50.0, -2000.0), (100.0, 100.0), (0.0, 0.0)]
    rows = [(1000 + i, float(x), float(y)) for i, (x, y) in enumerate([*rng.uniform(-20, 120, (80, 2)), *rng.normal(50, 1e-4, (20, 2)), *far, (7.0, 7.0)])]
    odd = [(2000, None, 1.0), (2001, 1.0, float("nan"))]
    got = vector.nearest(spark.createDataFrame(rows + odd, P), spark.createDataFrame(donors + [(-1, None, None), (-2, float("nan"), 0.0)], P), k)
    found = {}
    for r in got.collect():
        found.setdefault(r["zone_id"], []).append((r["rank"], r["donor"], r["distance"]))
    assert sorted(found) == sorted(i for i, *_ in rows)
    for i, x, y in rows:
        want = sorted((math.sqrt((x - a) ** 2 + (y - b) ** 2), d) for d, a, b in donors)[:k]
        assert [(d, round(s, 6)) for _, d, s in sorted(found[i])] == [(d, round(s, 6)) for s, d in want]


def test_few_donors_and_none(spark):
    d, m = spark.createDataFrame([(1, 0.0, 0.0)], P), spark.createDataFrame([(2, 3.0, 4.0)], P)
    assert [tuple(r) for r in vector.nearest(m, d, 3).collect()] == [(2, 1, 1, 5.0)]
    assert vector.nearest(m.limit(0), d, 3).count() == 0
    with pytest.raises(ValueError, match="no donor"):
        vector.nearest(m, d.limit(0))


def test_places_without_coordinates_stay_null(spark):
    params = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None), (4, None)], "zone_id long, a double")
    places = spark.createDataFrame([(1, 0.0, 0.0), (2, 9.0, 0.0), (3, 8.0, 0.0), (4, None, None)], P)
    assert sorted((r["zone_id"], r["a"]) for r in tables.fill_gaps(params, places, ["a"]).collect()) == [(1, 10.0), (2, 20.0), (3, 20.0), (4, None)]


def parts(pairs, ids):
    up = {i: i for i in ids}
    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_near_links_join_what_is_near(spark):
    rng = np.random.default_rng(2)
    at = [(i, float(x), float(y), float(w), float(h)) for i, (x, y, w, h) in enumerate(zip(*rng.uniform(0, 60, (2, 70)), *rng.uniform(0.2, 6, (2, 70))))]
    at += [(100 + i, 80.0, 80.0, 2.0, 2.0) for i in range(60)] + [(200, 79.0, 79.0, 9.0, 9.0), (201, 83.0, 85.0, 0.5, 0.5), (202, 95.0, 80.0, 1.0, 1.0)]  # copies, one around them, one inside that, one apart
    edges = [x for b in at for x in box(*b)]
    gap = lambda p, q: math.hypot(max(0, p[1] - q[1] - q[3], q[1] - p[1] - p[3]), max(0, p[2] - q[2] - q[4], q[2] - p[2] - p[4]))
    near = [(p[0], q[0]) for p, q in itertools.combinations(at, 2) if gap(p, q) <= 1.3]
    got = [tuple(r) for r in lines.near_links(spark.createDataFrame(edges, E), 1.3, size=2.0).collect()]
    ids = [b[0] for b in at]
    assert set(got) <= {tuple(sorted(x)) for x in near} and parts(got, ids) == parts(near, ids)
    assert sum(a >= 100 and b < 200 for a, b in got) < 3 * 60  # copies do not pair up


def test_one_key_a_seed(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(600)], "a long, b long")
    got = flow.transitive_reach(spark.range(300).withColumnRenamed("id", "seed"), links, spark.range(300, 601).withColumnRenamed("id", "key"))
    assert {(r["seed"], r["key"]) for r in got.collect()} == {(i, 300) for i in range(300)}


def test_self_crossings(spark):
    rows = box(1, 0, 0) + ring(2, [(0, 0), (2, 2), (2, 0), (0, 2)]) + ring(3, [(0, 0), (40, 0), (40, 9), (30, -1), (20, 9), (10, -1), (0, 9)]) + ring(4, [(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)]) + box(5, 0, 0) + box(5, 3, 3)
    got = {r["zone_id"]: r["n_crossings"] for r in lines.self_crossings(spark.createDataFrame(rows, E), size=1.5).collect()}
    assert got == {2: 1, 3: 4, 4: 2}  # 4: a corner on another edge
    s = {r["zone_id"]: (r["n_edges"], r["unclosed"], r["n_crossings"]) for r in catalog.ring_screening(spark.createDataFrame(rows[:-1], E)).collect()}
    assert s[1] == (4, False, 0) and s[2] == (4, False, 1) and s[5] == (7, True, 0)


def test_deviation_far_from_zero_and_weighted_quantiles(spark):
    rows = [(1, 1e8 + v, 1.0) for v in (0.0, 0.1, 0.2, 0.3)] + [(2, float(i % 100), 1.0) for i in range(5000)] + [(3, None, 1.0), (None, 4.0, 2.0), (4, 1.0, 0.2), (4, 2.0, 0.3), (4, 9.0, 0.5)]
    got = {r["zone_id"]: r for r in zonal.continuous(spark.createDataFrame(rows, "zone_id long, value double, w double").repartition(5)).collect()}
    assert abs(got[1]["std"] - 0.1118034) < 1e-6
    assert (got[2]["p25"], got[2]["p50"], got[2]["p75"], got[2]["count"]) == (24.0, 49.0, 74.0, 5000.0)
    assert got[3]["count"] == 0 and got[3]["p50"] is None and got[3]["std"] is None
    assert (got[None]["p50"], got[None]["std"]) == (4.0, 0.0)
    assert (got[4]["p25"], got[4]["p50"], got[4]["p75"]) == (2.0, 2.0, 9.0)
    w = spark.createDataFrame([(1, 0, c, 1.0) for c in range(4)] + [(2, 0, 0, 1.0), (2, 0, 1, 0.5)], "zone_id long, row int, col int, w double")
    g = spark.createDataFrame([("a", 0, c, 1e8 + c / 10, float(c)) for c in range(4)], "date string, row int, col int, s double, t double")
    s = {r["zone_id"]: (r["s_masked_std"], r["t_masked_std"]) for r in zonal.series(w, g, ["s", "t"]).collect()}
    assert abs(s[1][0] - 0.1118034) < 1e-6 and abs(s[1][1] - 1.118034) < 1e-6 and abs(s[2][0] - 0.0471405) < 1e-6


def test_quantiles_of_one_group_over_many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        v = spark.range(4000).selectExpr("CAST(id AS DOUBLE) AS v", "CAST(1 + id % 3 AS DOUBLE) AS n", "1 AS g")
        got = ranks.weighted_quantiles(v, "v", "n", [0.1, 0.5, 1.0], ["g"]).first()["q"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    up = np.cumsum(1 + np.arange(4000) % 3)
    assert got == [float(np.argmax(up >= q * up[-1] - 1e-6)) for q in (0.1, 0.5, 1.0)]


def test_difference_percentiles(spark):
    a = spark.createDataFrame([(0, c, 1, float(c)) for c in range(101)], "row int, col int, region int, value double")
    r = cells.difference_statistics(a, a.selectExpr("row", "col", "0.0D AS value")).first()
    assert (r["p1"], r["p50"], r["p95"], r["p99"], r["n"]) == (1.0, 50.0, 95.0, 99.0, 101)
