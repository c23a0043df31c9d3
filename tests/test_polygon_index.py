"""The polygon cover against counting every edge, and its growth."""

import numpy as np
import pytest

from tarnworks.operators import polygon_index, vector

E = "zone_id long, x1 double, y1 double, x2 double, y2 double"
P = "point_id long, x double, y double, zone string"


def ring(zone, xy):
    return [(zone, *map(float, a), *map(float, b)) for a, b in zip(xy, [*xy[1:], xy[0]])]


def plain(points, edges):
    out = []
    for i, x, y, *_ in points:
        if x is None or y is None:
            continue
        odd = {}
        for z, x1, y1, x2, y2 in edges:
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd[z] = not odd.get(z, False)
        out += [(i, z) for z, o in odd.items() if o]
    return sorted(out)


def shapes(rng):
    edges = ring(1, [(0, 0), (8, 0), (8, 8), (0, 8)]) + ring(1, [(2, 2), (2, 6), (6, 6), (6, 2)])  # a hole; all on cell bounds
    edges += ring(2, [(-40.3, -30.1), (55.2, -29.9), (60.1, 41.7), (10.0, 70.0), (-44.4, 39.0)])  # large, many inside cells
    for z in range(3, 25):  # stars of random size and place, some smaller than a cell
        n, c, r = rng.integers(3, 12), rng.uniform(-40, 60, 2), rng.choice([0.2, 1.5, 9.0])
        t = np.sort(rng.uniform(0, 2 * np.pi, n))
        edges += ring(z, [tuple(c + r * rng.uniform(0.3, 1) * np.array([np.cos(a), np.sin(a)])) for a in t])
    edges += ring(30, [(i % 40 - 20, i // 40 * 3 - 20 + (i % 2)) for i in range(80)])  # thin and jagged, corners on bounds
    edges += ring(31, [(5, 5), (9, 9), (5, 9), (9, 5)])  # crosses itself
    return edges


@pytest.mark.parametrize("size", [1.0, 0.37, 30.0])
def test_points_are_those_of_every_edge(spark, size):
    rng = np.random.default_rng(1)
    edges = shapes(rng)
    points = [(i, float(x), float(y), "z") for i, (x, y) in enumerate(rng.uniform(-50, 75, (1500, 2)))]
    points += [(2000 + i, float(x), float(y), "z") for i, (x, y) in enumerate(rng.integers(-22, 24, (800, 2)))]  # corners and bounds
    points += [(4000 + i, e[1], e[2], "z") for i, e in enumerate(edges)] + [(5000 + i, (e[1] + e[3]) / 2, (e[2] + e[4]) / 2, "z") for i, e in enumerate(edges)]
    points += [(9000, None, 1.0, "z"), (9001, 1.0, None, "z")]
    e = spark.createDataFrame([*edges, (40, None, 1.0, 2.0, 3.0)], E)
    got = vector.points_in_polygons(spark.createDataFrame(points, P), e, size=size)
    assert sorted(map(tuple, got.collect())) == plain(points, edges)


def test_nothing(spark):
    e, p = spark.createDataFrame([], E), spark.createDataFrame([(1, 0.5, 0.5, "z")], P)
    assert vector.points_in_polygons(p, e).count() == 0
    assert vector.points_in_polygons(p.limit(0), spark.createDataFrame(ring(1, [(0, 0), (1, 0), (1, 1)]), E)).count() == 0


def test_rows_grow_with_the_points_alone(spark):
    """Squares in a grid, a fixed number of points in each: the whole row of squares used to meet."""
    met = {}
    for n in (6, 24):
        edges = [x for i in range(n) for j in range(n) for x in ring(i * n + j, [(5 * i + 0.5, 5 * j + 0.5), (5 * i + 4.5, 5 * j + 0.5), (5 * i + 4.5, 5 * j + 4.5), (5 * i + 0.5, 5 * j + 4.5)])]
        points = [(i, float(x), float(y), "z") for i, (x, y) in enumerate(np.random.default_rng(2).uniform(0, 5 * n, (4 * n * n, 2)))]
        cover = polygon_index.polygon_cover(spark.createDataFrame(edges, E))
        met[n] = polygon_index.met_cells(spark.createDataFrame(points, P), cover).count() / len(points)
    assert met[24] < 1.3 * met[6] and met[24] < 1.1


def test_cover_grows_with_the_boundary(spark):
    """Four times the side has sixteen times the area and about four times the cells."""
    side = lambda a: polygon_index.polygon_cover(spark.createDataFrame(ring(1, [(0.3, 0.3), (a, 0.3), (a, a), (0.3, a)]), E)).count()
    assert side(128.5) < 5 * side(32.5)
