"""Plans and steps whose figures must not outgrow the input: what they move, hold or send to the driver."""

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnworks.core import graph, io
from tarnworks.operators import cells, flow, lines, polygon_index, snow, tables, vector, zonal
from tarnworks.plans import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def slope(spark):
    return spark.range(400).selectExpr("CAST(id DIV 20 AS INT) AS row", "CAST(id % 20 AS INT) AS col", "CAST(id * id % 97 AS DOUBLE) AS value")


def test_neighbours_are_not_sent_to_the_driver(slope):
    """Eight rows a cell are estimated as one, so small grids were joined by broadcast."""
    near = cells.neighbours(slope)
    assert "Broadcast" not in plan(near)
    assert near.count() == 8 * 18 * 18 + 5 * 4 * 18 + 3 * 4
    assert "Broadcast" not in plan(cells.slope_aspect(slope, 1.0))


def test_pointers_are_not_sent_to_the_driver(slope):
    found = cells.flow_pointer(slope)
    assert "Broadcast" not in plan(found)
    assert found.count() == 400


def test_a_tasks_forest_is_bounded():
    """The union-find held every node of its task, and gave nothing before the last edge."""
    read = []

    def batches():
        for at in range(0, 4000, 100):
            read.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(range(at, at + 100)), pa.array(range(at + 1, at + 101))], names=["a", "b"])

    found = graph._forest(300)(batches())
    first = next(found)
    assert len(read) <= 4
    edges = [(a, b) for x in (first, *found) for a, b in zip(*(c.to_pylist() for c in x.columns))]
    assert len(edges) <= 4000
    up = dict(edges)
    top = lambda x: top(up[x]) if x in up else x
    assert {top(x) for x in range(0, 4001, 100)} == {0}


def test_components_over_bounded_forests(spark, monkeypatch):
    monkeypatch.setattr(graph._forest, "__defaults__", (20,))
    ring = spark.range(3000).selectExpr("id AS a", "CASE WHEN id % 500 = 499 THEN id - 499 ELSE id + 1 END AS b")
    found = graph.connected_components(ring, small=0)
    assert sorted(map(tuple, found.collect())) == [(x, x - x % 500) for x in range(3000)]


def test_series_in_parts_of_bounded_rows(spark):
    """Tasks of the join were cut by what they read, and held some rows for each of these."""
    assert zonal.cell_parts(spark, 50_000_000) == 500 and zonal.cell_parts(spark, 1) == spark.sparkContext.defaultParallelism
    w = spark.range(600).selectExpr("id % 7 AS zone_id", "CAST(id % 50 AS INT) AS row", "CAST(id % 4 AS INT) AS col", "1.0D + id % 3 AS w")
    g = spark.range(900).selectExpr("id % 5 AS date", "CAST(id % 60 AS INT) AS row", "CAST(id % 4 AS INT) AS col", "CASE WHEN id % 11 > 0 THEN CAST(id % 13 AS DOUBLE) END AS swe")
    rows = lambda d: sorted(tuple(None if x is None else round(x, 9) for x in r) for r in d.collect())
    assert rows(zonal.series(w, g, ["swe"], parts=11)) == rows(zonal.series(w, g, ["swe"]))


@pytest.mark.parametrize("name", ["zon12_series", "zon14_snow_cover", "udf01_source_hook", "zon13_series_std"])
def test_series_queries_count_their_rows(spark, name, monkeypatch):
    asked = []
    monkeypatch.setattr(zonal, "cell_parts", lambda spark, rows: asked.append(rows) or 5)
    registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert asked and asked[0] > 5000


def test_a_curve_is_made_once_a_task(monkeypatch):
    """Every batch of a task made the curves of all its coefficients again."""
    made, plain = [], snow.lognormal_curve
    monkeypatch.setattr(snow, "lognormal_curve", lambda cv: made.extend(cv) or plain(cv))
    batches = [pd.Series([0.5, None, 1.0, 0.5]), pd.Series([1.0, 0.5]), pd.Series([None], dtype=float), pd.Series([2.0, 0.5])]
    found = [x for b in snow.curve_batches(iter(batches)) for x in b]
    assert made == [0.5, 1.0, 2.0]
    for cv, curve in zip([x for b in batches for x in b], found, strict=True):
        assert curve is None if pd.isna(cv) else list(curve) == list(plain([cv])[0])
    monkeypatch.setattr(snow, "CURVES", 2)
    again = [x for b in snow.curve_batches(iter(batches)) for x in b]
    assert [None if x is None else list(x) for x in again] == [None if x is None else list(x) for x in found]


def test_edge_pairs_are_shuffled(spark):
    """A side read in one task made all pairs there when the other was sent to it."""
    e = spark.range(40).selectExpr("id AS line_id", "0 AS seq", "id * 1.0D AS x1", "0D AS y1", "id + 1.5D AS x2", "0.5D AS y2")
    met = lines._met(e.drop("seq"), e.drop("seq"), 1.0)
    assert "Broadcast" not in plan(met)
    near = {(a, b) for a in range(40) for b in range(40) if abs(a - b) <= 1}
    assert near <= {(r["line_id"], r["line_id_b"]) for r in met.collect()}


def test_batches_do_not_send_points_to_the_driver(spark, monkeypatch):
    """The cuts were estimated larger than the points, so each level sent all points."""
    plans, write = [], io.materialize
    monkeypatch.setattr(io, "materialize", lambda df, name="table", **k: (plans.append(plan(df)) if name == "batches" else None, write(df, name, **k))[1])
    points = write(spark.range(20000).selectExpr("id AS zone_id", "CAST(id * 37 % 9001 AS DOUBLE) AS x", "CAST(id * 53 % 8999 AS DOUBLE) AS y"), "points")
    found = vector.spatial_batches(points, 5000)
    assert len(plans) == 2 and all("BuildLeft" not in p for p in plans)
    sizes = [r["n"] for r in found.groupBy("batch_id").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20000 and len(sizes) == 4 and min(sizes) > 4900


def test_gaps_are_joined_by_key(spark, monkeypatch):
    """Tables of a row a place were sent to the driver, donors several times."""
    asked, search = [], vector.nearest
    monkeypatch.setattr(vector, "nearest", lambda missing, donors, *a: (asked.extend([plan(missing), plan(donors)]), search(missing, donors, *a))[1])
    places = spark.range(60).selectExpr("id AS zone_id", "id * 1.0D AS x", "0D AS y")
    found = tables.fill_gaps(places.where("zone_id % 3 = 0").selectExpr("zone_id", "zone_id * 2.0D AS a"), places, ["a"])
    assert asked and all("Broadcast" not in p for p in asked)
    assert {r["zone_id"]: r["a"] for r in found.collect()} == {i: 2.0 * (3 * round(i / 3) if i < 58 else 57) for i in range(60)}


def test_fill_sends_a_neighbours_place_and_not_its_key(spark, monkeypatch):
    """Each of the eight rows that a cell sends held the cell's whole key."""
    plans, write = [], flow.materialize
    monkeypatch.setattr(flow, "materialize", lambda df, name="table", **k: (plans.append(plan(df)) if name == "fill-cells" else None, write(df, name, **k))[1])
    d = spark.range(3, 200).selectExpr("id DIV 100 AS w", "CAST(id % 100 DIV 10 AS INT) AS row", "CAST(id % 10 AS INT) AS col", "CAST(id * id % 7 AS DOUBLE) AS value")
    found = {(r["w"], r["row"], r["col"]): r["filled"] for r in flow.fill_depressions(d, by=("w",)).collect()}
    assert "as tinyint" in plans[0] and len(found) == 197
    z = {(r["w"], r["row"], r["col"]): r["value"] for r in d.collect()}
    near = lambda c: [(c[0], c[1] + i, c[2] + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]
    want = {c: z[c] if any(n not in z for n in near(c)) else 1e9 for c in z}
    for _ in range(200):
        want = {c: max(z[c], min([want[c], *[want[n] for n in near(c) if n in z]])) for c in z}
    assert found == want


@pytest.fixture
def squares(spark):
    """Squares of width 3 in a row, each overlapping the next by 1."""
    corners = "array(named_struct('x', {0}, 'y', 0D), named_struct('x', {0} + 3, 'y', 0D), named_struct('x', {0} + 3, 'y', 3D), named_struct('x', {0}, 'y', 3D))".format("2D * id")
    d = spark.range(30).selectExpr("id AS zone_id", f"{corners} AS c").selectExpr("zone_id", "c", "explode(sequence(0, 3)) AS i")
    return d.selectExpr("zone_id", "c[i].x AS x1", "c[i].y AS y1", "c[(i + 1) % 4].x AS x2", "c[(i + 1) % 4].y AS y2")


def test_overlap_areas_send_nothing_to_the_driver(squares, monkeypatch):
    """Edges, pieces and covers, estimated by their files, went to the driver a dozen times."""
    monkeypatch.setattr(polygon_index, "SENT", 0, raising=False)
    plans, write = {}, io.materialize
    for module in (lines, polygon_index):
        monkeypatch.setattr(module, "materialize", lambda df, name="table", **k: (plans.setdefault(name, []).append(plan(df)), write(df, name, **k))[1])
    found = lines.overlap_areas(squares, squares, size=2.0)
    assert {"rings", "cover"} <= set(plans) and not [n for n in plans if "Broadcast" in "".join(plans[n])]
    assert "Broadcast" not in plan(found)
    want = {(i, j): 9.0 if i == j else 3.0 for i in range(30) for j in range(30) if abs(i - j) <= 1}
    assert {(r["zone_id"], r["source"]): round(r["area"], 9) for r in found.collect()} == want
    assert "Broadcast" not in plan(found)


def test_only_a_small_cover_is_sent_to_the_points(spark, squares, monkeypatch):
    """Catalyst took a cover, or points that meet several levels, by the size of their files."""
    points = spark.range(500).selectExpr("id AS point_id", "id % 61 + 0.25D AS x", "id % 3 + 0.5D AS y")
    small = vector.points_in_polygons(points, squares)
    assert "BuildRight" in plan(small) and "SortMergeJoin" not in plan(small)
    monkeypatch.setattr(polygon_index, "SENT", 100, raising=False)
    large = vector.points_in_polygons(points, squares)
    assert "Broadcast" not in plan(large)
    want = sorted((p, z) for p in range(500) for z in range(30) if 2 * z <= p % 61 + 0.25 < 2 * z + 3)
    assert sorted(map(tuple, small.collect())) == want == sorted(map(tuple, large.collect()))


def test_polygons_without_a_key_take_no_part(spark, squares):
    nameless = squares.where("zone_id = 0").selectExpr("CAST(NULL AS BIGINT) AS zone_id", *polygon_index.SEG)
    points = spark.range(1).selectExpr("id AS point_id", "0.5D AS x", "0.5D AS y")
    assert [tuple(r) for r in vector.points_in_polygons(points, squares.unionByName(nameless)).collect()] == [(0, 0)]
