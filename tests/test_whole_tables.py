"""Queries over whole tables against brute force on a small fixture."""

import pytest

from tarnworks.plans import registry


def components(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("whole"))
    orders = [(k, k % 31, float(k)) for k in range(4000)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{at}/orders.parquet")
    items = [(k, (k * 17 + i * 700) % 3000, float(1 + (k + 7 * i) % 50)) for k in range(1, 400) for i in range(3)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{at}/lineitem.parquet")
    parts = [(f"Brand{i % 7}", f"TYPE{i * 5 % 11}", i % 50 + 1) for i in range(600)]
    spark.createDataFrame(parts, "p_brand string, p_type string, p_size int").write.parquet(f"{at}/part.parquet")
    return at, items, parts


def test_regions(spark, folder):
    m = {divmod(k, 64) for k in range(4000) if k % 3 == 0 or k % 10 == 1}
    near = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    want = components((r * 64 + c, (r + i) * 64 + c + j) for r, c in m for i, j in near if (r + i, c + j) in m)
    got = {(x["row"], x["col"]): x["label"] for x in registry.QUERIES["grf01_regions"](spark, folder[0]).collect()}
    assert got == {divmod(k, 64): v + 1 for k, v in want.items()} and max(got)[0] > 40


def test_tiles(spark, folder):
    first, edges = {}, []
    for k, p, _ in folder[1]:
        tile = p * 5 + k % 5
        edges.append((first.setdefault(k, tile), tile))
    got = {x["tile"]: x["component"] for x in registry.QUERIES["grf09_tile_components"](spark, folder[0]).collect()}
    assert got == components(edges)


def test_catalog(spark, folder):
    run = lambda name: registry.QUERIES[name](spark, folder[0])
    rows = {(b, t, s % 3) for b, t, s in folder[2]}
    least = {b: min(s for x, _, s in folder[2] if x == b) for b, _, _ in folder[2]}
    assert sorted(map(tuple, run("agg45_catalog_rows").collect())) == sorted((b, t, "prm_" + t) for b, t, _ in rows)
    assert sorted(map(tuple, run("agg46_unused_columns").collect())) == sorted((b, t) for b, t, n in rows if n == 0)
    alternatives = {}
    for b, t, n in sorted(rows):
        if n:
            alternatives.setdefault("prm_" + t, []).append(t)
    assert {x["param"]: x["column"] for x in run("agg46_process_columns").collect()} == {k: " or ".join(v) for k, v in alternatives.items()}
    builders = {}
    for b in sorted(least):
        builders.setdefault(f"b{least[b] % 3}", []).append(b)
    assert {x["builder"]: (x["entries"], x["n"]) for x in run("agg54_entries_by_builder").collect()} == {k: (",".join(v), len(v)) for k, v in builders.items()}
