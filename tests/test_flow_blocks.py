"""Paths and sums over parts of a grid against plain walks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnworks.operators import flow


def walked(nxt, stops, width):
    out = {}
    for c in nxt:
        seen, at = [], c
        while at not in seen:
            seen.append(at)
            if at in stops or nxt[at] is None or nxt[at] not in nxt:
                break
            at = nxt[at]
        else:
            out[c] = (None, True, None)
            continue
        rows, cols = [x // width for x in seen], [x % width for x in seen]
        out[c] = (at, False, (min(rows), max(rows), min(cols), max(cols)))
    return out


def grid(rng, height, width):
    """Mostly downhill pointers with some cycles, self-loops, gaps and dangling ends."""
    nxt = {}
    for r in range(height):
        for c in range(width):
            if rng.random() < 0.03:
                continue
            i, j = rng.choice([0, 1, 1]), rng.integers(-1, 2)
            to = (r + i) * width + min(max(c + j, 0), width - 1)
            nxt[r * width + c] = None if rng.random() < 0.02 else int(to)
    return nxt


@pytest.mark.parametrize("tile", [None, 4, 512])
def test_paths_and_sums(spark, tile):
    rng = np.random.default_rng(3)
    width = 24
    nxt = grid(rng, 30, width)
    stops = {c for c in nxt if rng.random() < 0.02}
    ptr = spark.createDataFrame(list(nxt.items()), "cell long, next long")
    ptr = ptr if tile is None else flow.in_tiles(ptr, width, tile)
    want = walked(nxt, stops, width)
    got = flow.path_ends(ptr, spark.createDataFrame([(c,) for c in stops], "cell long"), width=width).collect()
    assert sorted(r["cell"] for r in got) == sorted(nxt)
    for r in got:
        end, cyclic, box = want[r["cell"]]
        assert r["cyclic"] == cyclic, r
        assert cyclic or (r["end"], tuple(r["box"])) == (end, box)
    # Sums: cells whose next is missing from the table end there.
    ends = walked(nxt, set(), width)
    above = {c: 0 for c, (_, cyclic, _) in ends.items() if not cyclic}
    for c in above:
        at = c
        while nxt[at] is not None and nxt[at] in nxt:
            at = nxt[at]
            above[at] += 1
    assert {r["cell"]: r["upslope"] for r in flow.flow_accumulation(ptr).collect()} == above


def test_a_long_path_over_many_tiles(spark):
    n = 3000
    ptr = flow.in_tiles(spark.range(n).select(F.col("id").alias("cell"), F.when(F.col("id") < n - 1, F.col("id") + 1).alias("next")), 50, 8)
    none = spark.createDataFrame([], "cell long")
    assert flow.path_ends(ptr, none).where(f"end <> {n - 1} OR cyclic").count() == 0
    assert flow.flow_accumulation(ptr).where("upslope <> cell").count() == 0


def test_nothing(spark):
    none = spark.createDataFrame([], "cell long, next long")
    assert flow.path_ends(none, none.select("cell")).count() == 0 and flow.flow_accumulation(none).count() == 0
