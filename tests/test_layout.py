"""Layers along a Z curve, and numbers inside groups that span tasks."""

import glob

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tarnworks.operators.ranks import numbered
from tarnworks.sources import scans, sinks


def rows_read(df) -> int:
    """Rows that the Parquet scan of a plan gave on, after row groups were skipped."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    todo, found = [node], None
    while todo:
        at = todo.pop()
        if at.nodeName().startswith("Scan parquet"):
            found = at.metrics().apply("numOutputRows").value()
        if at.nodeName() == "AdaptiveSparkPlan":
            todo.append(at.executedPlan())
        elif at.nodeName().endswith("QueryStage"):
            todo.append(at.plan())
        kids = at.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


def test_z_order(spark):
    d = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 0.0), (65535.0, 65535.0), (-5.0, 9e9), (None, 1.0)], "x double, y double")
    got = [r[0] for r in d.select(sinks.z_order(F.col("x"), F.col("y"), (0.0, 0.0, 65536.0, 65536.0))).collect()]
    assert got == [0, 1, 2, 3, 4, 2**32 - 1, 0xAAAAAAAA, None]


def test_box_skips_row_groups(spark, tmp_path):
    rng = np.random.default_rng(2)
    n = 40_000
    d = spark.createDataFrame([(i, float(x), float(y), float(x) + 1, float(y) + 1, "g") for i, (x, y) in enumerate(rng.random((n, 2)) * 1000)] + [(n, None, None, None, None, "g")], "comid long, xmin double, ymin double, xmax double, ymax double, geom string").repartition(4)
    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    d.write.parquet(plain)
    sinks.write_layer(d, laid, files=8, group_bytes=64 * 1024)
    box = (100, 200, 160, 260)
    want, got = (scans.scan_layer(spark, p, ["comid"], bbox=box, geom="geom") for p in (plain, laid))
    assert sorted(want.collect()) == sorted(got.collect()) and got.count() > 0
    assert scans.scan_layer(spark, laid, ["comid"]).count() == n + 1
    assert rows_read(want) >= n and rows_read(got) < n / 4
    groups = [pq.ParquetFile(f).metadata for f in glob.glob(f"{laid}/*.parquet")]
    assert sum(m.num_row_groups for m in groups) >= 8
    empty = str(tmp_path / "empty")
    sinks.write_layer(d.where("comid < 0"), empty)
    assert scans.scan_layer(spark, empty, ["comid"], bbox=box).count() == 0


def test_numbers_inside_groups(spark):
    rows = [(("a" if i % 3 else "b") if i % 10 else None, (i * 7919) % 500) for i in range(2000)]
    d = spark.createDataFrame(rows, "g string, v long").repartition(5)
    got = numbered(d, ["v"], "place", ["g"]).toPandas()
    assert len(got) == 2000 and list(got.columns) == ["g", "v", "place"]
    for _, g in got.groupby("g", dropna=False):
        g = g.sort_values("place")
        assert list(g["place"]) == list(range(len(g))) and g["v"].is_monotonic_increasing
