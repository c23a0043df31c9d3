"""Graph helpers for edge tables of any size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.io import materialize


#: Edges that one task may hold: some tens of megabytes.
SMALL = 300_000
#: Nodes that a task's union-find holds before it hands on its forest and begins another.
HELD = 400_000


def _forest(held: int | None = HELD) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Union-find over the edges of one task: each node with its set's smallest node.

    Once ``held`` nodes are in memory their forest is handed on and the next edges begin another,
    so a task's memory does not grow with its edges. Forests of pieces connect the same nodes as
    their edges; None holds all nodes, so that each has one row.
    """

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = parent[x]
            return x

        def trees() -> Iterator[pa.RecordBatch]:
            nodes = np.fromiter(parent, np.int64, len(parent))
            roots = np.fromiter((root(x) for x in nodes.tolist()), np.int64, len(parent))
            parent.clear()
            keep = nodes != roots
            nodes, roots = nodes[keep], roots[keep]
            for at in range(0, len(nodes), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[at : at + 100_000]), pa.array(roots[at : at + 100_000])], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if held is not None and len(parent) >= held:
                yield from trees()
        yield from trees()

    return shrink


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, small: int = SMALL) -> DataFrame:
    """(node, component): the smallest node that each node of an edge table can reach.

    Long ids; edges with a null end and loops are left out. Every round first shrinks each
    task's edges to a forest by union-find, then hooks each node to its smallest neighbour,
    jumps to the roots and keeps the edges between roots. A task holds at most about ``HELD`` nodes. At most ``small`` edges after the
    first shrinking are finished by one task. Nodes without an edge are not returned. Raises
    when ``rounds`` do not suffice.
    """
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    forest = e.mapInArrow(_forest(), "a long, b long").distinct()
    e = materialize(forest, "component-edges")
    if e.count() <= small:
        flat = e.coalesce(1).mapInArrow(_forest(None), "a long, b long")
        both = flat.unionByName(flat.select(F.col("b").alias("a"), "b"))
        return materialize(both.distinct().select(F.col("a").alias("node"), F.col("b").alias("component")), "component-labels")
    label = None  # (node, component) of all nodes hooked so far
    for _ in range(rounds):
        if e.isEmpty():
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("up"))
        up = materialize(hook, "component-hooks")
        while True:  # pointer jumping: paths halve in each turn
            above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = materialize(up.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "component-jumps")
            up = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        of = lambda end: up.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up"))
        e = e.join(of("a"), "a").join(of("b"), "b").where("a_up <> b_up").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
        e = materialize(e.mapInArrow(_forest(), "a long, b long").distinct(), "component-edges")
        if label is None:
            label = up
        else:
            moved = up.select(F.col("node").alias("component"), F.col("up").alias("next"))
            label = materialize(
                label.withColumnRenamed("up", "component").join(moved, "component", "left").select("node", F.coalesce("next", "component").alias("up")),
                "component-labels",
            )
    else:
        if not e.isEmpty():
            raise RuntimeError(f"components not found in {rounds} rounds")
    if label is None:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    return label.select("node", F.col("up").alias("component"))
