"""Flow on D8 grids and graphs: reach, labels, accumulation and regions.

A pointer table is (cell, next), with a ``block`` of cells that lie together where there is one; a
null next ends a path. Paths are contracted inside blocks first, then doubled over what is left.
Every loop writes its state to the shared folder each round, and the rounds are the logarithm of
the longest path.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.graph import connected_components
from tarnworks.core.io import materialize
from tarnworks.operators.cells import CELL, D8


def pointers(codes: DataFrame, width: int, region: str | None = None) -> DataFrame:
    """(cell, next) of (row, col, code): cell = row * width + col; next is null for codes other
    than the eight, off the table, and, with ``region``, across regions."""
    step = F.create_map(*[x for k, (i, j) in D8.items() for x in (F.lit(k), F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")))])
    d = codes.withColumn("s", F.try_element_at(step, F.col("code")))
    cell = F.col("row").cast("long") * width + F.col("col")
    to_row, to_col = F.col("row") + F.col("s.i"), F.col("col") + F.col("s.j")
    inside = (to_col >= 0) & (to_col < width) & (to_row >= 0)
    mine = F.lit(0) if region is None else F.coalesce(F.col(region), F.lit(-1))
    d = d.select(cell.alias("cell"), F.when(inside, to_row.cast("long") * width + to_col).alias("to"), mine.alias("r"))
    known = d.select(F.col("cell").alias("to"), F.col("r").alias("to_r"), F.lit(True).alias("there"))
    return d.join(known, "to", "left").select("cell", F.when(F.coalesce("there", F.lit(False)) & (F.col("r") == F.col("to_r")), F.col("to")).alias("next"))


def in_tiles(ptr: DataFrame, width: int, tile: int = 512) -> DataFrame:
    """Pointers of a grid of ``width`` columns with the square tile that each cell lies in."""
    row, col = F.floor(F.col("cell") / width), F.pmod(F.col("cell"), F.lit(width))
    return ptr.withColumn("block", (F.floor(row / tile) * math.ceil(width / tile) + F.floor(col / tile)).cast("long"))


def _parts(ptr: DataFrame) -> DataFrame:
    """Pointers with the part that is contracted together: their tile, or a range of cells."""
    if "block" in ptr.columns:
        return ptr.withColumnRenamed("block", "part")
    return materialize(ptr.repartitionByRange("cell").withColumn("part", F.spark_partition_id()), "flow-parts")


def _local(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A part's cells in order, where each points inside the part (itself if nowhere), the cell that
    it points at outside, and whether it ends or leaves the part there."""
    cell = table["cell"].to_numpy()
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    there = table["next"].combine_chunks()
    goes = there.is_valid().to_numpy(zero_copy_only=False)[order] & ~table["halt"].to_numpy()[order]
    to = there.fill_null(0).to_numpy()[order]
    at = np.searchsorted(cell, to)
    at[at == len(cell)] = 0
    inner = goes & (cell[at] == to)
    return cell, np.where(inner, at, np.arange(len(cell))), to, ~goes, goes & ~inner


def _doubled(state: DataFrame, rounds: int, box: list[str]) -> DataFrame:
    """(cell, end, done, loops, box): pointers (cell, end) followed until a done one. Only open rows
    meet the rows that they point at. Distances to an end have no gaps: a round that finishes no row
    leaves the cyclic ones, whose ``end`` is some cell on the way."""
    least, most = (lambda c: F.least(f"box.{c}", f"rest.{c}").alias(c)), (lambda c: F.greatest(f"box.{c}", f"rest.{c}").alias(c))
    path = [F.struct(least("r0"), most("r1"), least("c0"), most("c1")).alias("box")] if box else []
    state = materialize(state, "flow-paths")
    done, open_ = state.where("done"), state.where("NOT done")
    for _ in range(rounds):
        if open_.isEmpty():
            break
        ahead = done.unionByName(open_).select(F.col("cell").alias("end"), F.col("end").alias("far"), F.col("done").alias("final"), F.col("loops").alias("far_loops"), *[F.col(b).alias("rest") for b in box])
        moved = open_.drop("done", "loops").join(ahead, "end").select("cell", F.col("far").alias("end"), F.col("final").alias("done"), F.col("far_loops").alias("loops"), *path)
        moved = materialize(moved, "flow-paths")
        if moved.where("done").isEmpty():
            break
        done, open_ = done.unionByName(moved.where("done")), moved.where("NOT done")
    return done.unionByName(open_)


PATH = "cell long, root long, kind int, onward long"
BOX = ["r0", "r1", "c0", "c1"]


def path_ends(ptr: DataFrame, stop: DataFrame, rounds: int = 40, width: int | None = None) -> DataFrame:
    """(cell, end, cyclic): where each cell's path stops; cells on or above a cycle are cyclic.
    With the table's ``width``, also ``box``: the rows and columns (r0, r1, c0, c1) of the path.

    Paths stop at cells of ``stop`` (cell), where next is null and where next is no cell. Two levels:
    a task follows the paths inside its part (a tile of ``in_tiles``, else a range of cells) to
    their ends or to the cells where they leave it; only these border cells are then followed from
    part to part by doubling, and one join gives every cell the end of its border cell. ``end`` of
    a cyclic cell is some cell on the way. Cells that are no longs are doubled one by one.
    """
    halts = stop.select("cell").distinct().withColumn("halt", F.lit(True))
    d = ptr.join(halts, "cell", "left").withColumn("halt", F.coalesce("halt", F.lit(False)))
    if dict(ptr.dtypes)["cell"] != "bigint":
        ends = F.col("halt") | F.col("next").isNull()
        state = d.select("cell", F.when(ends, F.col("cell")).otherwise(F.col("next")).alias("end"), ends.alias("done"), F.lit(False).alias("loops"))
        return _doubled(state, rounds, []).select("cell", "end", (~F.col("done") | F.col("loops")).alias("cyclic"))
    boxed = width is not None

    def contract(table: pa.Table) -> pa.Table:
        cell, p, to, ends, leaves = _local(table)
        first = p
        boxes = [cell // width, cell // width, cell % width, cell % width] if boxed else []
        for _ in range(len(cell).bit_length() + 1):
            boxes = [pick(b, b[p]) for pick, b in zip((np.minimum, np.maximum) * 2, boxes)]
            p, before = p[p], p
            if np.array_equal(p, before):
                break
        kind = np.where(ends, 0, np.where(leaves, 1, 2))[p]  # a root that neither ends nor leaves is on a cycle
        kind = np.where((first[p] == p) & (kind < 2), kind, 2)
        columns = [pa.array(cell), pa.array(cell[p]), pa.array(kind.astype(np.int32)), pa.array(to, mask=~leaves)]
        return pa.table([*columns, *map(pa.array, boxes)], names=["cell", "root", "kind", "onward", *(BOX if boxed else [])])

    schema = PATH + "".join(f", {c} long" for c in BOX) if boxed else PATH
    parted = _parts(d.select("cell", "next", "halt", *[c for c in ("block",) if c in ptr.columns]))
    local = materialize(parted.groupBy("part").applyInArrow(contract, schema), "flow-local")
    box = [F.struct(*BOX).alias("box")] if boxed else []
    local = local.select("cell", "root", "kind", "onward", *box)
    names = ["box"] if boxed else []
    ahead = local.select(F.col("cell").alias("onward"), F.col("root").alias("end"), F.col("kind").alias("k"), *names)
    border = local.where("kind = 1 AND cell = root").select("cell", "onward", *[F.col(b).alias("own") for b in names]).join(ahead, "onward", "left")
    border = border.select("cell", F.coalesce("end", "cell").alias("end"), (F.coalesce("k", F.lit(0)) != 1).alias("done"), (F.coalesce("k", F.lit(0)) == 2).alias("loops"), *[F.coalesce(b, "own").alias(b) for b in names])
    far = _doubled(border, rounds, names).select(F.col("cell").alias("root"), "end", (~F.col("done") | F.col("loops")).alias("cyclic"), *[F.col(b).alias("rest") for b in names])
    least, most = (lambda c: F.least(f"box.{c}", f"rest.{c}").alias(c)), (lambda c: F.greatest(f"box.{c}", f"rest.{c}").alias(c))
    whole = [F.struct(least("r0"), most("r1"), least("c0"), most("c1")).alias("box")] if boxed else []
    left = local.where("kind = 1").join(far, "root").select("cell", "end", "cyclic", *whole)
    return local.where("kind <> 1").select("cell", F.col("root").alias("end"), (F.col("kind") == 2).alias("cyclic"), *names).unionByName(left)


def downstream_reach(ptr: DataFrame, pour: DataFrame, barrier: DataFrame) -> DataFrame:
    """(cell, drains, cyclic): 1 where the path meets a pour cell before a barrier; pour beats
    barrier in one cell; cells of cycles do not drain."""
    ends = path_ends(ptr, pour.select("cell").union(barrier.select("cell")))
    hit = pour.select(F.col("cell").alias("end")).distinct().withColumn("hit", F.lit(1))
    return ends.join(hit, "end", "left").select("cell", F.when(F.col("cyclic"), 0).otherwise(F.coalesce("hit", F.lit(0))).alias("drains"), "cyclic")


def labelled_reach(ptr: DataFrame, pour: DataFrame, barrier: DataFrame) -> DataFrame:
    """(cell, label) of pour (cell, label): the label that the path reaches first, 0 if none."""
    ends = path_ends(ptr, pour.select("cell").union(barrier.select("cell")))
    labels = pour.groupBy("cell").agg(F.max("label").alias("label")).withColumnRenamed("cell", "end")
    return ends.join(labels, "end", "left").select("cell", F.when(F.col("cyclic"), 0).otherwise(F.coalesce("label", F.lit(0))).cast("long").alias("label"))


def label_counts(reach: DataFrame) -> DataFrame:
    return reach.where("label > 0").groupBy("label").agg(F.count(F.lit(1)).alias("n_cells"))


def same_zone(reach: DataFrame, zones: DataFrame, land: DataFrame) -> DataFrame:
    """Cells on land whose label is their own zone."""
    return reach.where("label > 0").join(zones.select("cell", "zone_id"), "cell").where("label = zone_id").join(land.select("cell"), "cell", "left_semi").select("cell", "label")


def _summed(state: DataFrame, rounds: int) -> DataFrame:
    """(cell, a): each a and all above it on a forest (cell, far, a), far null at a root.

    With P_k the 2 ** k-th cell down (null past the end), a(c) += sum of a(d) over d with
    P_k(d) = c: a cell at distance 2 ** k .. 2 ** (k + 1) - 1 has one ancestor at 2 ** k.
    """
    state = materialize(state, "flow-sums")
    for _ in range(rounds):
        open_ = state.where("far IS NOT NULL")
        if open_.isEmpty():
            break
        add = open_.groupBy("far").agg(F.sum("a").alias("more")).withColumnRenamed("far", "cell")
        ahead = state.select(F.col("cell").alias("far"), F.col("far").alias("next"))
        moved = open_.join(ahead, "far").select("cell", F.col("next").alias("far"))
        sums = state.select("cell", "a").join(add, "cell", "left").join(moved, "cell", "left")
        state = materialize(sums.select("cell", "far", (F.col("a") + F.coalesce("more", F.lit(0))).alias("a")), "flow-sums", instead_of=state)
    return state.select("cell", "a")


def flow_accumulation(ptr: DataFrame, rounds: int = 40) -> DataFrame:
    """(cell, upslope): the cells above each cell, without itself. Cells on or above a cycle are
    left out first.

    A task sums the cells of its part (see ``path_ends``) and hands on what leaves it; the forest of
    these border cells, far fewer than cells, is summed by doubling; then every part is summed once
    more with what flows in. So each pass writes every cell once, whatever the longest path.
    """
    parted = materialize(_parts(ptr.select("cell", "next", *[c for c in ("block",) if c in ptr.columns])), "flow-parted")
    cyclic = path_ends(parted.withColumnRenamed("part", "block"), parted.where("next IS NULL").select("cell"), rounds).where("cyclic").select("cell")
    good = materialize(parted.join(cyclic, "cell", "left_anti").withColumns({"halt": F.lit(False), "a": F.lit(1).cast("long")}), "flow-acyclic")

    def sums(table: pa.Table) -> pa.Table:
        cell, first, to, _, leaves = _local(table)
        a = table["a"].to_numpy()[np.argsort(table["cell"].to_numpy(), kind="stable")].copy()
        own = np.arange(len(cell))
        p = np.where(first == own, -1, first)
        while (live := np.flatnonzero(p >= 0)).size:
            np.add.at(a, p[live], a[live].copy())
            p[live] = p[p[live]]
        root = first
        for _ in range(len(cell).bit_length() + 1):
            root = root[root]
        return pa.table([pa.array(cell), pa.array(a), pa.array(cell[root]), pa.array(leaves[root]), pa.array(to, mask=~leaves)], names=["cell", "a", "root", "leaves", "onward"])

    schema = "cell long, a long, root long, leaves boolean, onward long"
    local = materialize(good.groupBy("part").applyInArrow(sums, schema), "flow-local")
    ahead = local.select(F.col("cell").alias("onward"), F.when(F.col("leaves"), F.col("root")).alias("far"))
    border = local.where("leaves AND cell = root").select("cell", "a", "onward").join(ahead, "onward", "left")
    border = materialize(border, "flow-border")
    total = _summed(border.select("cell", "far", "a"), rounds)
    inflow = border.select("cell", "onward").join(total, "cell").groupBy("onward").agg(F.sum("a").alias("more")).withColumnRenamed("onward", "cell")
    fed = good.join(inflow, "cell", "left").withColumn("a", F.col("a") + F.coalesce("more", F.lit(0))).drop("more")
    return fed.groupBy("part").applyInArrow(sums, schema).select("cell", (F.col("a") - 1).alias("upslope"))


def regions(mask: DataFrame, width: int) -> DataFrame:
    """(row, col, label) of a mask's 8-connected regions; the label is the smallest cell + 1."""
    m = mask.select(*CELL, (F.col("row").cast("long") * width + F.col("col")).alias("cell"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, -1), (1, 0), (1, 1))])
    to = m.withColumn("s", F.explode(steps)).select(F.col("cell").alias("a"), (F.col("row") + F.col("s.i")).alias("row"), (F.col("col") + F.col("s.j")).alias("col"))
    edges = to.join(m.select(*CELL, F.col("cell").alias("b")), CELL).select("a", "b")
    found = connected_components(edges).withColumnRenamed("node", "cell")
    return m.join(found, "cell", "left").select(*CELL, (F.coalesce("component", "cell") + 1).alias("label"))


def own_terminus_share(ends: DataFrame, polygons: DataFrame, pad: float | None = None, width: int | None = None) -> DataFrame:
    """(comid, share) of polygon cells (cell, comid) whose path ends inside the same polygon.

    With ``pad`` (cells) and the table's ``width``, only paths count that stay in the polygon's
    box widened by ``pad`` or half the box's longer side; ``ends`` then needs the paths' boxes.
    """
    inside = polygons.select(F.col("cell").alias("end"), F.col("comid").alias("end_comid")).distinct()
    there = ends.where("NOT cyclic")
    j = polygons.join(there.select("cell", "end", *(["box"] if pad is not None else [])), "cell", "left").join(inside, "end", "left")
    stays = F.lit(True)
    if pad is not None:
        row, col = F.floor(F.col("cell") / width), F.pmod(F.col("cell"), F.lit(width))
        j = j.join(polygons.groupBy("comid").agg(F.min(row).alias("y0"), F.max(row).alias("y1"), F.min(col).alias("x0"), F.max(col).alias("x1")), "comid")
        room = F.greatest(F.lit(float(pad)), F.greatest(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")) / 2)
        stays = (F.col("box.r0") >= F.col("y0") - room) & (F.col("box.r1") <= F.col("y1") + room) & (F.col("box.c0") >= F.col("x0") - room) & (F.col("box.c1") <= F.col("x1") + room)
    own = j.groupBy("comid", "cell").agg(F.max(F.coalesce((F.col("end_comid") == F.col("comid")) & stays, F.lit(False)).cast("int")).alias("own"))
    return own.groupBy("comid").agg(F.avg("own").alias("share"))


def transitive_reach(seeds: DataFrame, adjacency: DataFrame, targets: DataFrame, rounds: int = 60) -> DataFrame:
    """(seed, key): the smallest target key that each seed reaches over an adjacency (a, b), both
    ways, however far; a seed that reaches none has no row.

    Ids are long. A component keeps one key, so however many seeds and targets it has, each seed
    gives a row. Raises when ``rounds`` of the components do not suffice.
    """
    found = connected_components(adjacency, rounds=rounds)
    of = lambda d, name: d.join(found.withColumnRenamed("node", name), name, "left").select(name, F.coalesce("component", name).alias("component"))
    s, t = (of(d.select(name).where(F.col(name).isNotNull()).distinct(), name) for d, name in ((seeds, "seed"), (targets, "key")))
    return s.join(t.groupBy("component").agg(F.min("key").alias("key")), "component").select("seed", "key")


def tile_components(membership: DataFrame) -> DataFrame:
    """(tile, component) of (polygon, tile): tiles that share a polygon, directly or not, as one;
    the component is its smallest tile."""
    first = membership.groupBy("polygon").agg(F.min("tile").alias("a"))
    edges = membership.join(first, "polygon").select("a", F.col("tile").alias("b"))
    found = connected_components(edges).withColumnRenamed("node", "tile")
    return membership.select("tile").distinct().join(found, "tile", "left").select("tile", F.coalesce("component", "tile").alias("component"))


def fill_depressions(cells: DataFrame, rounds: int = 60, by: tuple[str, ...] = ()) -> DataFrame:
    """(row, col, filled, depth): each cell raised to its lowest way out of the table, or of its
    own window where ``by`` names the windows' keys. Cells with a missing neighbour are outlets;
    null and NaN values are missing cells.

    Cells flow to their least neighbour, so each ends in an outlet or a basin's lowest cell. The
    level of a basin is its least largest pass on a way to an outlet: every basin takes its lowest
    pass, basins joined so are contracted with that pass as a lower limit, and so on. A round at
    least halves the open basins; raises when ``rounds`` do not suffice.
    """
    key = [*by, *CELL]
    cell = F.struct(*key).alias("cell")
    valid = cells.where("value IS NOT NULL").select(*key, F.col("value").cast("double").alias("z")).where(~F.isnan("z"))
    kinds = dict(valid.dtypes)
    steps = lambda d8: F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in d8])
    send = lambda d, d8, *v: d.withColumn("s", F.explode(steps(d8))).select(*by, (F.col("row") + F.col("s.i")).alias("row"), (F.col("col") + F.col("s.j")).alias("col"), *v)
    # A neighbour is its place in the order of the nine cells, that of their keys; 4 is the cell itself.
    place = (4 - 3 * F.col("s.i") - F.col("s.j")).cast("byte").alias("k")
    near = send(valid, D8.values(), F.struct("z", place).alias("v")).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v"))
    d = valid.join(near, key, "left").withColumn("outlet", F.coalesce("n", F.lit(0)) < 8)
    lower = F.struct(*by, *[(F.col(c) + step).cast(kinds[c]).alias(c) for c, step in (("row", F.floor(F.col("v.k") / 3) - 1), ("col", F.col("v.k") % 3 - 1))])
    down = F.when(~F.col("outlet") & ((F.col("v.z") < F.col("z")) | ((F.col("v.z") == F.col("z")) & (F.col("v.k") < 4))), lower)
    ptr = materialize(d.select(cell, "z", "outlet", down.alias("next")), "fill-cells")
    outlets = ptr.where("outlet").select("cell")
    out = outlets.select(F.col("cell").alias("end"), F.lit(True).alias("out"))
    ends = path_ends(ptr.select("cell", "next"), outlets).join(out, "end", "left")
    basins = ends.select("cell", F.when(F.col("out"), F.lit(None)).otherwise(F.col("end")).alias("basin"))
    cells = materialize(ptr.select("cell", "z").join(basins, "cell").select("cell.*", "z", "basin"), "fill-basins")

    # (a, b, p): the lowest pass between neighbouring basins, both ways; a null b is an outlet.
    met = send(cells, ((0, 1), (1, -1), (1, 0), (1, 1)), F.col("z").alias("z_a"), F.col("basin").alias("a")).join(cells, key)
    met = met.select("a", F.col("basin").alias("b"), F.greatest("z", "z_a").alias("p")).where(~F.col("a").eqNullSafe(F.col("b")))
    both = met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"), "p")).where("a IS NOT NULL")
    lowest = lambda e: materialize(e.groupBy("a", "b").agg(F.min("p").alias("p")), "fill-passes")
    edges, level = lowest(both), None
    for _ in range(rounds):
        if edges.isEmpty():
            break
        # One order of all passes, so that only two basins can pick each other: the smaller is the root.
        rank = F.struct("p", F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"), "b")
        pick = materialize(edges.groupBy("a").agg(F.min(rank).alias("m")).select("a", "m.b", "m.p"), "fill-picks")
        other = pick.select(F.col("a").alias("b"), F.col("b").alias("back"))
        root = F.coalesce((F.col("back") == F.col("a")) & (F.col("a") < F.col("b")), F.lit(False))
        chain = pick.join(other, "b", "left").select(F.col("a").alias("cell"), F.when(~root, F.col("b")).alias("next"))
        over = pick.where("b IS NULL").select(F.col("a").alias("end"), F.lit(True).alias("out"))
        tops = path_ends(chain, pick.where("b IS NULL").select(F.col("a").alias("cell"))).join(over, "end", "left")
        tops = tops.select(F.col("cell").alias("a"), F.when(F.col("out"), F.lit(None)).otherwise(F.col("end")).alias("top"))
        tops = materialize(tops.join(pick.select("a", "p"), "a"), "fill-tops")
        if level is None:
            level = tops.select(F.col("a").alias("basin"), "top", "p")
        else:
            moved = level.withColumnsRenamed({"top": "a", "p": "so_far"}).join(tops, "a", "left")
            level = moved.select("basin", "top", F.greatest("so_far", "p").alias("p"))
        level = materialize(level, "fill-levels")
        of = lambda end: tops.select(F.col("a").alias(end), F.col("top").alias(f"{end}_top"))  # noqa: E731, B023
        rest = edges.join(of("a"), "a").join(of("b"), "b", "left").select(F.col("a_top").alias("a"), F.col("b_top").alias("b"), "p")
        edges = lowest(rest.where("a IS NOT NULL").where(~F.col("a").eqNullSafe(F.col("b"))))
    else:
        if not edges.isEmpty():
            raise RuntimeError(f"depressions not filled in {rounds} rounds")
    if level is None:
        return cells.select(*key, F.col("z").alias("filled"), F.lit(0.0).alias("depth"))
    full = cells.join(level.select("basin", "p"), "basin", "left").withColumn("filled", F.greatest("z", "p"))
    return full.select(*key, "filled", (F.col("filled") - F.col("z")).alias("depth"))
