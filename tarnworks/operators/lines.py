"""Lines against polygons: overlap lengths, intersections, flow-through roles, polygon overlap areas.

Edges meet edges in square bins; the geometry of a pair is worked out for its own edges alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.io import materialize
from tarnworks.operators.polygon_index import SEG, points_in_cover, polygon_cover, touched_cells
from tarnworks.operators.vector import points_in_polygons


def _binned(edges: DataFrame, size: float) -> DataFrame:
    """An edge for each square bin that it touches."""
    return touched_cells(edges, size).withColumnsRenamed({"cx": "bx", "cy": "by"})


def _met(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """Pairs of edges of a and b that share a bin, once each, b's columns with the suffix _b.

    The bins are shuffled, whatever the size of a side: a table read in few tasks would else make all
    its pairs in these, and edges in several bins are estimated as one row each.
    """
    right = _binned(b.select(*[F.col(c).alias(f"{c}_b") for c in b.columns]).withColumnsRenamed({f"{c}_b": c for c in SEG}), size).withColumnsRenamed({c: f"{c}_b" for c in SEG})
    return _binned(a, size).join(right.hint("merge"), ["bx", "by"]).drop("bx", "by").distinct()


def line_cuts(lines: DataFrame, polygons: DataFrame, line: str = "line_id", zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(line, seq, zone, t): where a line's edge meets a polygon's edges, t from 0 to 1 along it;
    for edges on one line both ends of what they share."""
    p = _met(lines.select(line, "seq", *SEG), polygons.select(zone, *SEG), size).withColumnRenamed(f"{zone}_b", zone)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    ex, ey = F.col("x2_b") - F.col("x1_b"), F.col("y2_b") - F.col("y1_b")
    cross = dx * ey - dy * ex
    ox, oy = F.col("x1_b") - F.col("x1"), F.col("y1_b") - F.col("y1")
    t, u = (ox * ey - oy * ex) / cross, (ox * dy - oy * dx) / cross
    single = F.when((cross != 0) & t.between(0, 1) & u.between(0, 1), F.array(t))
    length = dx * dx + dy * dy
    along = lambda x, y: F.least(F.greatest((x * dx + y * dy) / length, F.lit(0.0)), F.lit(1.0))
    shared = F.when((cross == 0) & (F.abs(ox * dy - oy * dx) < 1e-12) & (length > 0), F.array(along(ox, oy), along(F.col("x2_b") - F.col("x1"), F.col("y2_b") - F.col("y1"))))
    return p.select(line, "seq", zone, F.explode(F.coalesce(single, shared)).alias("t")).distinct()


def _pieces(lines: DataFrame, polygons: DataFrame, line: str, zone: str, size: float, cover: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges cut where they meet polygons: all pieces (line, zone, piece, ax, ay, bx, by, len), the
    (piece, zone) whose middle is inside, and the (piece, zone, along) whose middle lies on the
    polygon's own boundary; ``along`` is positive where the boundary runs the same way. The pieces
    are written, since all three need them, and joined by shuffles, as they grow with the lines."""
    cuts = line_cuts(lines, polygons, line, zone, size)
    cover = cover if cover is not None else polygon_cover(polygons, zone, size)
    # Edges that lie inside a polygon without meeting its boundary: by their first point.
    start = lines.select(F.struct(F.col(line).alias("line"), "seq").alias("start"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    inside = points_in_cover(start, cover, "start", zone, size).select(F.col("start.line").alias(line), "start.seq", zone)
    ends = F.array(F.lit(0.0), F.lit(1.0))
    every = cuts.select(line, "seq", zone, F.array("t").alias("ts")).unionByName(inside.select(line, "seq", zone, ends.alias("ts")))
    knots = every.groupBy(line, "seq", zone).agg(F.array_sort(F.array_distinct(F.concat(F.flatten(F.collect_list("ts")), ends))).alias("k"))
    knots = knots.join(lines.select(line, "seq", *SEG).hint("merge"), [line, "seq"])
    at = knots.select(line, "seq", zone, *SEG, F.explode(F.arrays_zip(F.slice("k", 1, F.size("k") - 1).alias("a"), F.slice("k", 2, F.size("k") - 1).alias("b"))).alias("p")).select(line, "seq", zone, *SEG, "p.a", "p.b").where("b - a > 1e-12")
    point = lambda t, c: F.col(f"{c}1") + t * (F.col(f"{c}2") - F.col(f"{c}1"))
    piece = F.concat_ws("/", line, "seq", zone, F.col("a").cast("string")).alias("piece")
    at = at.select(line, zone, piece, *[point(F.col(t), c).alias(f"{t}{c}") for t in "ab" for c in "xy"], *[point((F.col("a") + F.col("b")) / 2, c).alias(c) for c in "xy"])
    at = materialize(at.withColumn("len", F.sqrt((F.col("bx") - F.col("ax")) ** 2 + (F.col("by") - F.col("ay")) ** 2)), "pieces")
    hit = points_in_cover(at.select("piece", "x", "y"), cover, "piece", zone, size)
    way = at.select("piece", zone, (F.col("bx") - F.col("ax")).alias("wx"), (F.col("by") - F.col("ay")).alias("wy"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    near = _met(way, polygons.select(zone, *SEG), size).where(F.col(f"{zone}_b") == F.col(zone))
    ex, ey = F.col("x2_b") - F.col("x1_b"), F.col("y2_b") - F.col("y1_b")
    off = F.abs((F.col("x1") - F.col("x1_b")) * ey - (F.col("y1") - F.col("y1_b")) * ex)
    share = ((F.col("x1") - F.col("x1_b")) * ex + (F.col("y1") - F.col("y1_b")) * ey) / (ex * ex + ey * ey)
    edge = near.where((off < 1e-9) & share.between(0, 1)).groupBy("piece", zone).agg(F.max(F.col("wx") * ex + F.col("wy") * ey).alias("along"))
    return at, hit, edge


def overlap_lengths(lines: DataFrame, polygons: DataFrame, line: str = "line_id", zone: str = "zone_id", size: float = 1.0, cover: DataFrame | None = None) -> DataFrame:
    """(line, zone, overlap): length of each line inside each polygon, pairs above 1e-6 only.

    An edge is cut where it meets the polygon; pieces whose middle lies inside count whole, and
    pieces on the polygon's own boundary count as inside. A ``polygon_cover`` of the polygons can
    be given.
    """
    at, hit, edge = _pieces(lines, polygons, line, zone, size, cover)
    counted = hit.select("piece", zone).union(edge.select("piece", zone)).distinct()
    return at.join(counted.hint("merge"), ["piece", zone], "left_semi").groupBy(line, zone).agg(F.sum("len").alias("overlap")).where("overlap > 1e-6")


def flow_through(lines: DataFrame, polygons: DataFrame, line: str = "line_id", zone: str = "zone_id", size: float = 1.0, cover: DataFrame | None = None) -> DataFrame:
    """(zone) of polygons that a line flows through: it meets the boundary twice or more, or both
    its ends lie outside and some length inside."""
    cover = cover if cover is not None else polygon_cover(polygons, zone, size)
    cuts = line_cuts(lines, polygons, line, zone, size)
    twice = cuts.groupBy(line, zone).agg(F.count_distinct(F.struct(F.col("seq"), F.round("t", 9))).alias("n")).where("n >= 2").select(zone)
    low, high = F.min(F.struct("seq", F.col("x1").alias("x"), F.col("y1").alias("y"))), F.max(F.struct("seq", F.col("x2").alias("x"), F.col("y2").alias("y")))
    ends = lines.groupBy(line).agg(low.alias("a"), high.alias("b")).select(line, F.explode(F.array(F.struct("a.x", "a.y"), F.struct("b.x", "b.y"))).alias("p")).select(F.col(line).alias("point_id"), "p.x", "p.y")
    touching = points_in_cover(ends.withColumn("point_id", F.struct("point_id", "x", "y")), cover, "point_id", zone, size).select(F.col("point_id.point_id").alias(line), zone)
    through = overlap_lengths(lines, polygons, line, zone, size, cover).join(touching, [line, zone], "left_anti").select(zone)
    return twice.union(through).distinct()


#: Polygon kinds that never flow through: fixed values.
STILL = ["Playa", "Ice Mass"]


def flowing_polygons(lines: DataFrame, polygons: DataFrame, kinds: DataFrame, channels: DataFrame, routed: DataFrame | None = None, network: DataFrame | None = None, line: str = "line_id", zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(zone) of polygons on the stream: a line flows through them, the upstream end of a line of
    ``routed`` (line; default all) lies inside, or they meet a polygon of ``channels``.

    ``kinds`` is (zone, ftype): the still kinds and zones without a kind are left out; with
    ``network`` (zone), so are zones that it does not hold. A line's first point is its upstream end.
    """
    cover = polygon_cover(polygons, zone, size)
    through = flow_through(lines, polygons, line, zone, size, cover)
    first = lines.groupBy(line).agg(F.min(F.struct("seq", F.col("x1").alias("x"), F.col("y1").alias("y"))).alias("p")).select(line, "p.x", "p.y")
    first = first if routed is None else first.join(routed.select(line), line, "left_semi")
    started = points_in_cover(first, cover, line, zone, size).select(zone)
    found = through.union(started).union(intersecting(polygons, channels, zone, size)).distinct()
    found = found.join(kinds.where(~F.col("ftype").isin(STILL)).select(zone), zone, "left_semi")
    return found if network is None else found.join(network.select(zone), zone, "left_semi")


def intersecting(polygons: DataFrame, targets: DataFrame, zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(zone) of polygons that meet a target polygon: edges that cross, or a corner inside."""
    a, b = polygons.select(zone, *SEG), targets.select(F.col(zone).alias("target"), *SEG)
    p = _met(a, b, size)
    side = lambda px, py, qx, qy, rx, ry: (qx - px) * (ry - py) - (qy - py) * (rx - px)
    A, B, C, D = (("x1", "y1"), ("x2", "y2"), ("x1_b", "y1_b"), ("x2_b", "y2_b"))
    c = lambda *k: side(*[F.col(n) for pair in k for n in pair])
    boxes = (F.greatest("x1", "x2") >= F.least("x1_b", "x2_b")) & (F.greatest("x1_b", "x2_b") >= F.least("x1", "x2")) & (F.greatest("y1", "y2") >= F.least("y1_b", "y2_b")) & (F.greatest("y1_b", "y2_b") >= F.least("y1", "y2"))
    crossing = p.where(boxes & (c(A, B, C) * c(A, B, D) <= 0) & (c(C, D, A) * c(C, D, B) <= 0)).select(zone)
    corner = lambda d, key, name: d.groupBy(key).agg(F.min(F.struct("x1", "y1")).alias("p")).select(F.col(key).alias(name), F.col("p.x1").alias("x"), F.col("p.y1").alias("y"))
    inner = points_in_polygons(corner(a, zone, "own"), b.withColumnRenamed("target", "other"), "own", "other", size).select(F.col("own").alias(zone))
    outer = points_in_polygons(corner(b, "target", "own"), a, "own", zone, size).select(zone)
    return crossing.union(inner).union(outer).distinct()


def overlap_areas(a: DataFrame, b: DataFrame, zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(zone, source, area) of polygon pairs that overlap, b's zones as ``source``.

    The boundary of what two polygons share is the pieces of each one's edges inside the other,
    and, once, the pieces on both boundaries that run the same way; the area is its sum of
    signed triangles. Rings may turn either way, holes against their outer ring; repeated edges
    of a polygon count once.
    """
    signed = F.sum((F.col("x1") - F.col("x0")) * (F.col("y2") - F.col("y0")) - (F.col("x2") - F.col("x0")) * (F.col("y1") - F.col("y0")))

    def turned(d: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Distinct edges (name, seq, x1, ..) with the inside on their left, and (name, x0, y0)."""
        d = d.select(F.col(zone).alias(name), *SEG).where("x1 <> x2 OR y1 <> y2").distinct()
        corner = d.groupBy(name).agg(F.min("x1").alias("x0"), F.min("y1").alias("y0"))
        ring = d.join(corner.hint("merge"), name)
        back = ring.groupBy(name).agg((signed < 0).alias("back"))
        e = ring.join(back.hint("merge"), name)
        swap = lambda c, other: F.when(F.col("back"), F.col(other)).otherwise(F.col(c)).alias(c)
        e = e.select(name, F.monotonically_increasing_id().alias("seq"), swap("x1", "x2"), swap("y1", "y2"), swap("x2", "x1"), swap("y2", "y1"), "x0", "y0")
        e = materialize(e, "rings")
        return e.drop("x0", "y0"), e.select(name, "x0", "y0").distinct()

    left, corner = turned(a, zone)
    right, _ = turned(b, "source")
    here = {"inside": _pieces(left, right, zone, "source", size), "of_b": _pieces(right, left, "source", zone, size)}
    parts = []
    for own, (at, hit, edge) in here.items():
        key = ["piece", "source" if own == "inside" else zone]
        hit = hit.distinct().withColumn("hit", F.lit(True))
        marked = at.join(edge.hint("merge"), key, "left").join(hit.hint("merge"), key, "left")
        kept = marked.where("IF(along IS NULL, hit, along > 0)" if own == "inside" else "along IS NULL AND hit")
        parts.append(kept.select(zone, "source", "ax", "ay", "bx", "by"))
    cross = (F.col("ax") - F.col("x0")) * (F.col("by") - F.col("y0")) - (F.col("bx") - F.col("x0")) * (F.col("ay") - F.col("y0"))
    pieces = parts[0].unionByName(parts[1]).join(corner.hint("merge"), zone)
    return pieces.groupBy(zone, "source").agg((F.sum(cross) / 2).alias("area")).where("area > 1e-9")


def _point_to_edge(x, y, ax, ay, bx, by):
    """Distance of a point to an edge."""
    dx, dy = F.col(bx) - F.col(ax), F.col(by) - F.col(ay)
    t = ((F.col(x) - F.col(ax)) * dx + (F.col(y) - F.col(ay)) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.greatest(F.least(F.coalesce(t, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    return F.sqrt((F.col(x) - F.col(ax) - t * dx) ** 2 + (F.col(y) - F.col(ay) - t * dy) ** 2)


def _meet(strict: bool = False):
    """Whether the edges of a row, the second with suffix _b, have a point in common; strictly: in
    the inside of both."""
    side = lambda p, q, r: (F.col(q[0]) - F.col(p[0])) * (F.col(r[1]) - F.col(p[1])) - (F.col(q[1]) - F.col(p[1])) * (F.col(r[0]) - F.col(p[0]))
    a, b, c, d = (("x1", "y1"), ("x2", "y2"), ("x1_b", "y1_b"), ("x2_b", "y2_b"))
    one, two = F.signum(side(a, b, c)) * F.signum(side(a, b, d)), F.signum(side(c, d, a)) * F.signum(side(c, d, b))
    if strict:
        return (one < 0) & (two < 0)
    boxes = (F.greatest("x1", "x2") >= F.least("x1_b", "x2_b")) & (F.greatest("x1_b", "x2_b") >= F.least("x1", "x2")) & (F.greatest("y1", "y2") >= F.least("y1_b", "y2_b")) & (F.greatest("y1_b", "y2_b") >= F.least("y1", "y2"))
    return boxes & (one <= 0) & (two <= 0)


def near_links(polygons: DataFrame, distance: float, zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(a, b), a < b: links that connect the polygons whose distance is at most ``distance``.

    Two polygons are near when two of their edges are, or one holds a corner of the other. Edges
    that several polygons share are compared once, for the smallest of them, and link the others to
    it; so copies of a polygon give a link each and not all pairs. The links join the same polygons
    as all near pairs do, directly or over others.
    """
    e = polygons.select(F.col(zone).alias("zone"), *SEG).distinct()
    ahead = (F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") <= F.col("y2")))
    ends = [F.when(ahead, F.col(c)).otherwise(F.col(o)).alias(c) for c, o in zip(SEG, ["x2", "y2", "x1", "y1"])]
    e = materialize(e.select("zone", *ends).distinct(), "near-edges")
    owner = e.groupBy(*SEG).agg(F.min("zone").alias("first"))
    shared = e.join(owner, SEG).where("zone <> first").select(F.col("first").alias("a"), F.col("zone").alias("b"))
    right = touched_cells(owner.withColumnsRenamed({"first": "other"} | {c: f"{c}_b" for c in SEG}).withColumnsRenamed({f"{c}_b": c for c in SEG}), size).withColumnsRenamed({c: f"{c}_b" for c in SEG})
    met = touched_cells(owner, size, distance / size + 1e-7).join(right, ["cx", "cy"]).where("first < other").drop("cx", "cy").distinct()
    gap = F.least(
        _point_to_edge("x1", "y1", "x1_b", "y1_b", "x2_b", "y2_b"), _point_to_edge("x2", "y2", "x1_b", "y1_b", "x2_b", "y2_b"),
        _point_to_edge("x1_b", "y1_b", "x1", "y1", "x2", "y2"), _point_to_edge("x2_b", "y2_b", "x1", "y1", "x2", "y2"),
    )
    close = met.where(_meet() | (gap <= distance)).select(F.col("first").alias("a"), F.col("other").alias("b"))
    # Polygons that have an edge of their own; copies are linked above.
    own = polygons.join(owner.select(F.col("first").alias(zone)).distinct(), zone, "left_semi")
    corner = own.groupBy(zone).agg(F.min(F.struct("x1", "y1")).alias("p")).select(F.col(zone).alias("own"), F.col("p.x1").alias("x"), F.col("p.y1").alias("y"))
    inside = points_in_polygons(corner, own.select(F.col(zone).alias("other"), *SEG), "own", "other", size).where("own <> other")
    inside = inside.select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    return shared.union(close).union(inside).distinct()


def self_crossings(polygons: DataFrame, zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(zone, n_crossings): pairs of a polygon's edges that meet although they share no corner.

    Edges of one polygon meet in the bins that they touch; neighbours, which share a corner, are
    left out, and so are edges that repeat.
    """
    e = polygons.select(zone, *SEG).where("x1 <> x2 OR y1 <> y2").distinct()
    right = touched_cells(e, size).withColumnsRenamed({c: f"{c}_b" for c in SEG})
    first, second = F.struct(*SEG), F.struct(*[f"{c}_b" for c in SEG])
    pairs = touched_cells(e, size).join(right, [zone, "cx", "cy"]).where(first < second).drop("cx", "cy").distinct()
    shares = lambda a, b: (F.col(f"x{a}") == F.col(f"x{b}_b")) & (F.col(f"y{a}") == F.col(f"y{b}_b"))
    apart = ~(shares(1, 1) | shares(1, 2) | shares(2, 1) | shares(2, 2))
    return pairs.where(apart & _meet()).groupBy(zone).agg(F.count(F.lit(1)).alias("n_crossings"))
