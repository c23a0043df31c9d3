"""Declared columns, catalogs, guards and registries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.operators.lines import self_crossings
from tarnworks.operators.ranks import exact_percentiles

from tarnworks.core.checks import assert_none, assert_some, lookup, require_columns
from tarnworks.functions.scalar import TRANSFORMS, region_code


def derived_columns(df: DataFrame, declared: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds {new: (source, transform)}; unknown transforms and missing sources raise."""
    unknown = {t for _, t in declared.values()} - set(TRANSFORMS)
    if unknown:
        raise ValueError(f"unknown transforms {sorted(unknown)}")
    require_columns(df, [s for s, _ in declared.values()])
    return df.withColumns({name: TRANSFORMS[t](F.col(s)) for name, (s, t) in declared.items()})


def declared_status(declared: DataFrame, columns: list[str], source: str = "source", transform: str = "transform") -> DataFrame:
    """Declarations (.., source, transform) with a ``status``: ``unknown transform`` where the name is
    not on the whitelist (or null), ``missing source`` where no such column exists, else ``ok``."""
    known, there = F.col(transform).isin(sorted(TRANSFORMS)), F.col(source).isin(columns)
    absent = lambda c: ~F.coalesce(c, F.lit(False))
    return declared.withColumn("status", F.when(absent(known), "unknown transform").when(absent(there), "missing source").otherwise("ok"))


def in_categories(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """Rows of the categories; none at all raises."""
    return assert_some(df.where(F.col(column).isin(keep)), f"{column} in {keep}")


def unexpected_categories(df: DataFrame, column: str, known: list[str]) -> DataFrame:
    return df.where(~F.col(column).isin(known) | F.col(column).isNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def large_enough(df: DataFrame, kind: str, exclude: list[str], area: str, least: float = 900.0) -> DataFrame:
    require_columns(df, [kind, area])
    return df.where(~F.coalesce(F.col(kind), F.lit("")).isin(exclude) & (F.col(area) >= least))


def in_region(df: DataFrame, column: str, region: str) -> DataFrame:
    """Rows of a region, by its sub-regions too; none at all raises."""
    return assert_some(df.where(region_code(F.col(column)) == region), f"region {region}")


def require_overlap(a: DataFrame, b: DataFrame, x: str = "x", y: str = "y") -> None:
    """Raise when the bounding boxes of two point tables are disjoint; empty tables do not raise."""
    box = lambda d: d.agg(*[f(c).alias(f"{n}{c}") for c in (x, y) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    p, q = box(a), box(b)
    if p[f"lo{x}"] is None or q[f"lo{x}"] is None:
        return
    if any(p[f"lo{c}"] > q[f"hi{c}"] or q[f"lo{c}"] > p[f"hi{c}"] for c in (x, y)):
        raise ValueError("the extents do not overlap")


#: Fixed values of the hydrography codes: sink purposes, and feature types by code prefix.
SINK_PURPOSES = {"4": True, "5": True, "8": True, "NT": False}
FEATURE_TYPES = {361: "Playa", 390: "LakePond", 466: "SwampMarsh", 436: "Reservoir", 378: "Ice Mass", 460: "StreamRiver", 336: "CanalDitch"}
CONVEYANCE = ["StreamRiver", "CanalDitch"]


def sink_rows(df: DataFrame, purpose: str = "purp_code", feature: str = "f_code", poly: str = "poly_id") -> DataFrame:
    """Sink-purpose polygons as waterbodies (comid, ftype, member_comid).

    Purposes 4, 4.0 and "4" are one; null and blank ones are no sink. Unknown purposes and
    features, conveyance features among sinks, and polygon ids that are not negative raise.
    """
    raw = F.trim(F.col(purpose).cast("string"))
    number = F.expr(f"try_cast(trim(cast(`{purpose}` AS string)) AS double)")
    code = F.when((raw == "") | F.lower(raw).isin(["nan", "none"]), None).when(number.isNotNull(), number.cast("long").cast("string")).otherwise(F.upper(raw))
    d = df.withColumn("purpose", code)
    sink = lookup(F.col("purpose"), SINK_PURPOSES)
    assert_none(d.where(F.col("purpose").isNotNull() & sink.isNull()).select("purpose").distinct(), "unknown purposes")
    d = d.where(sink).withColumn("ftype", lookup(F.floor(F.col(feature) / 100).cast("int"), FEATURE_TYPES))
    assert_none(d.where("ftype IS NULL").select(feature).distinct(), "unknown features")
    assert_none(d.where(F.col("ftype").isin(CONVEYANCE)).select(poly), "conveyance among sinks")
    assert_none(d.where(F.col(poly) >= 0).select(poly), "polygon ids that are not negative")
    return d.select(F.col(poly).cast("long").alias("comid"), "ftype", F.col(poly).cast("long").alias("member_comid"))


def histogram_quantiles(bins: DataFrame, low: float, width: float, at: list[float]) -> DataFrame:
    """(pct, value) from a histogram (bin, n): linear inside the bin where the share is reached.

    Bins are a small table: their number is the histogram's resolution.
    """
    up = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    b = bins.groupBy("bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(up))
    b = assert_some(b.withColumn("total", F.max("upto").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))), "empty histogram")
    q = F.explode(F.array(*[F.lit(float(x)) for x in at])).alias("pct")
    b = b.select("bin", "n", "upto", "total", q).where((F.col("pct") / 100 * F.col("total") <= F.col("upto")) & (F.col("n") > 0))
    first = b.groupBy("pct").agg(F.min(F.struct("bin", "n", "upto", "total")).alias("b"))
    part = (F.col("pct") / 100 * F.col("b.total") - (F.col("b.upto") - F.col("b.n"))) / F.col("b.n")
    return first.select("pct", (low + (F.col("b.bin") + part) * width).alias("value"))


def distribution(df: DataFrame, value: str) -> DataFrame:
    at = [0.02, 0.25, 0.5, 0.75, 0.98]
    sums = df.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    found = exact_percentiles(df, value, at).select("n", *[F.get("q", F.lit(i)).alias(f"p{int(q * 100)}") for i, q in enumerate(at)])
    return found.join(sums)  # one row each


def signal_counts(df: DataFrame, signals: list[str], floors: dict[str, int] | None = None) -> DataFrame:
    """One row: rows with any signal and with each; below a declared floor, or a declared signal
    without a row, raises."""
    any_of = F.greatest(*[F.col(s).cast("int") for s in signals]) == 1
    out = df.agg(F.count_if(any_of).alias("total"), *[F.count_if(F.col(s)).alias(s) for s in signals])
    if floors:
        row = out.first()
        low = {s: row[s] for s, least in floors.items() if row[s] < max(1, least)}
        if low:
            raise ValueError(f"below the floor: {low}")
    return out


def achieved_shares(df: DataFrame, tagged: str, achieved: str, gap: float = 20.0) -> DataFrame:
    """(resolution, tagged_pct, achieved_pct, off): shares by tag and as achieved."""
    t, a = (df.groupBy(F.col(c).alias("resolution")).agg(F.count(F.lit(1)).alias(n)) for c, n in ((tagged, "t"), (achieved, "a")))
    j = t.join(a, "resolution", "full").na.fill(0, ["t", "a"])
    n = df.agg(F.count(F.lit(1)).alias("n"))
    j = j.join(F.broadcast(n)).select("resolution", (100 * F.col("t") / F.col("n")).alias("tagged_pct"), (100 * F.col("a") / F.col("n")).alias("achieved_pct"))
    return j.withColumn("off", F.abs(F.col("tagged_pct") - F.col("achieved_pct")) > gap)


def shortfall(expected: DataFrame, present: DataFrame, key: str, limit: float = 0.3) -> DataFrame:
    """One row: expected keys, missing ones and the verdict none, warning or raise."""
    p = present.select(key).distinct().withColumn("here", F.lit(1))
    j = expected.select(key).distinct().join(p, key, "left").agg(F.count(F.lit(1)).alias("n_expected"), F.count_if(F.col("here").isNull()).alias("n_missing"))
    return j.withColumn("verdict", F.when(F.col("n_missing") == 0, "none").when(F.col("n_missing") > limit * F.col("n_expected"), "raise").otherwise("warning"))


def process_columns(catalog: DataFrame, process: str) -> DataFrame:
    """(column, param) of catalog rows (name, columns: array<struct<col, prms, processes>>, defects:
    array<string>) that feed a process; defective columns are left out, alternatives of one
    parameter come as one row in their order."""
    d = catalog.select("name", "defects", F.posexplode("columns").alias("at", "c"))
    d = d.where(F.array_contains("c.processes", process) & ~F.coalesce(F.array_contains("defects", F.col("c.col")), F.lit(False)))
    g = d.groupBy(F.col("c.prms").alias("param")).agg(F.sort_array(F.collect_list(F.struct("name", "at", F.col("c.col").alias("col")))).alias("cs"))
    return g.select(F.array_join(F.transform("cs", lambda c: c["col"]), " or ").alias("column"), "param")


def unused_columns(catalog: DataFrame) -> DataFrame:
    d = catalog.select("name", F.explode("columns").alias("c"))
    return d.where(F.size("c.processes") == 0).select("name", F.col("c.col").alias("column"))


def entries_by_builder(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("builder").agg(F.array_join(F.sort_array(F.collect_list("name")), ",").alias("entries"), F.count(F.lit(1)).alias("n"))


def layer_audit(a: DataFrame, b: DataFrame, key: str, area: str) -> DataFrame:
    """One row: rows, distinct keys, duplicates and area of a; shared keys, keys of one side only,
    and the largest and mean area difference of shared keys."""
    sums = lambda d, n: d.groupBy(key).agg(F.sum(area).alias(n))
    own = a.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_keys"), F.sum(area).alias("area")).withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))
    j = sums(a, "x").join(sums(b, "y"), key, "full")
    gap = F.abs(F.col("x") - F.col("y"))
    both = j.agg(F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()).alias("n_shared"), F.count_if(F.col("y").isNull()).alias("n_only_a"), F.count_if(F.col("x").isNull()).alias("n_only_b"), F.max(gap).alias("max_gap"), F.avg(gap).alias("mean_gap"))
    return own.join(F.broadcast(both))


def ring_screening(edges: DataFrame, zone: str = "zone_id", size: float = 1.0) -> DataFrame:
    """(zone, n_edges, area, unclosed, n_crossings): rings whose ends do not meet are unclosed: some
    corner is not as often an edge's start as an edge's end. ``n_crossings`` counts the pairs of
    edges that cross or touch without being neighbours."""
    corner = F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"), F.lit(1).alias("d")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"), F.lit(-1).alias("d")))).alias("c")
    open_ = edges.select(zone, corner).groupBy(zone, "c.x", "c.y").agg(F.sum("c.d").alias("d")).where("d <> 0").select(zone).distinct().withColumn("unclosed", F.lit(True))
    g = edges.groupBy(zone).agg(F.count(F.lit(1)).alias("n_edges"), F.abs(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"))
    g = g.join(open_, zone, "left").join(self_crossings(edges, zone, size), zone, "left")
    return g.withColumns({"unclosed": F.coalesce("unclosed", F.lit(False)), "n_crossings": F.coalesce("n_crossings", F.lit(0))})


def geometry_counts(layer: DataFrame, edges: DataFrame, zone: str = "zone_id", kind: str = "kind", size: float = 1.0) -> DataFrame:
    """(kind, n_rows, n_empty, n_zero_area, n_unclosed, n_crossing): what a layer (zone, kind) holds.

    A null kind is a row without geometry; a row without edges is empty; an area below 1e-12 is
    none. Every row of the layer counts, and a zone's edges once.
    """
    d = layer.select(zone, kind).join(ring_screening(edges, zone, size), zone, "left")
    return d.groupBy(kind).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("n_edges").isNull()).alias("n_empty"), F.count_if(F.col("area") < 1e-12).alias("n_zero_area"),
        F.count_if("unclosed").alias("n_unclosed"), F.count_if(F.col("n_crossings") > 0).alias("n_crossing"),
    )


@dataclass(frozen=True)
class Source:
    """A gridded source: its variables, the statistic of each, those with a spread, and a hook
    that runs on the series before it is aggregated."""

    variables: list[str]
    statistic: str = "masked_mean"
    spread: list[str] = field(default_factory=list)
    hook: Callable[[DataFrame], DataFrame] | None = None

    def __post_init__(self):
        if not self.variables or not set(self.spread) <= set(self.variables):
            raise ValueError("a source needs variables, and spreads among them")
        if self.statistic not in ("mean", "sum", "masked_mean", "masked_std", "masked_min", "masked_max", "masked_sum", "masked_count"):
            raise ValueError(f"statistic {self.statistic!r}")

    def aggregate(self, weights: DataFrame, grid: DataFrame, parts: int | None = None) -> DataFrame:
        from tarnworks.operators.zonal import series

        s = series(weights, grid.transform(self.hook) if self.hook else grid, self.variables, parts=parts)
        return s.select("zone_id", "date", *[F.col(f"{v}_{self.statistic}").alias(v) for v in self.variables], *[F.col(f"{v}_masked_std").alias(f"{v}_std") for v in self.spread])


RUNNERS: dict[str, Callable] = {}


def runner(tag: str):
    """Registers a parameter job under a tag; a tag that is taken raises."""

    def add(f: Callable) -> Callable:
        if tag in RUNNERS:
            raise ValueError(f"runner {tag!r} exists")
        RUNNERS[tag] = f
        return f

    return add


@runner("zonal")
def _zonal(cells: DataFrame, **_) -> DataFrame:
    from tarnworks.operators.zonal import continuous

    return continuous(cells)


@runner("soils")
def _soils(cells: DataFrame, **_) -> DataFrame:
    from tarnworks.operators.zonal import dominant, histogram

    return dominant(histogram(cells))


@runner("cover")
def _cover(cells: DataFrame, crosswalk: DataFrame, canopy: DataFrame | None = None, **_) -> DataFrame:
    from tarnworks.operators.cover import class_percentages, cover_parameters
    from tarnworks.operators.zonal import histogram

    return cover_parameters(class_percentages(histogram(cells).withColumnRenamed("class", "lu_code")), crosswalk, canopy)
