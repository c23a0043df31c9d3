"""Subsurface flux parameters from permeability, slope and area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.checks import assert_none
from tarnworks.functions.scalar import degrees_to_fraction

#: log10 permeability that stands for 0: a fixed value of the parameter rules.
K_PERM_MIN = -16.48


def permeability(weights: DataFrame, lith: DataFrame, zone: str = "zone_id", k_min: float = K_PERM_MIN) -> DataFrame:
    """(zone, k_perm_wtd): 10 ** k of each source weighted by its overlapped share."""
    w = weights.join(lith.select("flux_id", "k_perm"), "flux_id")
    k = F.when(F.col("k_perm") == 0, k_min).otherwise(F.col("k_perm"))
    return w.groupBy(zone).agg(F.sum(F.pow(F.lit(10.0), k) * F.col("area_weight") / F.col("flux_id_area")).alias("k_perm_wtd"))


def raw_parameters(perm: DataFrame, slope: DataFrame, area: DataFrame, zone: str = "zone_id") -> DataFrame:
    """The seven raw parameters; an id without slope (degrees) or area raises."""
    d = perm.join(slope.select(zone, degrees_to_fraction(F.col("mean")).alias("s")), zone, "left").join(area.select(zone, "area"), zone, "left")
    assert_none(d.where("s IS NULL OR area IS NULL").select(zone), "no slope or area")
    k, s = F.col("k_perm_wtd"), F.col("s")
    slow, seep = k * s / F.col("area"), k * (1 - s)
    return d.select(
        zone,
        F.pow(k, 3).alias("soil2gw_max"),
        seep.alias("ssr2gw_rate"),
        slow.alias("slowcoef_lin"),
        (2 * slow).alias("fastcoef_lin"),
        slow.alias("gwflow_coef"),
        seep.alias("dprst_seep_rate_open"),
        (2 * slow).alias("dprst_flow_coef"),
    )


def rescale(df: DataFrame, ranges: dict[str, tuple[float, float]], batch: str | None = None) -> DataFrame:
    """Each column moved linearly to its range, per batch or over all rows; a column without
    spread takes the middle of its range."""
    ends = [f(c).alias(f"_{n}_{c}") for c in ranges for n, f in (("lo", F.min), ("hi", F.max))]
    if batch is None:  # one row of bounds
        df = df.join(F.broadcast(df.agg(*ends)))
    else:  # a row of bounds a batch; the rows of a batch do not have to meet in one task
        bounds = df.groupBy(F.col(batch).alias("_batch")).agg(*ends)
        df = df.join(bounds, F.equal_null(batch, "_batch"), "left").drop("_batch")
    out = {}
    for c, (low, high) in ranges.items():
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        out[c] = F.when(hi == lo, (low + high) / 2).otherwise((F.col(c) - lo) / (hi - lo) * (high - low) + low)
    return df.withColumns(out).drop(*[f"_{n}_{c}" for c in ranges for n in ("lo", "hi")])
