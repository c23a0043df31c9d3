"""Depletion curves from daily snow of zones, and the fitted curve library.

Days of a zone and water year are handled by windows and arrays of that group: at most 366
rows, whatever the number of zones and years.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import materialize
from tarnworks.operators.ranks import exact_percentiles, numbered

from tarnworks.functions.scalar import SWE_LEVELS, clipped, interpolate, running_minimum, water_year

POINTS = "array<struct<x:double,y:double>>"


def with_water_year(daily: DataFrame, date: str = "date") -> DataFrame:
    return daily.withColumn("wy", water_year(F.col(date)))


def melt_seasons(daily: DataFrame, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """Days from the first one of a water year's largest snow to the next one without snow.

    Years without snow, with the largest snow on the first day of their record, or that never
    melt out have no season. A null day is neither peak nor end.
    """
    year = Window.partitionBy(zone, "wy")
    up = year.orderBy(date)
    d = with_water_year(daily, date).withColumn("top", F.max("swe").over(year)).withColumn("first_day", F.min(date).over(year))
    d = d.withColumn("peak_day", F.min(F.when(F.col("swe") == F.col("top"), F.col(date))).over(year))
    d = d.withColumn("end_day", F.min(F.when((F.col(date) >= F.col("peak_day")) & (F.col("swe") <= 0), F.col(date))).over(year))
    kept = d.where("top > 0 AND peak_day > first_day AND end_day IS NOT NULL").where((F.col(date) >= F.col("peak_day")) & (F.col(date) <= F.col("end_day")))
    return kept.withColumn("day", F.row_number().over(up)).select(zone, "wy", date, "day", "swe", "sca")


def without_reversals(season: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Days whose cover is at most the smallest so far: later snowfall is taken out. Days with
    unknown cover go."""
    so_far = Window.partitionBy(zone, "wy").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return season.where("sca IS NOT NULL").withColumn("low", F.min("sca").over(so_far)).where("sca <= low").drop("low")


def normalised(season: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Snow and cover relative to their first day; 0 where that is 0."""
    first = Window.partitionBy(zone, "wy").orderBy("day")
    rel = lambda c: F.when(F.first(c).over(first) > 0, F.col(c) / F.first(c).over(first)).otherwise(0.0)
    return season.withColumns({"swe_n": rel("swe"), "sca_n": rel("sca"), "sca_first": F.first("sca").over(first)})


def annual_curves(daily: DataFrame, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """(zone, wy, curve): cover at 11 snow levels from 1.0 to 0.0, never rising, within [0, 1].

    A season with fewer than two days left or without cover at its peak has no curve.
    """
    n = normalised(without_reversals(melt_seasons(daily, zone, date), zone), zone)
    points = F.transform(F.sort_array(F.collect_list(F.struct("swe_n", "day", "sca_n"))), lambda p: F.struct(p["swe_n"].alias("x"), p["sca_n"].alias("y")))
    g = n.groupBy(zone, "wy").agg(points.alias("points"), F.count(F.lit(1)).alias("n"), F.first("sca_first").alias("top"))
    g = g.where("n >= 2 AND top > 0")
    curve = F.array(*[interpolate(F.col("points"), F.lit(x)) for x in SWE_LEVELS])
    return g.select(zone, "wy", clipped(running_minimum(curve)).alias("curve"))


def median_curve(curves: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, level, median): the median over seasons at each of the levels."""
    flat = curves.select(zone, "wy", F.posexplode("curve").alias("level", "value"))
    return flat.groupBy(zone, "level").agg(F.median("value").alias("median"))


def season_distances(curves: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, wy, distance): mean distance of a season's curve from the median curve."""
    flat = curves.select(zone, "wy", F.posexplode("curve").alias("level", "value"))
    return flat.join(median_curve(curves, zone), [zone, "level"]).groupBy(zone, "wy").agg(F.avg(F.abs(F.col("value") - F.col("median"))).alias("distance"))


def similarity(curves: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, similarity, n_seasons): the mean of the seasons' distances."""
    return season_distances(curves, zone).groupBy(zone).agg(F.avg("distance").alias("similarity"), F.count(F.lit(1)).alias("n_seasons"))


def median_distances(curves: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, similarity, n_seasons, own): the two above and the representative curve in one pass
    over a zone's seasons, kept as an array of the zone's years."""
    one = curves.groupBy(zone).agg(
        F.array(*[F.median(F.col("curve")[i]) for i in range(len(SWE_LEVELS))]).alias("median"), F.sort_array(F.collect_list(F.struct("wy", "curve"))).alias("seasons")
    )
    gap = lambda c: F.aggregate(F.zip_with(c, "median", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: s + x) / len(SWE_LEVELS)
    d = one.withColumn("d", F.transform("seasons", lambda s: F.struct(F.round(gap(s["curve"]), 12).alias("rounded"), s["wy"].alias("wy"), gap(s["curve"]).alias("gap"), s["curve"].alias("curve"))))
    total = F.aggregate("d", F.lit(0.0), lambda s, x: s + x["gap"])
    return d.select(zone, (total / F.size("d")).alias("similarity"), F.size("d").cast("long").alias("n_seasons"), F.array_min("d")["curve"].alias("own"))


def representative(curves: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, wy, curve): the season with the least distance, the first on ties (to 12 places)."""
    d = season_distances(curves, zone).groupBy(zone).agg(F.min(F.struct(F.round("distance", 12).alias("d"), "wy")).alias("best"))
    return curves.join(d.select(zone, F.col("best.wy").alias("wy")), [zone, "wy"])


def peak_statistics(daily: DataFrame, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """(zone, cv_subgrid, peak_swe_mm, n_peak_years) from each water year's first peak day; years
    without snow or without a spread on that day are left out."""
    first = Window.partitionBy(zone, "wy").orderBy(F.desc("swe"), date)
    d = with_water_year(daily, date).where("swe IS NOT NULL").withColumn("r", F.row_number().over(first)).where("r = 1 AND swe > 0 AND swe_std IS NOT NULL")
    return d.groupBy(zone).agg(F.median(F.col("swe_std") / F.col("swe")).alias("cv_subgrid"), F.median("swe").alias("peak_swe_mm"), F.count(F.lit(1)).alias("n_peak_years"))


def constant_cover(daily: DataFrame, zone: str = "zone_id") -> DataFrame:
    """(zone, constant_frac): share of the days with snow whose cover is the largest; 1 without snow."""
    snow = F.col("swe") > 0
    top = F.max(F.when(snow, F.col("sca"))).over(Window.partitionBy(zone))
    d = daily.withColumn("top", top)
    return d.groupBy(zone).agg(F.coalesce(F.avg(F.when(snow, (F.col("sca") >= F.col("top") - 1e-9).cast("double"))), F.lit(1.0)).alias("constant_frac"))


#: Limits of the selection: fixed values of the parameter rules.
LIMITS = {"min_cells": 15, "max_water_frac": 0.5, "min_seasonal_sca": 0.5, "max_constant_frac": 0.8, "max_similarity": 0.10}


def selection_status(limits: dict = LIMITS):
    """Status column over has_snow, n_cells, water_frac, sca_max, constant_frac, similarity: the
    first test that fails, else derived."""
    return (
        F.when(~F.col("has_snow"), "default_no_snow")
        .when(F.col("n_cells") < limits["min_cells"], "default_too_few_cells")
        .when(F.col("water_frac") > limits["max_water_frac"], "default_water_dominated")
        .when(F.col("sca_max") < limits["min_seasonal_sca"], "default_low_sca")
        .when(F.col("constant_frac") > limits["max_constant_frac"], "default_constant_sca")
        .when(F.col("similarity").isNull() | (F.col("similarity") > limits["max_similarity"]), "default_dissimilar")
        .otherwise("derived")
    )


#: Cover at half the snow below which a curve is low, above which it is high.
CLASS_LIMITS = (0.45, 0.55)


def curve_class(curve):
    """low, mid or high by the cover at half the snow."""
    half = F.element_at(curve, 6)
    return F.when(half < CLASS_LIMITS[0], "low").when(half > CLASS_LIMITS[1], "high").otherwise("mid")


def zone_records(daily: DataFrame, cells: DataFrame, water: DataFrame, default_curve: list[float], limits: dict = LIMITS, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """One row a zone: status, class, similarity, seasons, peak statistics and the curve.

    ``cells`` is (zone, n_cells) and ``water`` (zone, water_frac), 0 where missing. Without a
    ``swe_std`` column the peak statistics are null.
    """
    from tarnworks.core.io import materialize

    # The curves are a row a zone and year: written once, read by every step that follows.
    curves = materialize(annual_curves(daily, zone, date), "annual-curves")
    own = median_distances(curves, zone)
    per_zone = daily.groupBy(zone).agg((F.coalesce(F.max("swe"), F.lit(0.0)) > 0).alias("has_snow"), F.coalesce(F.max("sca"), F.lit(0.0)).alias("sca_max"))
    d = per_zone.join(constant_cover(daily, zone), zone).join(own, zone, "left")
    d = d.join(cells.select(zone, "n_cells"), zone, "left").join(water.select(zone, "water_frac"), zone, "left").fillna({"n_cells": 0, "water_frac": 0.0, "n_seasons": 0})
    d = d.withColumn("sdc_status", selection_status(limits))
    d = d.withColumn("curve", F.when(F.col("sdc_status") == "derived", F.col("own")).otherwise(F.array(*[F.lit(float(x)) for x in default_curve])))
    if "swe_std" in daily.columns:
        d = d.join(peak_statistics(daily, zone, date), zone, "left").fillna({"n_peak_years": 0})
    else:
        d = d.withColumns({"cv_subgrid": F.lit(None).cast("double"), "peak_swe_mm": F.lit(None).cast("double"), "n_peak_years": F.lit(0).cast("long")})
    return d.select(zone, "sdc_status", curve_class(F.col("curve")).alias("sca_class"), "similarity", "n_seasons", "n_peak_years", "peak_swe_mm", "cv_subgrid", "curve")


def lognormal_curve(cv: np.ndarray) -> np.ndarray:
    """Cover at the 11 snow levels of a lognormal snow distribution with these coefficients of
    variation, under uniform melt (one row a coefficient)."""
    from math import erf

    phi = np.vectorize(lambda x: 0.5 * (1 + erf(x / np.sqrt(2))))
    out = []
    for c in np.maximum(np.asarray(cv, float), 1e-4):
        zeta = np.sqrt(np.log1p(c * c))
        melt_log = np.linspace(-6 * zeta, 6 * zeta, 4000)
        cover = phi((-zeta * zeta / 2 - melt_log) / zeta)
        snow = phi((zeta * zeta / 2 - melt_log) / zeta) - np.exp(melt_log) * cover
        x, y = np.append(snow[::-1], 1.0), np.append(cover[::-1], 1.0)
        if x[0] > 0:
            x, y = np.insert(x, 0, 0.0), np.insert(y, 0, 0.0)
        out.append(np.clip(np.interp(SWE_LEVELS, x, y), 0, 1))
    return np.array(out)


#: Curves that a task keeps: some tens of megabytes.
CURVES = 100_000


def curve_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The curves of a task's coefficients, batch by batch. Each is made once, as long as the task has
    met at most ``CURVES`` of them."""
    made: dict[float, np.ndarray] = {}
    for values in batches:
        new = [v for v in values.dropna().unique() if v not in made]
        if len(made) + len(new) > CURVES:
            made, new = {}, values.dropna().unique()
        made.update(zip(new, lognormal_curve(new)))
        yield pd.Series([None if pd.isna(v) else made[v] for v in values], index=values.index)


def lognormal_curves(rows: DataFrame, cv: str = "cv") -> DataFrame:
    """Adds ``curve`` to rows with a coefficient of variation; null where that is null."""

    @F.pandas_udf("array<double>")
    def curve(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return curve_batches(batches)

    return rows.withColumn("curve", curve(F.col(cv)))


def cv_grid(spark) -> DataFrame:
    """(cv, curve) for 60 coefficients from 0.05 to 3.0: a table of fixed size."""
    grid = [round(0.05 * i, 2) for i in range(1, 61)]
    return spark.createDataFrame([(c, [float(x) for x in row]) for c, row in zip(grid, lognormal_curve(np.array(grid)))], "cv double, curve array<double>")


def best_cv(curves: DataFrame, key: str = "zone_id", curve: str = "curve") -> DataFrame:
    """(key, cv_empirical): the grid's coefficient whose curve is nearest over the nine inner
    levels, the smallest on ties. Each row meets the grid's 60 rows."""
    grid = cv_grid(curves.sparkSession).select(F.col("cv").alias("g"), F.slice("curve", 2, 9).alias("lib"))
    d = curves.select(key, F.slice(curve, 2, 9).alias("own")).join(F.broadcast(grid))
    gap = F.aggregate(F.zip_with("own", "lib", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return d.groupBy(key).agg(F.min(F.struct(F.round(gap, 12).alias("gap"), "g")).alias("m")).select(key, F.col("m.g").alias("cv_empirical"))


def equal_bins(rows: DataFrame, value: str, bins: int, key: str) -> DataFrame:
    """Adds ``bin`` (0 ..) of equal population by rank of value, ties by key.

    The rank is global: values are range-partitioned, numbered inside a partition, and moved by
    the counts of the partitions before. Fewer values than bins raise; null values go.
    """
    ranked = numbered(rows.where(F.col(value).isNotNull()), [value, key], "rank")
    total = rows.where(F.col(value).isNotNull()).count()
    if total < bins:
        raise ValueError(f"{total} values for {bins} bins")
    return ranked.withColumn("bin", F.floor(F.col("rank") * bins / total).cast("int")).drop("rank")


def curve_library(rows: DataFrame, bins: int, default_curve: list[float], key: str = "zone_id", cv: str = "cv") -> DataFrame:
    """(deplcrv_id, curve_kind, cv, curve): id 1 the default curve, then one for each bin's median."""
    b = equal_bins(rows.select(key, cv), cv, bins, key)
    medians = exact_percentiles(b, cv, [0.5], ["bin"]).select((F.col("bin") + 2).alias("deplcrv_id"), F.lit("cv_bin").alias("curve_kind"), F.get("q", F.lit(0)).alias("cv"))
    first = rows.sparkSession.createDataFrame([(1, "default", None, [float(x) for x in default_curve])], "deplcrv_id int, curve_kind string, cv double, curve array<double>")
    return lognormal_curves(medians).unionByName(first)


def nearest_curve(rows: DataFrame, library: DataFrame, cv: str = "cv") -> DataFrame:
    """Adds ``hru_deplcrv``: the bin with the nearest coefficient, the first on ties; 1 for null.

    The library has one row a bin: its medians become one array beside every row.
    """
    bins = library.where("curve_kind = 'cv_bin'").agg(F.sort_array(F.collect_list(F.struct("deplcrv_id", "cv"))).alias("bins"))
    gaps = F.transform("bins", lambda x: F.struct(F.abs(x["cv"] - F.col(cv)).alias("gap"), x["deplcrv_id"].alias("id")))
    finite = F.col(cv).isNotNull() & ~F.isnan(cv)
    return rows.join(F.broadcast(bins)).withColumn("hru_deplcrv", F.when(finite, F.array_min(gaps)["id"]).otherwise(F.lit(1)).cast("int")).drop("bins")


def quantile_calibration(rows: DataFrame, sub: str = "cv_subgrid", emp: str = "cv_empirical", mode: str = "auto", tolerance: float = 0.1) -> tuple[DataFrame, dict]:
    """(rows with ``cv_calibrated``, report): the sub-grid coefficient mapped by quantiles.

    Trained on rows that have both; 101 quantiles a side, x without repeats. auto: only when
    the medians differ by more than ``tolerance``. Fewer than two rows or distinct quantiles:
    the coefficient stays.
    """
    if mode not in ("auto", "on", "off"):
        raise ValueError(f"mode {mode!r}")
    steps = [i / 100 for i in range(101)]
    both = rows.where(F.col(sub).isNotNull() & F.col(emp).isNotNull())
    x, y = (exact_percentiles(both, c, steps).first() for c in (sub, emp))
    s = {"n": x["n"], "x": x["q"] or [], "y": y["q"] or [], "ms": x["q"][50] if x["n"] else None, "me": y["q"][50] if x["n"] else None}
    report = {"n_derived_overlap": s["n"], "cv_subgrid_median": s["ms"], "cv_empirical_median": s["me"], "calibrated": False}
    bias = abs(s["ms"] - s["me"]) if s["n"] else None
    out = rows.withColumn("cv_calibrated", F.col(sub))
    if s["n"] >= 2 and (mode == "on" or (mode == "auto" and bias > tolerance)):
        points = {}
        for x, y in zip(s["x"], s["y"]):
            points.setdefault(x, y)
        if len(points) >= 2:
            known = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in sorted(points.items())])
            out = rows.withColumn("cv_calibrated", F.when(F.col(sub).isNotNull(), interpolate(known, F.col(sub))))
            report["calibrated"] = True
    return out, report


def reconstruction_error(rows: DataFrame, cv: str, curve: str) -> DataFrame:
    """(mean_error, p95_error): of the lognormal curve against each row's own."""
    d = lognormal_curves(rows.where(F.col(cv).isNotNull() & F.col(curve).isNotNull()).select(F.col(cv).alias("cv"), F.col(curve).alias("own")))
    gaps = F.zip_with("own", "curve", lambda a, b: F.abs(a - b))
    d = d.select(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x).alias("sum"), F.array_max(gaps).alias("top"))
    d = materialize(d, "reconstruction")
    top = exact_percentiles(d, "top", [0.95]).select(F.get("q", F.lit(0)).alias("p95_error"))
    return d.agg((F.sum("sum") / (11 * F.count(F.lit(1)))).alias("mean_error")).join(top)  # one row each


def library_pipeline(records: DataFrame, bins: int, default_curve: list[float], mode: str = "auto", zone: str = "zone_id") -> tuple[DataFrame, DataFrame, dict]:
    """(library, parameters, report) from zone records: fit, calibrate, bin, assign, assemble."""
    from tarnworks.functions.scalar import threshold_inches

    # Records and their fits are read by several steps: written once each.
    records = materialize(records, "zone-records")
    fitted = best_cv(records.where("sdc_status = 'derived'"), zone)
    rows, report = quantile_calibration(materialize(records.join(fitted, zone, "left"), "fitted-records"), mode=mode)
    source = F.when(F.col("cv_calibrated").isNotNull(), "subgrid_calibrated" if report["calibrated"] else "subgrid").when(F.col("cv_empirical").isNotNull(), "empirical").otherwise("default_no_snow")
    rows = materialize(rows.withColumns({"cv_assign": F.coalesce("cv_calibrated", "cv_empirical"), "cv_source": source}), "library-rows")
    library = materialize(curve_library(rows, bins, default_curve, zone, "cv_assign"), "curve-library")
    placed = nearest_curve(rows, library, "cv_assign").drop("curve")
    curves = library.select(F.col("deplcrv_id").alias("hru_deplcrv"), "curve")
    out = placed.join(F.broadcast(curves), "hru_deplcrv").select(
        zone, "hru_deplcrv", threshold_inches(F.col("peak_swe_mm")).alias("snarea_thresh"), "cv_assign", "cv_subgrid", "cv_empirical", "cv_source", "sdc_status", "sca_class", "similarity", "n_seasons", "n_peak_years", "peak_swe_mm", "curve"
    )
    return library, out, report


def status_shares(records: DataFrame) -> DataFrame:
    n = records.groupBy("sdc_status").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def best_year(curves: DataFrame, daily: DataFrame, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """(zone, wy): of the water years with a curve the one with the highest peak, first on ties."""
    peak = with_water_year(daily, date).groupBy(zone, "wy").agg(F.max("swe").alias("peak"))
    return curves.join(peak, [zone, "wy"]).groupBy(zone).agg(F.max_by("wy", F.struct("peak", -F.col("wy"))).alias("wy"))
