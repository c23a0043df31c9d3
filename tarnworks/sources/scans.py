"""Scans: Parquet and CSV tables of the model, with the checks their readers make."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.core.checks import assert_none, assert_some, duplicate_keys, require_columns


def scan_layer(spark: SparkSession, path: str, columns: list[str], where: str | None = None, bbox: tuple | None = None, geom: str | None = None) -> DataFrame:
    """Columns of a layer's rows under a filter and a bounding box; rows without geometry go.

    The box meets rows whose columns xmin, ymin, xmax, ymax touch it, so that Parquet prunes
    files and row groups; ``sinks.write_layer`` lays a layer out for that.
    """
    df = spark.read.parquet(path)
    if bbox:
        x0, y0, x1, y1 = bbox
        df = df.where((F.col("xmax") >= x0) & (F.col("xmin") <= x1) & (F.col("ymax") >= y0) & (F.col("ymin") <= y1))
    if where:
        df = df.where(where)
    if geom:
        df = df.where(F.col(geom).isNotNull() & (F.length(geom) > 0))
    return df.select(*columns)


def scan_cells(cells: DataFrame, grids: DataFrame) -> DataFrame:
    """Valid cells of each grid with their centre; a grid's nodata and NaN are missing.

    ``grids`` has a row a grid: metadata whose number of rows does not grow with the cells.
    """
    g = grids.select("grid_id", "nodata", "a", "c", "e", "f")
    valid = F.col("value").isNotNull() & ~F.isnan("value") & (F.col("nodata").isNull() | (F.col("value") != F.col("nodata")))
    return (
        cells.join(g, "grid_id")
        .where(valid)
        .select("grid_id", "row", "col", "value", (F.col("c") + (F.col("col") + 0.5) * F.col("a")).alias("x"), (F.col("f") + (F.col("row") + 0.5) * F.col("e")).alias("y"))
    )


def scan_years(series: DataFrame, years: list[int] | None = None, date: str = "date") -> DataFrame:
    """A daily series with its year, of some years; no row at all raises."""
    df = series.withColumn("year", F.year(date))
    if years:
        df = df.where(F.col("year").isin(years))
    return assert_some(df, f"years {years}")


def scan_parameter_csv(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    return require_columns(spark.read.schema(schema).csv(path, header=True), [key])


CROSSWALK = ["lu_code", "lu_desc", "nhm_cov_type", "srain_intcp", "wrain_intcp", "snow_intcp", "nhm_covden_win", "evergreen_retention"]


def checked_crosswalk(crosswalk: DataFrame) -> DataFrame:
    """A land-cover crosswalk that has all columns and each code once."""
    require_columns(crosswalk, CROSSWALK)
    assert_none(duplicate_keys(crosswalk, "lu_code"), "lu_code repeats")
    return crosswalk.select(*CROSSWALK)


def union_parts(parts: dict[str, DataFrame], geom: str | None = None) -> DataFrame:
    """All parts' rows with the part's name as ``part``; no part at all raises."""
    if not parts:
        raise ValueError("no part to merge")
    out = None
    for name, df in parts.items():
        if geom:
            df = df.where(F.col(geom).isNotNull())
        df = df.withColumn("part", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def offset_ids(rows: DataFrame, folder: str, local_id: str, out: str = "zone_id", skip: tuple[str, ...] = ("rOR",)) -> DataFrame:
    """National ids: a region's local id plus the rows of the regions before it.

    Regions are ordered by the number, then the suffix, of folders like r10U; ``skip`` are left out.
    """
    kept = rows.where(~F.col(folder).isin(list(skip)))
    counts = kept.groupBy(folder).agg(F.count(F.lit(1)).alias("n"))
    number, suffix = F.regexp_extract(folder, r"^r(\d+)", 1).cast("int"), F.regexp_extract(folder, r"^r\d+(.*)$", 1)
    before = Window.orderBy(number, suffix).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).select(folder, "offset")
    return kept.join(offsets, folder).withColumn(out, F.col(local_id) + F.col("offset")).drop("offset")


def select_tables(dictionary: DataFrame, tables: DataFrame, dimension: str, name: str = "parameter") -> DataFrame:
    """Rows of tables that the dictionary lists under a dimension."""
    return tables.join(dictionary.where(F.col("dimensions") == dimension).select(name), name, "left_semi")
