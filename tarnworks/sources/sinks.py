"""Sinks: tables written whole, under the order and the types their readers expect."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.core.checks import assert_unique


def write_sorted(df: DataFrame, key: str, path: str) -> None:
    """One row an id, in global order of ids: range partitions, each sorted."""
    assert_unique(df, key).repartitionByRange(key).sortWithinPartitions(key).write.parquet(path)


def spread_bits(x):
    """The lower 16 bits of a column with a zero between any two."""
    x = x.cast("long").bitwiseAND(0xFFFF)
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def z_order(x, y, extent: tuple[float, float, float, float]):
    """The place of (x, y) on a Z curve of 2**16 x 2**16 cells over ``extent`` (x0, y0, x1, y1);
    points outside count in the edge cells, null places have none."""
    x0, y0, x1, y1 = extent
    cell = lambda v, lo, hi: F.least(F.greatest(F.floor((v - lo) / ((hi - lo) or 1.0) * 65536), F.lit(0)), F.lit(65535))
    code = spread_bits(cell(x, x0, x1)).bitwiseOR(F.shiftleft(spread_bits(cell(y, y0, y1)), 1))
    return F.when(x.isNotNull() & y.isNotNull(), code)


def write_layer(layer: DataFrame, path: str, files: int | None = None, group_bytes: int | None = None) -> None:
    """Write a layer with columns xmin, ymin, xmax, ymax so that readers of a box skip most of it.

    Rows follow the Z curve of their boxes' centres over the layer's extent: range partitions, each
    sorted, so that files and row groups (of ``group_bytes``) cover small boxes and their minima
    and maxima prune. Rows without bounds stand first.
    """
    e = tuple(layer.agg(*[F.min(c).cast("double") for c in ("xmin", "ymin")], *[F.max(c).cast("double") for c in ("xmax", "ymax")]).first())
    middle = lambda a, b: (F.col(a).cast("double") + F.col(b).cast("double")) / 2
    code = z_order(middle("xmin", "xmax"), middle("ymin", "ymax"), e) if None not in e else F.lit(0).cast("long")
    laid = layer.withColumn("_z", code)
    laid = laid.repartitionByRange(files, "_z") if files else laid.repartitionByRange("_z")
    out = laid.sortWithinPartitions("_z").drop("_z").write
    (out.option("parquet.block.size", group_bytes) if group_bytes else out).parquet(path)


def pinned(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The listed columns with fixed types, so that an empty table keeps its schema."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])


def publish_filled(raw: DataFrame, filled: DataFrame, path: str, raw_path: str) -> None:
    """Publish the filled table under ``path``; the raw one is kept only the first time.

    Whole numbers return to their type before filling where no value is missing.
    """
    raw.write.mode("ignore").parquet(raw_path)
    publish(restore_integers(raw, filled), path)


def publish(df: DataFrame, path: str) -> str:
    """Write ``df`` as a new version of the table ``path`` and make it the current one; returns its name.

    A version is a folder of its own, and the file ``CURRENT`` names the current one; it is replaced
    by a rename, so a reader finds the old version or the new one, whole. Older versions stay for
    those who read them; a write that fails leaves the current one as it was.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/versions/{version}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, current = (hadoop.Path(f"{path}/{name}") for name in (f".new-{version}", "CURRENT"))
    files = hadoop.FileContext.getFileContext(current.toUri(), spark._jsc.hadoopConfiguration())
    out = new.getFileSystem(spark._jsc.hadoopConfiguration()).create(new)
    out.write(bytearray(version.encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    files.rename(files.makeQualified(new), files.makeQualified(current), over)
    return version


def published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that ``publish`` writes; raises where there is none."""
    version = spark.read.text(f"{path}/CURRENT").first()["value"]
    return spark.read.parquet(f"{path}/versions/{version}")


def restore_integers(raw: DataFrame, filled: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in raw.schema if f.dataType.typeName() in ("integer", "long", "short", "byte")}
    names = [c for c in filled.columns if c in kinds]
    if not names:
        return filled
    nulls = filled.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first()
    return filled.withColumns({c: F.round(c).cast(kinds[c]) for c in names if not nulls[c]})


def constant_parameter(ids: DataFrame, key: str, name: str, value: float = 1.0) -> DataFrame:
    return ids.select(key, F.lit(value).alias(name))


def checked_copy(df: DataFrame, key: str, expected: int) -> DataFrame:
    """A table that has its key once a row and the expected rows, at least one."""
    n = assert_unique(df, key).count()
    if not n or n != expected:
        raise ValueError(f"{n} rows; {expected} expected")
    return df


def flatten_library(library: DataFrame) -> DataFrame:
    """(ndeplval, deplcrv_id, value) of (deplcrv_id, curve): curves by id, each from SWE 0 up.

    Ids must be 1..n and values finite.
    """
    size = library.agg(F.count(F.lit(1)).alias("n"), F.min("deplcrv_id").alias("a"), F.max("deplcrv_id").alias("b"), F.countDistinct("deplcrv_id").alias("d")).first()
    if not size["n"] or (size["a"], size["b"], size["d"]) != (1, size["n"], size["n"]):
        raise ValueError(f"curve ids are not 1..n: {tuple(size)}")
    flat = library.select("deplcrv_id", F.posexplode(F.reverse("curve")).alias("at", "value"))
    if not flat.where(F.col("value").isNull() | F.isnan("value") | (F.abs("value") == float("inf"))).isEmpty():
        raise ValueError("a curve holds no finite value")
    return flat.select(((F.col("deplcrv_id") - 1) * 11 + F.col("at")).cast("long").alias("ndeplval"), "deplcrv_id", "value")


PROVENANCE = ["comid", "method", "dprst_depth_m", "resolution", "ftype", "ecoregion", "measured_max_m", "hollister_max_m", "geom"]


def provenance_rows(depths: DataFrame) -> DataFrame:
    """The provenance columns that the depth table has."""
    return depths.select(*[c for c in PROVENANCE if c in depths.columns])
