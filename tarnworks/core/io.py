"""Reading the model tables and cutting lineage in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder; the folder may be any path that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only a local session that has none (tests, a laptop) gets a folder under /tmp; on a cluster
    a missing setting raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
        found = "/tmp/checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def materialize(df: DataFrame, name: str = "table", instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage like ``checkpoint()``, but later reads can prune columns, and an
    executor that is lost takes nothing with it. The files go when the JVM ends, or when a
    later round's table is written ``instead_of`` them.
    """
    spark = df.sparkSession
    path, system = _path(spark, name)
    df.write.parquet(path.toString())
    system.deleteOnExit(path)
    found = spark.read.schema(df.schema).parquet(path.toString())
    found._written_at = path
    old = getattr(instead_of, "_written_at", None)
    if old is not None:
        system.delete(old, True)
    return found


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df``, one row a ``key``, to the shared folder in buckets of ``key`` and read it back.

    Joins on ``key`` then move the other side alone. There are as many buckets as shuffle
    partitions; the files go when the JVM ends.
    """
    spark = df.sparkSession
    path, system = _path(spark, name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    df.repartition(n, key).dropDuplicates([key]).write.bucketBy(n, key).sortBy(key).option("path", path.toString()).saveAsTable(held)
    system.deleteOnExit(path)
    return spark.table(held)
