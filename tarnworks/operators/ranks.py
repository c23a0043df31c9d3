"""Global ranks and exact percentiles without a global window: range partitions, each numbered by
itself, moved by the counts of the partitions before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.core.io import materialize


def numbered(df: DataFrame, order: list[str], name: str = "number", by: list[str] | None = None) -> DataFrame:
    """Adds ``name``: each row's place from 0 in the order of ``order``, over all rows or inside the
    groups of ``by`` (nulls are a group); ties in any order. A group may span any number of tasks.

    The partitions are written before they are counted, so that both readings agree.
    """
    by = by or []
    part = materialize(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), "rank-ranges")
    before = Window.partitionBy(*(by or [F.lit(1)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = part.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"))  # a row a group and partition
    sizes = sizes.select(F.col("_part").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)])
    same = [F.col("_part") == F.col("_at"), *[F.equal_null(c, F.col(f"_by{i}")) for i, c in enumerate(by)]]
    inside = F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order)) - 1
    found = part.withColumn("_inside", inside).join(sizes, same)
    return found.select(*df.columns, (F.col("_offset") + F.col("_inside")).cast("long").alias(name))


def exact_percentiles(df: DataFrame, value: str, at: list[float], by: list[str] | None = None) -> DataFrame:
    """(by ..., n, q): per group the number of valid values and, as an array, their linear
    percentiles (shares from 0 to 1), in the order of ``at``.

    Equal values are counted before they move; of distinct values, range partitions hold running
    counts, so neither a group nor a frequent value has to fit in a task. Without groups there is
    one row, of nulls where there is no value.
    """
    by = by or []
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    part = materialize(counts.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id()), "percentile-ranges")
    sizes = part.groupBy(*by, "_part").agg(F.sum("_n").alias("_size"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns({"_offset": F.coalesce(F.sum("_size").over(before), F.lit(0)), "n": F.sum("_size").over(group)}).drop("_size")
    sizes = sizes.withColumnsRenamed({"_part": "_at"} | {c: f"_by{i}" for i, c in enumerate(by)})
    sizes = materialize(sizes, "percentile-sizes") if by else sizes  # written, the smaller side is seen to be smaller
    same = [F.col("_part") == F.col("_at"), *[F.equal_null(c, F.col(f"_by{i}")) for i, c in enumerate(by)]]
    own = part.join(sizes, same).select(*by, "_part", "_v", "_n", "_offset", "n")
    upto = F.col("_offset") + F.sum("_n").over(Window.partitionBy(*by, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    own = own.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_n"))
    place = lambda q: q * (F.col("n") - 1)
    holds = lambda i: (F.col("_from") <= i) & (i < F.col("_upto"))
    asked = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(at)])
    hits = F.filter(asked, lambda x: holds(F.floor(place(x["q"]))) | holds(F.ceil(place(x["q"]))))
    own = own.select(*by, "n", "_v", "_from", "_upto", F.explode(hits).alias("x"))
    low, high = F.floor(place(F.col("x.q"))), F.ceil(place(F.col("x.q")))
    ends = own.groupBy(*by, "x").agg(F.max("n").alias("n"), F.max(F.when(holds(low), F.col("_v"))).alias("a"), F.max(F.when(holds(high), F.col("_v"))).alias("b"))
    between = F.col("a") + (F.col("b") - F.col("a")) * (place(F.col("x.q")) - low)
    found = ends.groupBy(*by).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("x.i", between.alias("v")))).alias("q"))
    return found.select(*by, F.coalesce("n", F.lit(0)).alias("n"), F.transform("q", lambda x: x["v"]).alias("q"))


def weighted_quantiles(df: DataFrame, value: str, weight: str, at: list[float], by: list[str]) -> DataFrame:
    """(by ..., q): per group, for each share of ``at``, the smallest value whose weight, summed from
    below, reaches that share of the group's weight.

    ``df`` has a row for each distinct value of a group; nulls are left out. Rows are range-partitioned
    by group and value; a partition holds running weights, moved by the sums of those before, so
    that a group of any size is spread over tasks.
    """
    part = materialize(df.where(F.col(value).isNotNull()).repartitionByRange(*by, value).withColumn("_part", F.spark_partition_id()), "quantile-ranges")
    group = Window.partitionBy(*by)  # a row a partition
    sizes = part.groupBy(*by, "_part").agg(F.sum(weight).alias("_size"))
    sizes = sizes.withColumns({"_offset": F.coalesce(F.sum("_size").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "_all": F.sum("_size").over(group)}).drop("_size")
    # A partition holds few groups or a piece of one, so sizes has about a row a group and partition.
    sizes = sizes.withColumnsRenamed({"_part": "_at"} | {c: f"_by{i}" for i, c in enumerate(by)})
    same = [F.col("_part") == F.col("_at"), *[F.equal_null(c, F.col(f"_by{i}")) for i, c in enumerate(by)]]
    upto = F.sum(weight).over(Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    own = part.withColumn("_upto", upto).join(sizes, same).withColumn("_share", (F.col("_offset") + F.col("_upto")) / F.col("_all"))
    cuts = [F.min(F.when(F.col("_share") >= q - 1e-12, F.col(value))) for q in at]
    return own.groupBy(*by).agg(F.array(*cuts).alias("q"))
