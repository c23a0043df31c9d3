"""The corpus pipeline: language ID, near duplicates, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.core.io import materialize, table
from tarnworks.llm import dedup, langid, packing, secretscan


#: What a row's language depends on.
JUDGED = ["doc_id", "text", "lang", "source"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not accepted go; ``lang`` is the identified one.

    Each row has its own verdict, whether its id is null or repeated: verdicts meet the rows by
    128 bits of hash over all that they depend on.
    """
    parts = [x for c in JUDGED for x in (F.col(c).isNull(), F.col(c))]
    key = {"row_a": F.xxhash64(*parts), "row_b": F.xxhash64(F.lit(1), *parts)}
    keyed = docs.withColumns(key)
    judged = langid.identify(keyed, None, docs, keep=tuple(key)).where("accepted")
    verdict = judged.select(*key, F.col("predicted").alias("found")).dropDuplicates([*key])
    return keyed.join(verdict, [*key]).withColumn("lang", F.col("found")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id. Rows
    with a null id are linked with nothing and stay."""
    kept = dedup.near_components(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are redacted; every document stays."""
    return secretscan.redact(docs, *secretscan.fitted(docs, table(spark, sf_dir, "labels")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secret_scan", secrets), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
