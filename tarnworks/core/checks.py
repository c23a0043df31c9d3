"""Checks that raise before a job's result is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df


def resolve_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename columns to the given spelling where they differ in case alone; a name that no
    column matches raises with the fields. An exact match wins over others."""
    rename = {}
    for name in names:
        found = [c for c in df.columns if c == name] or [c for c in df.columns if c.lower() == name.lower()]
        if not found:
            raise ValueError(f"no column {name!r} among {df.columns}")
        rename[found[0]] = name
    others = [c for c in df.columns if c not in rename and c.lower() in {n.lower() for n in names}]
    return df.drop(*others).withColumnsRenamed(rename)


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """(key, count) of keys on more than one row."""
    return df.groupBy(key).count().where("count > 1")


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    found = duplicate_keys(df, key).orderBy(key).limit(10).collect()
    if found:
        raise ValueError(f"{key} repeats: {[r[key] for r in found]}")
    return df


def assert_none(bad: DataFrame, what: str) -> None:
    """Raise with the first ten rows if ``bad`` has any."""
    found = bad.limit(10).collect()
    if found:
        raise ValueError(f"{what}: {[tuple(r) for r in found]}")


def assert_some(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df


def strict_cast(df: DataFrame, column: str, to: str) -> DataFrame:
    """Cast a column; a value that is not null and does not parse raises."""
    parsed = F.expr(f"try_cast(`{column}` AS {to})")
    assert_none(df.where(F.col(column).isNotNull() & parsed.isNull()).select(column), f"{column} does not parse as {to}")
    return df.withColumn(column, parsed)


def missing_ids(df: DataFrame, key: str) -> DataFrame:
    """(key) of 1 .. max that no row has; at least one id is expected."""
    top = df.agg(F.max(key)).first()[0] or 0
    return df.sparkSession.range(1, top + 1).select(F.col("id").alias(key)).join(df.select(key), key, "left_anti")


def lookup(column: Column, table: dict) -> Column:
    """A fixed small table as an expression; null where it has no entry."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), column)
