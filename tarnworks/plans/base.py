"""Registration of queries and the model tables that they read.

A model table is a deterministic SELECT over the driver tables, so that it grows with them
and DuckDB builds the same rows for the SQL side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tarnworks.core.io import table

QUERIES: dict = {}
SQL: dict = {}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

MODEL = {
    # Class and value cells of zones, with coverage.
    "cells": """SELECT l_suppkey AS zone_id, CAST(l_partkey % 8 AS INT) AS class, l_quantity AS w,
        CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS value, l_linenumber AS line, l_returnflag AS flag FROM lineitem""",
    "hist": "SELECT zone_id, class AS lu_code, sum(w) AS n FROM cells GROUP BY zone_id, class",
    "perc": "SELECT zone_id, lu_code, 100 * n / sum(n) OVER (PARTITION BY zone_id) AS perc FROM hist",
    "zones": "SELECT s_suppkey AS zone_id, CAST(s_nationkey % 5 AS INT) AS batch_id, s_acctbal AS acct FROM supplier",
    "crosswalk": """SELECT DISTINCT CAST(p_partkey % 7 AS INT) AS lu_code, concat('class ', CAST(p_partkey % 7 AS STRING)) AS lu_desc,
        CAST((p_partkey % 7) % 5 AS INT) AS nhm_cov_type, (p_partkey % 7) * 0.01 AS srain_intcp, (p_partkey % 7) * 0.02 AS wrain_intcp,
        (p_partkey % 7) * 0.03 AS snow_intcp, 0.5 + (p_partkey % 7) * 0.05 AS nhm_covden_win, (p_partkey % 7) * 0.1 AS evergreen_retention FROM part""",
    "canopy": "SELECT zone_id, 10 + zone_id % 80 AS canopy_mean FROM zones WHERE zone_id % 9 <> 0",
    # Daily snow of zones: sums by ship date, shaped so that a water year melts out in June.
    "daily": """SELECT zone_id, date, CASE WHEN moy IN (7, 8, 9) THEN 0.0 WHEN moy = 6 THEN 0.0 ELSE q * shape END AS swe,
        CASE WHEN moy IN (6, 7, 8, 9) THEN 0.0 ELSE least(1.0, q * shape / 40) END AS sca, q * shape * (0.1 + CAST(zone_id * 37 % 1009 AS DOUBLE) / 1009) AS swe_std FROM (
        SELECT zone_id, date, q, month(date) AS moy, CASE month(date) WHEN 10 THEN 0.2 WHEN 11 THEN 0.5 WHEN 12 THEN 0.8 WHEN 1 THEN 1.0 WHEN 2 THEN 1.5 WHEN 3 THEN 1.2 WHEN 4 THEN 0.7 WHEN 5 THEN 0.3 ELSE 0 END AS shape FROM (
        SELECT l_suppkey AS zone_id, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS q FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)))""",
    # A grid of 64 columns from orders: values, masks and D8 codes by arithmetic.
    "grid": """SELECT CAST(o_orderkey AS BIGINT) AS cell, CAST(floor(o_orderkey / 64) AS INT) AS row, CAST(o_orderkey % 64 AS INT) AS col, o_totalprice AS value,
        CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 4 AS INT) END AS region, o_orderkey % 3 = 0 AS wet, o_custkey % 5 = 0 AS paved,
        o_orderkey % 17 <> 0 AS land FROM orders""",
    "keys": "SELECT c_custkey AS comid, CAST(c_nationkey AS INT) AS nation, c_acctbal AS area, c_mktsegment AS ftype FROM customer",
    "depths": """SELECT p_partkey AS comid, p_type AS ftype, p_brand AS ecoregion, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size / 4.0 + (p_partkey % 7) * 0.3 END AS dprst_depth_m,
        p_size / 2.0 + 0.5 AS hollister_max_m, p_partkey % 3 = 0 AS flat, p_retailprice AS area FROM part""",
}


def _needs(name: str) -> list[str]:
    text = MODEL[name]
    out: list[str] = []
    for other in MODEL:
        if other != name and re.search(rf"\b(?:FROM|JOIN) {other}\b", text):
            out += _needs(other)
    return [*dict.fromkeys(out), name]


def model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A model table as a DataFrame."""
    made: dict[str, DataFrame] = {}
    for part in _needs(name):
        text = MODEL[part]
        used = {}
        for source in [*made, *TABLES]:
            if re.search(rf"\b(?:FROM|JOIN) {source}\b", text):
                used[source] = made[source] if source in made else table(spark, sf_dir, source)
                text = re.sub(rf"\b(FROM|JOIN) {source}\b", rf"\1 {{{source}}}", text)
        made[part] = spark.sql(text, **used)
    return made[name]


def with_model(*names: str) -> str:
    """The WITH clause that gives DuckDB the same tables."""
    parts = list(dict.fromkeys(p for n in names for p in _needs(n)))
    return "WITH RECURSIVE " + ", ".join(f"{p} AS ({MODEL[p]})" for p in parts)


def query(name: str, sql: str | None = None, tables: tuple[str, ...] = ()):
    """Register a query; ``sql`` follows the WITH clause of ``tables``."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = f"{with_model(*tables)}{',' if tables and sql.lstrip().startswith('+') else ''} {sql.lstrip().removeprefix('+')}" if tables else sql
        return f

    return add
