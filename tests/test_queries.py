"""Every registered query against its SQL in DuckDB, on the smallest data folder."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from tarnworks.plans import registry  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no data folder")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if type(v).__name__ == "Decimal":
        v = float(v)
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return tuple(map(plain, v)) if isinstance(v, list) else v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    if name not in registry.SQL:
        assert got
        return
    cur = duck.execute(registry.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in at) for r in cur.fetchall()]
    assert ordered(got) == ordered(want)


def test_sql_names_are_queries():
    assert set(registry.SQL) <= set(registry.QUERIES)
