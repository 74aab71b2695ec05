"""Every registered query of the engine against its DuckDB twin."""

import datetime
import decimal

import duckdb
import pytest

from tidemark.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, data, name):
    df = catalog.queries()[name](spark, data)
    columns = sorted(df.columns)
    rows = sorted(tuple(str(plain(r[c])) for c in columns) for r in df.collect())
    if name not in catalog.oracle_sql():
        assert rows
        return
    found = duck.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    assert rows == sorted(tuple(str(plain(r[names.index(c)])) for c in columns) for r in found.fetchall())
