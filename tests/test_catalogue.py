"""Every registered query of the core over small tables, against its SQL where it has one."""

import datetime
import decimal
import os

import duckdb
import pytest

from tracewright.plans import catalogue, training_data

QUERIES = catalogue.QUERIES | training_data.QUERIES
ORACLES = catalogue.ORACLES | training_data.ORACLES


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(small):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{small}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    rows = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert rows == sorted(repr([plain(r[i]) for i in at]) for r in result.fetchall())


def test_the_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
