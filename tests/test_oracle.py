"""Every registered query against its DuckDB oracle on the smallest tables.

Rows are compared order-insensitively with columns sorted by name, as the
driver does; queries without SQL (numpy frame kernels) are checked for row
count and status here and by the kernel tests.
"""

import math

import duckdb
import pytest

import __spark_entry__ as E
from ember.plans.catalog import QUERIES as REGISTERED
from ember.sources.testdata import TABLES
from tests.conftest import SMALL

QUERIES = REGISTERED
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    got = df.collect()
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, got) == canon(dcols, res.fetchall())
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    spark_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck_types


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["movie_id", "title", "avg_rating", "total_ratings"]
    assert df.count() > 0
