import math

import duckdb
import pytest

from signmine.plans import catalogue

TABLES = ("customer", "documents", "embeddings", "events", "lineitem", "orders", "pages", "part", "supplier")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, small, duck, name):
    found = catalogue.QUERIES[name](spark, small)
    result = duck.execute(catalogue.ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(found.columns)
    want = sorted(repr([plain(r[names.index(c)]) for c in sorted(names)]) for r in result.fetchall())
    have = sorted(repr([plain(r[c]) for c in sorted(found.columns)]) for r in found.collect())
    assert have == want


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_other_queries_have_rows(spark, small, name):
    assert catalogue.QUERIES[name](spark, small).count() > 0
