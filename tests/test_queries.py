"""Every registered query against its SQL, on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(rows):
    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(v)

    return sorted(tuple(value(v) for v in row) for row in rows)


def test_contract_is_complete():
    assert set(contract.library_queries()) == set(contract.library_sql())


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", contract.library_queries())
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    got = canonical(tuple(r) for r in df.select(*columns).collect())
    want = canonical(relation.select(*[f'"{c}"' for c in columns]).fetchall())
    assert got == want
