"""Every query with an oracle equals DuckDB on the same parquet tables (sf0.001)."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF
from tools.oracle_check import compare, compare_types

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "documents", "labels", "embeddings", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "month", "total_contacts", "total_orders", "order_rate"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, con, name):
    sdf = queries()[name](spark, SF)
    res = con.execute(oracle_sql()[name])
    err = compare(sdf, res.fetchall(), [d[0] for d in res.description]) or compare_types(sdf, res.description)
    assert err is None, err
