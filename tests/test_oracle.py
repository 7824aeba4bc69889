"""Every registered query against its DuckDB twin on the smallest scale."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
import oracle_sql
from paperlane.plans.queries import REGISTRY
from paperlane.sources.tables import TABLES, table_path
from scripts.check_oracle import digest
from tests.conftest import SF_SMALL

SQL = oracle_sql.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


def test_every_query_is_registered_with_sql_or_reason():
    qs = entry.queries()
    assert set(SQL) <= set(REGISTRY) <= set(qs) and set(SQL) <= set(entry.oracle_sql()) <= set(qs)
    assert len(REGISTRY) >= 100


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = REGISTRY[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    cur = con.execute(SQL[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(cols, rows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1 and "emails_received" in df.columns
