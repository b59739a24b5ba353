"""Every registered query against its DuckDB oracle at sf0.01 (the
driver's correctness gate, run locally)."""
import os

import duckdb
import pytest

from conftest import SF01

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

from ledgerline.catalog import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF01, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF01).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf) > 0
        return
    odf = con.execute(sql).df()
    scols, srows = rows_of(sdf)
    ocols, orows = rows_of(odf)
    assert scols == ocols
    assert len(sdf) == len(odf)
    assert srows == orows


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["name", "current_invoice_balance", "credit_balance", "current_invoice_amount",
                          "credit_balance_amount"]


def test_every_query_has_oracle_or_is_documented():
    no_sql = set(QUERIES) - set(E.oracle_sql())
    assert not no_sql
