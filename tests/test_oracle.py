"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver's gate runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.compare_oracle import TABLES, rows_of

KEYS = sorted(E.Q.REGISTRY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.O.ORACLE) == set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["metro", "metric_month", "avg_house_value", "rental_income",
                          "monthly_payment", "gross_yield", "cash_flow", "price_to_rent_ratio"]
    assert df.count() > 0
