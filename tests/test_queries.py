"""Every registered query gives the rows of its SQL."""

import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql
from waybill.plans.queries import CATALOG

FOLDER = os.environ.get("WAYBILL_TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("orders", "lineitem", "supplier", "events", "documents", "pages", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def comparable(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if df[name].dtype.kind == "M":
            df[name] = df[name].astype("datetime64[us]")
        df[name] = [None if pd.isna(v) else str(v) for v in df[name]]
    return sorted(map(tuple, df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_equals_its_sql(spark, duck, name):
    got = CATALOG[name].run(spark, FOLDER).toPandas()
    expected = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert comparable(got) == comparable(expected)


def test_entry(spark):
    assert entry(spark).columns == ["order_key", "loadConfirmationNumber", "totalCarrierPay"]
