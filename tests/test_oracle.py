"""Every query with SQL equals DuckDB on the same tables; every other one runs."""

import math
import os

import duckdb
import pytest

from rhapsode.plans import catalog
from rhapsode.plans.fixtures import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def canon(frame):
    cols = sorted(frame.columns)

    def value(x):
        if x is None or str(x) in ("<NA>", "NaT") or isinstance(x, float) and math.isnan(x):
            return None
        return round(float(x), 9) if isinstance(x, float) else x

    return cols, sorted((tuple(value(x) for x in r) for r in frame[cols].astype(object).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.SQL:
        assert canon(got) == canon(con.sql(catalog.SQL[name]).df())
    else:
        assert len(got.columns) > 0
