"""Registered queries against their SQL on the smallest tables."""

import pytest

from rhapsode.llm import queries as Q

from .helpers import SF, same, sql


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_sql(spark, name):
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet").toPandas() for t in ("documents", "benchmark", "embeddings", "conversations") if t in Q.SQL[name]}
    same(Q.QUERIES[name](spark, SF).toPandas(), sql(Q.SQL[name], **tables))


def test_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))
