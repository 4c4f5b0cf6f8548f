"""Intermediate tables that several parts of a plan read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def settled(df: DataFrame) -> DataFrame:
    """df computed once: a checkpoint in the cluster's shared folder (spark.checkpoint.dir), or a cached table where none is set."""
    if df.sparkSession.conf.get("spark.checkpoint.dir", None):
        return df.checkpoint()
    return df.persist()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, a write's shuffle files go when it is done, and not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, old)
