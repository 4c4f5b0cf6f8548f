"""Shared helpers: tables in the shared work folder, words, size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as all contracts here define it: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_own_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder ``spark.checkpoint.dir``; where that is unset, a temporary one in local mode (tests), and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="rhapsode-")
    return _own_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/rhapsode/{name}-{uuid.uuid4().hex[:12]}"


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)
    except Exception:  # the session may be gone by then; a later cleaner of the work folder takes it
        pass


def materialize(df: DataFrame, name: str, codec: str = "lz4") -> DataFrame:
    """Writes df as a table in the shared work folder and reads it back.

    This cuts the lineage in a way that survives the loss of executors, and fixes values that a
    recomputation could change (row ids, sampled ranges). The table goes when the driver ends, or by drop().
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    atexit.register(_delete_at_exit, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._rhapsode_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes materialized tables that no later plan reads."""
    for t in tables:
        path = getattr(t, "_rhapsode_path", None)
        if path:
            _delete(t.sparkSession, path)


def small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """df with a broadcast hint if it has at most that many rows (which are narrow), else df itself."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of df has, ignoring case."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Within it, whole texts go to Python workers in batches of at most that many rows, so that buffers stay small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, old)
