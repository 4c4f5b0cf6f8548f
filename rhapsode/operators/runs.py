"""Runs (half-open frame intervals) and spans: islands, merging, splitting and windows over them.

Each function takes a table with a partition key (usually a video) and an order; runs of different keys never mix. One shuffle by key
serves all windows of a function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(series: DataFrame, mask: str, key: str = "video_id", t: str = "t") -> DataFrame:
    """(key, a, b): maximal runs of consecutive t on which mask is true."""
    w = Window.partitionBy(key).orderBy(t)
    on = series.where(F.col(mask)).select(key, F.col(t).alias("t")).withColumn("g", F.col("t") - F.row_number().over(w.orderBy("t")))
    return on.groupBy(key, "g").agg(F.min("t").alias("a"), (F.max("t") + 1).alias("b")).drop("g")


def joined_runs(runs: DataFrame, gap: int, key: str = "video_id", least: int | Column = 0) -> DataFrame:
    """Runs closer than gap become one; then those shorter than least are dropped."""
    w = Window.partitionBy(key).orderBy("a")
    new = F.coalesce(F.col("a") - F.lag("b").over(w) >= gap, F.lit(True)).cast("int")
    g = runs.withColumn("new", new).withColumn("g", F.sum("new").over(w))
    return g.groupBy(key, "g").agg(F.min("a").alias("a"), F.max("b").alias("b")).where(F.col("b") - F.col("a") >= least).drop("g")


def empty_runs(series: DataFrame, mask: str, gap: int, least: int, key: str = "video_id", t: str = "t") -> DataFrame:
    return joined_runs(islands(series, mask, key, t), gap, key, least)


def split_runs(marks: DataFrame, gap: int, least: int, key: str = "video_id", t: str = "t") -> DataFrame:
    """[first, last + 1) of marked frames that lie at most gap apart; shorter runs than least are dropped."""
    w = Window.partitionBy(key).orderBy(t)
    new = F.coalesce(F.col(t) - F.lag(t).over(w) > gap, F.lit(True)).cast("int")
    g = marks.withColumn("new", new).withColumn("g", F.sum("new").over(w))
    return g.groupBy(key, "g").agg(F.min(t).alias("a"), (F.max(t) + 1).alias("b")).where(F.col("b") - F.col("a") >= least).drop("g")


def hop_windows(runs: DataFrame, block: int, key: str = "video_id") -> DataFrame:
    """(key, a, b, lo, hi): windows of block frames at half-block steps inside each run, the last one ending with it."""
    step = max(1, block // 2)
    starts = F.when(F.col("b") - block > F.col("a"), F.sequence(F.col("a"), F.col("b") - block - 1, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    every = F.array_append(starts, F.greatest(F.col("a"), F.col("b") - block))
    return runs.select(key, "a", "b", F.explode(every).alias("lo")).withColumn("hi", F.least(F.col("lo") + block, F.col("b")))


def merged_spans(spans: DataFrame, key: str = "video_id", a: str = "a", b: str = "b") -> DataFrame:
    """Spans that overlap or touch become one; empty ones (end at or before start) are left out."""
    w = Window.partitionBy(key).orderBy(a, b)
    ended = F.max(b).over(w.rowsBetween(Window.unboundedPreceding, -1))
    g = spans.where(F.col(b) > F.col(a)).withColumn("new", F.coalesce(F.col(a) > ended, F.lit(True)).cast("int")).withColumn("g", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return g.groupBy(key, "g").agg(F.min(a).alias("a"), F.max(b).alias("b")).drop("g")


def review_windows(marks: DataFrame, half: int, lengths: DataFrame, key: str = "video_id", t: str = "t", n: str = "n") -> DataFrame:
    """Merged windows of half frames to either side of each mark, cut to [0, n)."""
    w = marks.join(lengths, key).select(key, F.greatest(F.lit(0), F.col(t) - half).alias("a"), F.least(F.col(n), F.col(t) + half).alias("b"))
    return merged_spans(w, key)


def as_text(runs: DataFrame, key: str, name: str, none: str = "[]") -> DataFrame:
    """A JSON list of pairs for each key that has runs."""
    pair = F.concat(F.lit("["), F.col("a").cast("long").cast("string"), F.lit(", "), F.col("b").cast("long").cast("string"), F.lit("]"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("a", pair.alias("p")))), lambda x: x["p"])
    return runs.groupBy(key).agg(F.concat(F.lit("["), F.array_join(texts, ", "), F.lit("]")).alias(name))
