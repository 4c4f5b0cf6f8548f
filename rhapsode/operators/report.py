"""Histograms, quantiles, shares, verdicts: the statistics of comparisons and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def log_bin(x: Column, low: int = -6, high: int = 4, per_decade: int = 100) -> Column:
    """Bin of a value: 0 below 10**low, then bins of equal width in the logarithm; the last one takes all beyond."""
    n = (high - low) * per_decade
    return F.when(x < 10.0**low, 0).otherwise(F.least(F.lit(n), 1 + F.floor((F.log10(x) - low) * per_decade + 1e-9))).cast("long")


def bin_top(b: Column, low: int = -6, per_decade: int = 100) -> Column:
    return F.pow(F.lit(10.0), b / per_decade + low)


def hist_quantile(hist: DataFrame, q: float, keys: list[str], n: str = "n", top: str = "top", most: str = "most") -> DataFrame:
    """(keys, value): the top of the bin of nearest rank, at most the exact maximum. hist: (keys, bin, n, top, most), a row for each bin."""
    w = Window.partitionBy(*keys).orderBy("bin")
    h = hist.withColumn("c_", F.sum(n).over(w)).withColumn("t_", F.sum(n).over(Window.partitionBy(*keys)))
    ok = F.col("c_") >= F.greatest(F.lit(1), F.ceil(F.col("t_") * q))
    return h.where(ok).groupBy(*keys).agg(F.min(F.struct("bin", F.least(F.col(top), F.col(most)).alias("v")))["v"].alias("value"))


def share(flag: Column, of: Column) -> Column:
    """Share of the rows ``of`` on which flag holds; 0 where there is none."""
    n = F.sum(of.cast("long"))
    return F.when(n > 0, F.sum((flag & of).cast("long")) / n).otherwise(F.lit(0.0))


def problem(rows: DataFrame, check: str, bad: Column, frame: str = "frame", listed: int = 5) -> DataFrame:
    """(check, n_frames, first_frames) of the frames on which bad holds; no row where none does."""
    hit = rows.where(bad)
    top = hit.orderBy(frame).limit(listed).agg(F.concat_ws(",", F.array_sort(F.collect_list(frame))).alias("first_frames"))  # a bounded listing
    count = hit.agg(F.count("*").alias("n_frames")).where("n_frames > 0")
    return count.withColumn("check", F.lit(check)).join(top.withColumn("check", F.lit(check)), "check").select("check", "n_frames", "first_frames")


def limits(measured: DataFrame, baseline: DataFrame | None, factor: float = 1.5) -> DataFrame:
    """measured (metric, value, fixed, strict) with the limit that holds: fixed, or factor times the baseline's value if that is larger."""
    if baseline is not None:
        measured = measured.join(baseline.select("metric", F.col("value").alias("noise")), "metric", "left")
    else:
        measured = measured.withColumn("noise", F.lit(None).cast("double"))
    top = F.greatest("fixed", F.col("noise") * factor)  # greatest() passes over nulls
    return measured.withColumn("effective", top).withColumn("passed", F.when(F.col("strict"), F.col("value") < F.col("effective")).otherwise(F.col("value") <= F.col("effective")))
