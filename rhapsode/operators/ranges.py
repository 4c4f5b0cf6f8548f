"""Windows by distance of keys: medians, spreads and shares over the rows within so many frames.

All are RANGE frames over one partitioning, so Spark shuffles once for any number of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


#: Distance of scaled() keys of two frames that are a window apart.
UNIT = 1_000_000_000


def scaled(t: Column, half: Column) -> Column:
    """A key by which frames are within ``half`` of each other just where keys are within UNIT: so that each video can have its own window.

    Exact, as t + half has the key of t plus UNIT, and a frame further on has more; a window of 0 frames holds equal frames only.
    """
    return F.when(half > 0, F.floor(F.lit(UNIT) * (t % half) / half) + F.lit(UNIT) * F.floor(t / half)).otherwise(t * (UNIT + 1)).cast("long")


def near(key: str | list[str], t: str, half: int) -> WindowSpec:
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(t).rangeBetween(-half, half)


def range_median(x: Column, w: WindowSpec) -> Column:
    """Median of the values in the window that aren't null; null if none is."""
    return F.percentile(x, 0.5).over(w)


def needed(share: float, half: int) -> int:
    return max(2, math.ceil(share * (2 * half + 1)))


def range_spread(x: Column, y: Column, w: WindowSpec, least: int) -> Column:
    """sqrt(var x + var y), population variances, where at least so many pairs are seen; else null."""
    seen = x.isNotNull() & y.isNotNull()
    only = lambda c: F.when(seen, c)
    v = F.var_pop(only(x)).over(w) + F.var_pop(only(y)).over(w)
    return F.when(F.count(only(x)).over(w) >= least, F.sqrt(F.greatest(v, F.lit(0.0))))


def sorted_motion(rows: DataFrame, key: str, t: str, half: int, smooth: int, floor: float = 0.1, reach: float = 3.0, share: float = 0.25) -> DataFrame:
    """rows with ``motion``: the larger spread of the two wrists in shoulder widths.

    rows have width (null: unseen), height (of the box), and wrist columns lx, ly, rx, ry (null: unseen), relative to the shoulders. The scale is
    the range median of the widths, at least floor times the height; wrists beyond reach are unseen; each coordinate is median-filtered first.
    """
    w, s = near(key, t, half), near(key, t, smooth)
    med = range_median(F.col("width"), w)
    out = rows.withColumn("scale", F.when(med.isNotNull(), F.greatest(med, F.col("height") * floor)))
    for p in "lr":
        x, y = F.col(f"{p}x") / F.col("scale"), F.col(f"{p}y") / F.col("scale")
        ok = F.hypot(x, y) <= reach
        out = out.withColumn(f"{p}x_", F.when(ok, x)).withColumn(f"{p}y_", F.when(ok, y))
    if smooth > 0:
        for c in ("lx_", "ly_", "rx_", "ry_"):
            out = out.withColumn(c + "m", range_median(F.col(c), s))
        out = out.drop("lx_", "ly_", "rx_", "ry_").withColumnsRenamed({c + "m": c for c in ("lx_", "ly_", "rx_", "ry_")})
    spread = [range_spread(F.col(f"{p}x_"), F.col(f"{p}y_"), w, needed(share, half)) for p in "lr"]
    return out.withColumn("motion", F.greatest(*spread)).drop("lx_", "ly_", "rx_", "ry_", "scale")


def signing(rows: DataFrame, key: str, t: str, half: int, least: float = 0.12, sustain: float = 0.75) -> DataFrame:
    """rows with ``signs``: moving, as are enough of the measured rows around."""
    w = near(key, t, half)
    active = F.coalesce(F.col("motion") >= least, F.lit(False))
    return rows.withColumn("signs", active & (F.sum(active.cast("int")).over(w) >= sustain * F.count("motion").over(w)))


def narrow(x: Column, ref: Column, w: WindowSpec, low: float, high: float) -> Column:
    """Whether the range median lies within [low, high] times the reference; an unknown median fails, an unknown reference passes."""
    med = range_median(x, w)
    return F.when(ref.isNull(), True).otherwise(F.coalesce(med.between(low * ref, high * ref), F.lit(False)))


def best_per(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by order."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("n_", n).where("n_ = 1").drop("n_")


def segments(rows: DataFrame, key: str, spot: str, t: str, gap: int | Column) -> DataFrame:
    """rows with ``segment``: a new one where the spot changes or more than gap frames are empty; numbered by first frame within the key."""
    w = Window.partitionBy(key, spot).orderBy(t)
    new = F.coalesce(F.col(t) - F.lag(t).over(w) - 1 > gap, F.lit(True)).cast("int")
    cut = rows.withColumn("c_", new).withColumn("c_", F.sum("c_").over(w))
    first = cut.groupBy(key, spot, "c_").agg(F.min(t).alias("f_"))
    number = (F.row_number().over(Window.partitionBy(key).orderBy("f_", spot, "c_")) - 1).cast("long")
    return cut.join(first.withColumn("segment", number).drop("f_"), [key, spot, "c_"]).drop("c_")
