"""Joins that the engine lacks a plain form of: gathers, zero fills, ranges, upserts, adjacency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import box_of, iou


def gather(posed: DataFrame, dets: DataFrame, keys: tuple[str, ...] = ("video_id", "frame")) -> DataFrame:
    """(keys, pos, det, box columns): each posed row's detection; posed holds arrays of det numbers."""
    return posed.select(*keys, F.posexplode("posed").alias("pos", "det")).join(dets, [*keys, "det"])


def primary_rows(frames: DataFrame, posed: DataFrame, dets: DataFrame, columns: list[str], keys: tuple[str, ...] = ("video_id", "frame")) -> DataFrame:
    """Every frame with its primary row's columns, zeros where it has none."""
    at = posed.where("primary >= 0").select(*keys, F.element_at("posed", (F.col("primary") + 1).cast("int")).alias("det"))
    got = frames.join(at, list(keys), "left").join(dets, [*keys, "det"], "left")
    return got.select(*keys, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in columns])


def overlapping_pairs(dets: DataFrame, least: float, keys: tuple[str, ...] = ("video_id", "frame")) -> DataFrame:
    """Pairs of a frame's boxes with at least that overlap: an equi-join on the frame with a residual condition."""
    a, b = dets.alias("a"), dets.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    over = iou(box_of("a."), box_of("b."))
    cond = F.col("a.det") < F.col("b.det")
    for s in same:
        cond = cond & s
    return a.join(b, cond & (over >= least)).select(*[F.col(f"a.{k}") for k in keys], F.col("a.det").alias("det_a"), F.col("b.det").alias("det_b"), over.alias("iou"))


def by_bucket(points: DataFrame, spans: DataFrame, key: str, t: str, a: str, b: str, bucket: int, closed: bool = True) -> DataFrame:
    """Points within spans of the same key: an equi-join on buckets of t, then the exact test.

    A span is copied to each bucket it covers, a point to one, so long spans cost their length over bucket rows and no key's rows meet all at once.
    """
    p = points.withColumn("b_", F.floor(F.col(t) / bucket))
    s = spans.where(F.col(a) <= F.col(b)).withColumn("b_", F.explode(F.sequence(F.floor(F.col(a) / bucket), F.floor(F.col(b) / bucket))))
    inside = (F.col(t) >= F.col(a)) & ((F.col(t) <= F.col(b)) if closed else (F.col(t) < F.col(b)))
    return p.join(s, [key, "b_"]).where(inside).drop("b_")


def overlaps(x: DataFrame, y: DataFrame, key: str, bucket: int) -> DataFrame:
    """Pairs of half-open spans (key, a, b, k) that overlap: joined on buckets, kept in the first bucket they share."""
    cut = lambda d, n: d.where("b > a").select(F.col(key).alias(key), *[F.col(c).alias(f"{c}_{n}") for c in ("a", "b", "k")]).withColumn("b_", F.explode(F.sequence(F.floor(F.col(f"a_{n}") / bucket), F.floor((F.col(f"b_{n}") - 1) / bucket))))
    j = cut(x, "x").join(cut(y, "y"), [key, "b_"])
    first = F.col("b_") == F.floor(F.greatest("a_x", "a_y") / bucket)
    return j.where((F.col("a_x") < F.col("b_y")) & (F.col("a_y") < F.col("b_x")) & first).drop("b_")


def adjacent(rows: DataFrame, keys: str = "video_id", t: str = "frame", columns: tuple[str, ...] = ("x1", "y1", "x2", "y2")) -> DataFrame:
    """rows with the columns of the frame just before (prefix p_), only where that frame has a row; no self-join."""
    w = Window.partitionBy(keys).orderBy(t)
    out = rows
    for c in columns:
        out = out.withColumn(f"p_{c}", F.lag(c).over(w))
    return out.withColumn("p_", F.lag(t).over(w)).where(F.col("p_") == F.col(t) - 1).drop("p_")


def upsert(old: DataFrame, new: DataFrame, key: str, given: dict[str, Column] | None = None) -> DataFrame:
    """new's keys exactly; columns that new lacks keep old's values; given: columns of new that hold only where the condition is true."""
    keep = [c for c in old.columns if c not in new.columns]
    both = [c for c in new.columns if c in old.columns and c != key]
    o = old.select(F.col(key), *[F.col(c) for c in keep], *[F.col(c).alias(f"o_{c}") for c in both])
    j = new.join(o, key, "left")
    given = given or {}
    cols = [F.when(given[c], F.col(c)).otherwise(F.col(f"o_{c}")).alias(c) if c in given and c in both else F.col(c) for c in new.columns]
    return j.select(*cols, *keep)
