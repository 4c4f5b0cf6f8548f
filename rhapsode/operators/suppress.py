"""Greedy suppression of overlapping boxes within frames, as folds over sorted arrays.

The boxes of a frame are gathered (a frame holds few), sorted by falling score (ties: lower det), and folded: a box stays unless one that
stayed overlaps it too much. No Python runs; the only shuffle is by frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import area, intersection

POSE, COUNT, POSED = 1, 2, 4
COUNT_IOU, POSE_IOU, HEAD_IOU = 0.45, 0.3, 0.65
FRAME = ("video_id", "frame")


def standard(threshold: float) -> callable:
    """Overlap above threshold, by intersection over union written without division."""
    def over(kept: Column, b: Column) -> Column:
        inter = intersection(kept, b)
        return inter > threshold * (area(kept) + area(b) - inter)

    return over


def end_pixels(threshold: float) -> callable:
    """The same with end pixels counted in widths and heights."""
    def over(kept: Column, b: Column) -> Column:
        inter = intersection(kept, b, 1.0)
        return inter / (area(kept, 1.0) + area(b, 1.0) - inter) > threshold

    return over


ROWS = "array<struct<order:double,det:bigint,x1:double,y1:double,x2:double,y2:double>>"


def gathered(dets: DataFrame, keys: tuple[str, ...] = FRAME, least_score: float | None = None) -> DataFrame:
    """keys and ``rows``: each frame's candidates in falling score. Filters by score stand before, since no optimizer can push them below a fold."""
    if least_score is not None:
        dets = dets.where(F.col("score") > least_score)
    row = F.struct((-F.col("score")).alias("order"), "det", "x1", "y1", "x2", "y2")
    return dets.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("rows"))


def kept_of(rows: Column, over: callable) -> Column:
    """The rows that stay, of an array in falling score."""
    return F.aggregate(rows, F.array().cast(ROWS), lambda kept, b: F.when(F.exists(kept, lambda k: over(k, b)), kept).otherwise(F.array_append(kept, b)))


def suppressed(dets: DataFrame, over: callable, keys: tuple[str, ...] = FRAME, least_score: float | None = None) -> DataFrame:
    """keys and ``kept``: det numbers that stay, in falling score. Only frames with a candidate have a row."""
    rows = gathered(dets, keys, least_score)
    return rows.select(*keys, F.transform(kept_of(F.col("rows"), over), lambda b: b["det"]).alias("kept"))


def survivors(dets: DataFrame, over: callable, keys: tuple[str, ...] = FRAME, least_score: float | None = None) -> DataFrame:
    """A row for each det that stays."""
    return suppressed(dets, over, keys, least_score).select(*keys, F.explode("kept").alias("det"))


def flagged(dets: DataFrame, keys: tuple[str, ...] = FRAME, score: float = 0.3) -> DataFrame:
    """dets with flags: 1 for the pose set, 2 for the count set."""
    named = lambda over: F.transform(kept_of(F.col("rows"), over), lambda b: b["det"])
    sets = gathered(dets, keys, score).select(*keys, named(end_pixels(POSE_IOU)).alias("pose"), named(standard(COUNT_IOU)).alias("count"))
    both = dets.join(sets, list(keys), "left")
    bit = lambda col, v: F.when(F.array_contains(col, F.col("det")), v).otherwise(0)
    return both.withColumn("flags", bit("pose", POSE).bitwiseOR(bit("count", COUNT)).cast("int")).drop("pose", "count")


def people_per_frame(frames: DataFrame, flags: DataFrame, bit: int = COUNT, keys: tuple[str, ...] = FRAME) -> DataFrame:
    """num_persons of every frame, 0 where no candidate is."""
    n = flags.groupBy(*keys).agg(F.sum((F.col("flags").bitwiseAND(bit) != 0).cast("long")).alias("n"))
    return frames.join(n, list(keys), "left").select(*keys, F.coalesce("n", F.lit(0)).cast("long").alias("num_persons"))
