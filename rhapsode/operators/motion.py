"""Arm motion of the people beside the one that is kept, in the kept one's shoulder widths, and the runs of frames it masks.

A window is measured by itself: people are linked within it alone, so that overlapping windows each have their own. Its motion has three states: null where
there are other people that can't be measured, 0 where there are none, else the largest deviation of an elbow or wrist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import LEAST_SHOULDERS, real_body, visible
from .joins import by_bucket
from .runs import merged_spans
from .tracks import person_tracks

#: Places of the right and left shoulder, and of the right and left elbow and wrist, in an array of joints (from 1).
SHOULDERS, ARMS = (7, 6), (9, 8, 11, 10)
#: Seconds of the gap that parts runs and of a scoring window, observations a joint needs, the jump within which a person is followed, the motion that masks.
RUN_S, BLOCK_S, OBSERVATIONS, JUMP, MOTION = 0.5, 2.0, 10, 0.10, 0.7


def _xy(joints: Column, at: int) -> Column:
    p = F.element_at(joints, at)
    return F.when(visible(p), F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))


def bodies(rows: DataFrame, aspect: Column | float) -> DataFrame:
    """What the motion needs of candidates (video_id, frame, pos, kept, joints): no joints leave this projection but four, relative to the shoulders' middle.

    aspect: a frame's width over its height, of which centres are in heights.
    """
    j = F.col("joints")
    right, left = (_xy(j, k) for k in SHOULDERS)
    apart = F.hypot(right["x"] - left["x"], right["y"] - left["y"])
    x, y = (right["x"] + left["x"]) / 2, (right["y"] + left["y"]) / 2
    arms = F.array(*[F.when(_xy(j, k).isNotNull(), F.struct((_xy(j, k)["x"] - x).alias("x"), (_xy(j, k)["y"] - y).alias("y"))) for k in ARMS])
    armed = F.exists(F.array(*[_xy(j, k) for k in ARMS]), lambda p: p.isNotNull())
    b = rows.select("video_id", "frame", "pos", "kept", real_body(j).alias("real"), F.when(apart > LEAST_SHOULDERS, apart).alias("width"), armed.alias("armed"), (x * aspect).alias("cx"), y.alias("cy"), arms.alias("arms"))
    frame = Window.partitionBy("video_id", "frame")
    return b.withColumn("extra", F.col("real") & F.col("armed") & ~F.col("kept")).withColumn("kept_width", F.max(F.when(F.col("kept"), F.col("width"))).over(frame))


def arm_motion(found: DataFrame, windows: DataFrame, least: int = OBSERVATIONS, jump: float = JUMP, bucket: int = 64) -> DataFrame:
    """(video_id, lo, hi, motion) of half-open windows of frames (video_id, lo, hi), over ``bodies``."""
    keys = ["video_id", "lo", "hi"]
    at = by_bucket(found, windows.select(*keys).distinct(), "video_id", "frame", "lo", "hi", bucket, closed=False)
    whole = at.groupBy(*keys).agg(F.max("extra").alias("has_extra"), F.median(F.when(F.col("kept"), F.col("width"))).alias("median"))
    people = at.where(F.col("extra") & F.col("width").isNotNull()).join(whole.where("median is not null").select(*keys, "median"), keys)
    scale = F.greatest(F.coalesce("kept_width", "median"), 0.5 * F.col("median"))
    joints = [F.col("arms")[k][axis] / scale for k in range(len(ARMS)) for axis in ("x", "y")]
    people = people.select(*keys, "frame", "pos", "cx", "cy", *[c.alias(f"m{i}") for i, c in enumerate(joints)])
    each = [F.when(F.count(f"m{i}") >= least, F.stddev_pop(f"m{i}")) for i in range(len(joints))]
    people = person_tracks(people, jump, tuple(keys)).groupBy(*keys, "person").agg(F.greatest(*each).alias("m"))
    scores = people.groupBy(*keys).agg(F.max("m").alias("score"))
    got = windows.select(*keys).distinct().join(whole, keys, "left").join(scores, keys, "left")
    return got.select(*keys, F.when(F.col("score").isNotNull(), F.col("score")).when(F.coalesce("has_extra", F.lit(False)), F.lit(None)).otherwise(0.0).alias("motion"))


def masked_runs(found: DataFrame, limits: DataFrame, most: float = MOTION, least: int = OBSERVATIONS, jump: float = JUMP) -> DataFrame:
    """(video_id, a, b): stretches in which another person moves, or can't be measured, where two bodies or more are real.

    limits: (video_id, gap, block) in frames: frames at most ``gap`` apart are one run, shorter runs than that are dropped; a run is measured in windows of ``block``
    frames at steps of half of it, the last one ending with the run. A window that can't be measured takes the motion of its run.
    """
    w = Window.partitionBy("video_id").orderBy("frame")
    marks = found.groupBy("video_id", "frame").agg(F.count_if("real").alias("n")).where("n >= 2").join(limits, "video_id")
    parted = marks.withColumn("new", F.coalesce(F.col("frame") - F.lag("frame").over(w) > F.col("gap"), F.lit(True)).cast("int")).withColumn("g", F.sum("new").over(w))
    runs = parted.groupBy("video_id", "g").agg(F.min("frame").alias("a"), (F.max("frame") + 1).alias("b"), F.min("gap").alias("gap"), F.min("block").alias("block")).where(F.col("b") - F.col("a") >= F.col("gap"))
    step, end = F.greatest(F.floor(F.col("block") / 2), F.lit(1)), F.col("b") - F.col("block")
    starts = F.when(end > F.col("a"), F.sequence(F.col("a"), end - 1, step)).otherwise(F.array().cast("array<bigint>"))
    windows = runs.select("video_id", "a", "b", F.explode(F.array_append(starts, F.greatest(F.col("a"), end))).alias("lo"), "block")
    windows = windows.select("video_id", "a", "b", "lo", F.least(F.col("lo") + F.col("block"), "b").alias("hi"))
    scored = windows.join(arm_motion(found, windows, least, jump), ["video_id", "lo", "hi"])
    blind = scored.where("motion is null").select("video_id", F.col("a").alias("lo"), F.col("b").alias("hi")).distinct()
    whole = arm_motion(found, blind, least, jump, 1024).select("video_id", F.col("lo").alias("a"), F.col("hi").alias("b"), F.col("motion").alias("whole"))
    motion = F.coalesce("motion", "whole")
    cut = scored.join(whole, ["video_id", "a", "b"], "left").where(motion.isNull() | (motion > most))
    return merged_spans(cut.select("video_id", F.col("lo").alias("a"), F.col("hi").alias("b")))
