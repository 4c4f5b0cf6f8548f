"""Comparison of two detection sets of the same frames: sets, identities and moves, with the excuses that count.

Everything is joins on the frame and conditional aggregation; a frame's boxes are paired by the matching fold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import area
from .tracks import matched

#: Fixed limits.
BORDERLINE, CONFIDENT, STEP_TOL, FLIP_TOL = 1e-4, 0.3, 1.5, 0.5


def lone_rows(a: DataFrame, b: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side, det, score) of the rows that no pair holds. a has det i and score; b det j and score."""
    x = a.join(pairs.select(*keys, "i"), [*keys, "i"], "left_anti").select(*keys, F.lit("first").alias("side"), F.col("i").alias("det"), "score")
    y = b.join(pairs.select(*keys, "j"), [*keys, "j"], "left_anti").select(*keys, F.lit("second").alias("side"), F.col("j").alias("det"), "score")
    return x.unionByName(y)


def set_verdicts(frames: DataFrame, lone: DataFrame, threshold: float, keys: list[str], borderline: float = BORDERLINE) -> DataFrame:
    """(keys, verdict) of every frame: same, borderline (all lone scores are that near the threshold) or mismatch."""
    g = lone.groupBy(*keys).agg(F.max(F.abs(F.col("score") - threshold)).alias("far"))
    v = F.when(F.col("far").isNull(), "same").when(F.col("far") < borderline, "borderline").otherwise("mismatch")
    return frames.join(g, keys, "left").select(*keys, v.alias("verdict"))


def identities(sides: DataFrame, frames: DataFrame, dist: Callable[[Column, Column], Column], threshold: float, keys: list[str], borderline: float = BORDERLINE, tol: float = 1.0) -> DataFrame:
    """(keys, identity): same, excused (the sets differ at the borderline only) or differs; frames where one side has no primary are left out.

    sides: (keys, mine, theirs), arrays of a frame's rows (det, score, x1..y2), so that a frame is paired, judged and picked from where it lies. The largest box is a side's primary, then the
    lower det; frames that aren't in ``frames`` (keys) have no verdict and excuse nothing.
    """
    largest = lambda of: F.array_min(F.transform(of, lambda x: F.struct((-area(x)).alias("a"), x["det"].alias("det"))))["det"]
    near = lambda a: F.filter(F.transform(F.col("theirs"), lambda b: F.struct(dist(a, b).alias("dist"), a["det"].alias("i"), b["det"].alias("j"))), lambda p: p["dist"] < tol)
    lone = lambda of, k: F.transform(F.filter(of, lambda a: ~F.exists("pairs", lambda p: p[k] == a["det"])), lambda a: F.abs(a["score"] - threshold))
    g = sides.where((F.size("mine") > 0) & (F.size("theirs") > 0)).withColumn("pairs", matched(F.array_sort(F.flatten(F.transform("mine", near)))))
    g = g.withColumn("i", largest(F.col("mine"))).withColumn("j", largest(F.col("theirs")))
    same = F.exists("pairs", lambda p: (p["i"] == F.col("i")) & (p["j"] == F.col("j")))
    g = g.select(*keys, same.alias("same"), F.coalesce(F.array_max(F.concat(lone(F.col("mine"), "i"), lone(F.col("theirs"), "j"))) < borderline, F.lit(False)).alias("near"))
    j = g.join(frames.select(*keys, F.lit(True).alias("judged")), keys, "left")
    return j.select(*keys, F.when(F.col("same"), "same").when(F.col("near") & F.col("judged"), "excused").otherwise("differs").alias("identity"))


def summary(verdicts: DataFrame, pairs: DataFrame, by: str = "video_id") -> DataFrame:
    """(by, frames, same, borderline, mismatch, pairs, max_diff): the counters of a comparison. pairs carry dist."""
    n = lambda v: F.sum((F.col("verdict") == v).cast("long"))
    s = verdicts.groupBy(by).agg(F.count("*").alias("frames"), n("same").alias("same"), n("borderline").alias("borderline"), n("mismatch").alias("mismatch"))
    m = pairs.groupBy(by).agg(F.count("*").alias("pairs"), F.max("dist").alias("max_diff"))
    return s.join(m, by, "left").select(by, "frames", "same", "borderline", "mismatch", F.coalesce("pairs", F.lit(0)).alias("pairs"), F.coalesce("max_diff", F.lit(0.0)).alias("max_diff"))


def moves(points: DataFrame, by: list[str]) -> DataFrame:
    """(by, confident, moved, flipped, most): shares of confident points that move by more than the tolerances, in steps.

    points: (by, dist, step, score): distance in pixels, the step of the person, the reference score.
    """
    steps = F.when(F.col("step") > 0, F.col("dist") / F.col("step")).otherwise(F.when(F.col("dist") > 0, float("inf")).otherwise(0.0))
    p = points.where(F.col("score") > CONFIDENT).withColumn("m_", steps)
    share = lambda tol: F.sum((F.col("m_") > tol).cast("long")) / F.count("*")
    return p.groupBy(*by).agg(F.count("*").alias("confident"), share(STEP_TOL).alias("moved"), share(FLIP_TOL).alias("flipped"), F.max("m_").alias("most"))
