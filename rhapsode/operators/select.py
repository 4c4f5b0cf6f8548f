"""Frame rules (which candidate is the primary one) and the choice of posed rows.

A rule is a function of a frame table's columns to a sort key; the row of the least key is the pick, and every key ends with det, so that
ties go to the lower row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import area, box_of, center_x


@dataclass(frozen=True)
class FrameRule:
    name: str
    key: Callable[..., Column]
    params: dict = field(default_factory=dict)


def _largest() -> Column:
    return F.struct(-area(box_of()), F.col("det"))


def _highest() -> Column:
    return F.struct(-F.col("score"), F.col("det"))


def side_largest(name: str, share: float, frame_width: float, right: bool = True) -> FrameRule:
    """The largest box on one side of the frame, or the largest of all where none is there."""
    def key() -> Column:
        c = center_x(box_of())
        on = c >= share * frame_width if right else c < share * frame_width
        return F.struct((~on).cast("int"), -area(box_of()), F.col("det"))

    return FrameRule(name, key, {"share": share, "frame_width": frame_width, "right": right})


LARGEST, HIGHEST = FrameRule("largest_bbox", _largest), FrameRule("highest_score", _highest)
FRAMEWORK_RULES = {r.name: r for r in (LARGEST, HIGHEST)}


class Rules:
    """A registry: the framework's rules and a dataset's own, which may not shadow them."""

    def __init__(self, *own: FrameRule):
        self.rules = dict(FRAMEWORK_RULES)
        for r in own:
            if r.name in self.rules:
                raise ValueError(f"rule {r.name} is taken")
            self.rules[r.name] = r

    def __getitem__(self, name: str) -> FrameRule:
        if name not in self.rules:
            raise KeyError(f"unknown rule {name}; known: {sorted(self.rules)}")
        return self.rules[name]


def pick(dets: DataFrame, rule: FrameRule, keys: tuple[str, ...] = ("video_id", "frame"), name: str = "det") -> DataFrame:
    """The rule's pick of each frame."""
    return dets.groupBy(*keys).agg(F.min_by("det", rule.key()).alias(name))


def posed(pose_set: DataFrame, rule: FrameRule, k: int = 3, keys: tuple[str, ...] = ("video_id", "frame")) -> DataFrame:
    """(keys, posed, primary): up to k rows of each frame in ascending order, and the place of the rule's pick among them.

    The rule's pick, the largest and the best-scored row come first, then the others by row; a frame without candidates has no row here.
    """
    if not 1 <= k <= 127:
        raise ValueError(f"k must lie in 1..127, got {k}")
    g = pose_set.groupBy(*keys).agg(*[F.min_by("det", r.key()).alias(n) for r, n in ((rule, "a"), (LARGEST, "b"), (HIGHEST, "c"))], F.sort_array(F.collect_list("det")).alias("all"))
    rows = F.array_sort(F.slice(F.array_distinct(F.concat(F.array("a", "b", "c"), F.col("all"))), 1, k))
    return g.withColumn("posed", rows).select(*keys, "posed", (F.array_position("posed", F.col("a")) - 1).cast("long").alias("primary"))


def posed_rows(rows: Column, k: int = 3) -> tuple[Column, Column]:
    """(posed, primary) of a frame's candidates as an array in falling score, under the largest-box rule: as posed(), without another shuffle."""
    largest = F.array_min(F.transform(rows, lambda b: F.struct((-area(b)).alias("a"), b["det"].alias("det"))))["det"]
    best = F.get(rows, F.lit(0))["det"]
    every = F.sort_array(F.transform(rows, lambda b: b["det"]))
    picked = F.array_sort(F.slice(F.array_distinct(F.concat(F.array(largest, best), every)), 1, k))
    return picked, (F.array_position(picked, largest) - 1).cast("long")


@dataclass(frozen=True)
class VideoRule:
    """A rule that looks at whole videos: choose(rows, lengths) gives (video_id, t, det); params enter the hash."""

    name: str
    choose: Callable[[DataFrame, DataFrame], DataFrame]
    params: dict = field(default_factory=dict)


@lru_cache(maxsize=64)
def processor(rule_name: str, k: int = 3) -> Callable[[DataFrame], DataFrame]:
    """The posed rows of a pose set under a framework rule, built once for each rule."""
    rule = FRAMEWORK_RULES[rule_name]
    return lambda pose_set: posed(pose_set, rule, k)
