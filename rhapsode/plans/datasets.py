"""Datasets as plug-ins, their registry, and the settings that hashes cover."""

from __future__ import annotations

import importlib
import re
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import SAFE_ID, SEGMENT_ID, TRACK
from ..operators.select import FrameRule, Rules


@dataclass(frozen=True)
class Settings:
    """Thresholds and sizes; fixed defaults, checked on creation."""

    cand_score: float = 0.1
    pose_score: float = 0.3
    count_score: float = 0.3
    pose_iou: float = 0.3
    count_iou: float = 0.45
    max_posed: int = 3
    det_batch: int = 64
    max_chunk_frames: int = 256

    def __post_init__(self) -> None:
        for name in ("cand_score", "pose_score", "count_score", "pose_iou", "count_iou"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie in [0, 1]")
        if self.pose_score < self.cand_score or self.count_score < self.cand_score:
            raise ValueError("pose_score and count_score must not lie below cand_score")
        if not 1 <= self.max_posed <= 127:
            raise ValueError("max_posed must lie in 1..127")
        if self.det_batch < 1 or self.max_chunk_frames < 1:
            raise ValueError("batches must be positive")

    def extraction_fields(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k not in ("count_score", "count_iou")}

    def derivation_fields(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k in ("count_score", "count_iou")}


class Dataset:
    """A dataset: subclasses give videos(), and may give captions, splits and unreliable spans. All are DataFrames."""

    name = ""
    rules: tuple[FrameRule, ...] = ()
    primary_rule = "largest_bbox"
    split_order: tuple[str, ...] = ()

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def videos(self) -> DataFrame:
        """(video_id, path, split, info map<string,string>, expected_frames)."""
        raise NotImplementedError

    def captions(self) -> DataFrame | None:
        """(video_id, track, seq, start_ms, end_ms, text)."""
        return None

    def splits(self) -> DataFrame:
        """(name, video_id, split); videos without a split are left out."""
        return self.videos().where("split is not null").select(F.lit("").alias("name"), "video_id", "split")

    def unreliable_spans(self) -> DataFrame | None:
        """(video_id, a, b); None: unknown, which isn't the same as none."""
        return None

    def problems(self, listed: int = 10) -> DataFrame:
        """(video_id, problem): ids that are unsafe or repeat, splits that aren't listed, frame counts below 1, info keys that shadow columns."""
        v = self.videos()
        bad = v.where(~F.col("video_id").rlike(SAFE_ID) | F.col("video_id").rlike(SEGMENT_ID)).select("video_id", F.lit("id").alias("problem"))
        twice = v.groupBy("video_id").count().where("count > 1").select("video_id", F.lit("repeated id").alias("problem"))
        out = bad.union(twice).union(v.where("expected_frames < 1").select("video_id", F.lit("expected_frames").alias("problem")))
        if self.split_order:
            out = out.union(v.where(~F.col("split").isin(*self.split_order)).select("video_id", F.lit("split").alias("problem")))
        shadow = F.arrays_overlap(F.map_keys("info"), F.array(*[F.lit(c) for c in ("video_id", "split", "source")]))
        return out.union(v.where(shadow).select("video_id", F.lit("info").alias("problem"))).orderBy("video_id", "problem").limit(listed)


_REGISTRY: dict[str, type[Dataset]] = {}


def register(cls: type[Dataset]) -> type[Dataset]:
    """Checks a dataset class and makes it known by its name."""
    if not (isinstance(cls, type) and issubclass(cls, Dataset)) or cls.videos is Dataset.videos:
        raise TypeError("a dataset is a subclass of Dataset with videos()")
    if not re.match(TRACK, cls.name or ""):
        raise ValueError(f"bad dataset name {cls.name!r}")
    if len(set(cls.split_order)) != len(cls.split_order):
        raise ValueError("split_order repeats")
    Rules(*cls.rules)[cls.primary_rule]
    _REGISTRY[cls.name] = cls
    return cls


def find(name: str) -> type[Dataset]:
    """A registered dataset, or module:Class, or the entry point of that name."""
    if name in _REGISTRY:
        return _REGISTRY[name]
    if ":" in name:
        module, _, cls = name.partition(":")
        return register(getattr(importlib.import_module(module), cls))
    from importlib.metadata import entry_points

    for e in entry_points(group="rhapsode.datasets"):
        if e.name == name:
            return register(e.load())
    raise KeyError(f"unknown dataset {name!r}; known: {sorted(_REGISTRY)}")
