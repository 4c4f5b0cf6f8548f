"""Audits of stored records: all checks of a frame in one pass, each with an exact count and its first frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a detection's flags: in the pose set, in the count set, posed.
POSE_SET, COUNT_SET, POSED = 1, 2, 4
KEYS = ("video_id", "frame")


def tally(rows: DataFrame, checks: dict[str, Column], key: str = "video_id", item: str = "frame", keep: int = 5) -> DataFrame:
    """(key, check, n, first): how many rows each condition holds for, and the ``keep`` least items among them, ascending.

    A custom aggregate in two steps: tasks keep a counter and a bounded list for each key and check, and only those are shuffled. No sort, no pass
    for each check. A null condition doesn't hold.
    """
    import numpy as np
    import pyarrow as pa

    names = list(checks)
    kind = "string" if rows.schema[key].dataType.simpleString() == "string" else "bigint"
    at = rows.select(F.col(key).cast(kind).alias("key"), F.col(item).cast("long").alias("item"), *[F.coalesce(c, F.lit(False)).alias(f"c{i}") for i, c in enumerate(checks.values())])
    held = at.where(F.array_contains(F.array(*[F.col(f"c{i}") for i in range(len(names))]), True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict = {}
        least: dict = {}
        for b in batches:
            keys, items = np.asarray(b.column(0).to_pylist(), dtype=object), np.asarray(b.column(1))
            for i in range(len(names)):
                hit = np.flatnonzero(np.asarray(b.column(2 + i)))
                for k in dict.fromkeys(keys[hit].tolist()):
                    found = items[hit][keys[hit] == k]
                    count[k, i] = count.get((k, i), 0) + len(found)
                    least[k, i] = sorted([*least.get((k, i), []), *np.sort(found)[:keep].tolist()])[:keep]
        cols = [pa.array([k for k, _ in count], pa.string() if kind == "string" else pa.int64()), pa.array([names[i] for _, i in count], pa.string()), pa.array(list(count.values()), pa.int64()), pa.array([least[x] for x in count], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(cols, names=["key", "check", "n", "first"])

    part = held.mapInArrow(run, f"key {kind}, check string, n long, first array<bigint>")
    return part.groupBy(F.col("key").alias(key), "check").agg(F.sum("n").alias("n"), F.slice(F.sort_array(F.flatten(F.collect_list("first"))), 1, keep).alias("first"))


def local_posed(posed: DataFrame, detections: DataFrame) -> DataFrame:
    """posed (video_id, frame, pos, det) with det counted over the video, as stored, to det counted in its frame."""
    per = detections.groupBy(*KEYS).agg(F.count("*").alias("k"))
    before = F.sum("k").over(Window.partitionBy("video_id").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per.select(*KEYS, F.coalesce(before, F.lit(0)).alias("before"))
    return posed.join(offsets, list(KEYS), "left").select(*KEYS, "pos", (F.col("det") - F.col("before")).alias("det"))


def frames_of(frames: DataFrame, detections: DataFrame, posed: DataFrame) -> DataFrame:
    """A row for each frame: num_persons, primary, its detections d and posed rows p in order; one shuffle of each table by (video_id, frame)."""
    box = [c for c in ("x1", "y1", "x2", "y2") if c in detections.columns]
    d = detections.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("det", "score", "flags", *box))).alias("d"))
    p = posed.groupBy(*KEYS).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "det"))), lambda x: x["det"]).alias("p"))
    return frames.withColumn("listed", F.lit(True)).join(d, list(KEYS), "full").join(p, list(KEYS), "full").select(*KEYS, "listed", "num_persons", "primary", "d", "p")


def largest(d: Column) -> Column:
    """The number of the pose set's largest box, the first of equal ones; null without one."""
    best = F.array_max(F.transform(F.filter(d, lambda x: x["flags"].bitwiseAND(POSE_SET) != 0), lambda x: F.struct(((x["x2"] - x["x1"]) * (x["y2"] - x["y1"])).alias("a"), (-x["det"]).alias("k"))))
    return -best["k"]


def first_listed(d: Column) -> Column:
    """The number of the first detection of the frame, whatever its flags."""
    return F.array_min(F.transform(d, lambda x: x["det"]))


def record_checks(pick: Callable[[Column], Column] | None = largest) -> dict[str, Column]:
    """Conditions over ``frames_of`` that no sound record meets. pick: the number of the detection that the record's rule picks."""
    n = lambda c: F.coalesce(F.size(F.filter(F.col("d"), c)), F.lit(0))
    bit = lambda x, b: x["flags"].bitwiseAND(b) != 0
    posed = F.coalesce(F.transform(F.filter("d", lambda x: bit(x, POSED)), lambda x: x["det"]), F.array().cast("array<bigint>"))
    kept = F.coalesce("p", F.array().cast("array<bigint>"))
    scores = F.transform("d", lambda x: x["score"])
    out = {
        "frame not listed": F.col("listed").isNull(),
        "scores rise": F.exists(F.arrays_zip(scores.alias("a"), F.slice(scores, F.lit(2), F.greatest(F.size(scores) - 1, F.lit(0))).alias("b")), lambda x: x["b"] > x["a"]),
        "posed outside the pose set": n(lambda x: bit(x, POSED) & ~bit(x, POSE_SET)) > 0,
        "num_persons": F.coalesce(F.col("num_persons") != n(lambda x: bit(x, COUNT_SET)), F.col("num_persons").isNull()),
        "number of posed rows": F.size(posed) != F.size(kept),
        "posed rows": (F.size(posed) == F.size(kept)) & (posed != kept),
        "primary outside the posed rows": (F.col("primary") < -1) | (F.col("primary") >= F.size(kept)),
    }
    if pick is not None:
        chosen = pick(F.col("d"))
        place = F.coalesce(F.array_position(kept, chosen).cast("long") - 1, F.lit(-1).cast("long"))
        out["pick isn't posed"] = chosen.isNotNull() & (place < 0)
        out["primary isn't the pick"] = (chosen.isNull() | (place >= 0)) & (place != F.col("primary"))
    return out


def record_problems(frames: DataFrame, detections: DataFrame, posed: DataFrame, pick: Callable[[Column], Column] | None = largest, keep: int = 5) -> DataFrame:
    """(video_id, check, n, first) of all checks over all frames, in one pass. det in posed counts in its frame."""
    return tally(frames_of(frames, detections, posed), record_checks(pick), keep=keep)
