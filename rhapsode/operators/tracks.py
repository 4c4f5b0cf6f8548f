"""Tracks, spots, segments and the signer of each frame.

Linking boxes into tracks, founding spots and following people are sequential by nature: they run per video in grouped-map functions over the
boxes alone (a few numbers a row). Everything around them (medians, membership, segments, densities, the choice) is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import area, box, box_of, fits_scale, iou
from . import ranges
from .joins import by_bucket
from .stage import settled

#: Frames of a bucket in which gaps meet the frames of others.
GAP_BUCKET = 256


#: A number of frames: the same for all videos, or each video's own.
Frames = int | Column


def per_video(x: Frames) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


@dataclass(frozen=True)
class TrackParams:
    """Fixed values of the default rule; durations in seconds."""

    link_iou: float = 0.5
    max_gap_s: float = 1.0
    min_track_s: float = 20.0
    window_s: float = 60.0
    merge_gap_s: float = 60.0
    min_visit_s: float = 1.0
    main_share: float = 0.5
    min_density: float = 0.8
    max_visit_share: float = 0.5
    anchor_s: float = 20.0
    fit_iou: float = 0.8
    fit_scale: float = 1.25
    max_scale: float = 1.3
    min_scale: float = 0.25
    scale_window_s: float = 1.0
    other_iou: float = 0.0
    other_scale: float = 0.0
    min_active: float = 0.0
    fill_min_s: float = 10.0
    fill_cover: float = 0.5


def pair_iou(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All boxes against all; 0 where a union is empty."""
    w = np.clip(np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0]), 0, None)
    h = np.clip(np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1]), 0, None)
    inter, size = w * h, lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
    union = size(a)[:, None] + size(b)[None, :] - inter
    return np.divide(inter, union, out=np.zeros_like(inter), where=union > 0)


def row_iou(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Boxes against boxes, row by row; the numbers of pair_iou()."""
    w = np.clip(np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0]), 0, None)
    h = np.clip(np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1]), 0, None)
    inter, size = w * h, lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
    union = size(a) + size(b) - inter
    return np.divide(inter, union, out=np.zeros_like(inter), where=union > 0)


#: Pairs of boxes whose overlaps are computed at once.
PAIRS = 200_000


class Linker:
    """The tracker's state: open tracks with their last boxes. Feed frames in ascending order."""

    def __init__(self, link_iou: float, max_gap: int, state: tuple | None = None):
        self.link_iou, self.max_gap = link_iou, max_gap
        self.ids, self.boxes, self.last, self.next = state or ([], np.zeros((0, 4)), [], 0)

    def state(self) -> tuple:
        return self.ids, self.boxes, self.last, self.next

    def frame(self, t: int, boxes: np.ndarray) -> list[int]:
        """Track ids of a frame's boxes: pairs by falling overlap (then older track, then row), one to one; the rest begin tracks."""
        open_ = [i for i, last in enumerate(self.last) if t - last - 1 <= self.max_gap]
        self.ids, self.last, self.boxes = [self.ids[i] for i in open_], [self.last[i] for i in open_], self.boxes[open_]
        out = [-1] * len(boxes)
        if len(self.ids) and len(boxes):
            over = pair_iou(self.boxes, boxes)
            i, r = np.nonzero(over >= self.link_iou)
            taken: set[int] = set()
            for k in np.lexsort((r, i, -over[i, r])):
                a, b = int(i[k]), int(r[k])
                if a not in taken and out[b] < 0:
                    taken.add(a)
                    out[b] = self.ids[a]
                    self.boxes[a], self.last[a] = boxes[b], t
        fresh = [b for b in range(len(boxes)) if out[b] < 0]
        for b in fresh:
            out[b] = self.next
            self.ids.append(self.next)
            self.last.append(t)
            self.next += 1
        if fresh:
            self.boxes = np.concatenate([self.boxes, boxes[fresh]])
        return out

    def rows(self, frame: np.ndarray, boxes: np.ndarray) -> np.ndarray:
        """Track ids of many frames' boxes, in ascending order of frames: what frame() gives for one after the other.

        Overlaps with the boxes of the frames before, within the gap, are computed for many rows at once; only pairs that overlap enough are gone through in order.
        """
        by, k = np.argsort(self.last, kind="stable"), len(self.ids)
        at = np.concatenate([np.array(self.last, dtype=np.int64)[by], frame])
        xy = np.concatenate([self.boxes[by], boxes])
        ids = [*(self.ids[i] for i in by), *[-1] * len(frame)]
        last = [True] * len(ids)  # whether a box is its track's last one so far
        lo, hi = np.searchsorted(at, frame - self.max_gap - 1), np.searchsorted(at, frame)
        ends = np.cumsum(hi - lo)
        cuts = [*starts_of(frame).tolist(), len(frame)]
        a = 0
        while a + 1 < len(cuts):  # whole frames, of about so many pairs
            before = int(ends[cuts[a] - 1]) if cuts[a] else 0
            b = a + 1
            while b + 1 < len(cuts) and ends[cuts[b + 1] - 1] - before <= PAIRS:
                b += 1
            j = np.arange(cuts[a], cuts[b])
            n = (hi - lo)[j]
            new = np.repeat(j, n)
            old = np.arange(len(new)) - np.repeat(np.cumsum(n) - n, n) + lo[new]
            over = row_iou(xy[old], boxes[new])
            hit = np.flatnonzero(over >= self.link_iou)
            pairs = list(zip((-over[hit]).tolist(), old[hit].tolist(), (new[hit] + k).tolist(), strict=True))
            p = 0
            for c in range(a, b):
                first, end, found = cuts[c] + k, cuts[c + 1] + k, []
                while p < len(pairs) and pairs[p][2] < end:
                    o, i, r = pairs[p]
                    if last[i]:
                        found.append((o, ids[i], r, i))
                    p += 1
                for _, track, r, i in sorted(found):
                    if last[i] and ids[r] < 0:
                        ids[r], last[i] = track, False
                for r in range(first, end):
                    if ids[r] < 0:
                        ids[r], self.next = self.next, self.next + 1
            a = b
        if len(at):
            open_ = [i for i in np.flatnonzero(at >= at[-1] - self.max_gap - 1).tolist() if last[i]]
            open_.sort(key=ids.__getitem__)
            self.ids, self.last, self.boxes = [ids[i] for i in open_], at[open_].tolist(), xy[open_]
        return np.array(ids[k:], dtype=np.int64)


def parts_of(boxes: DataFrame, max_gap: Frames) -> DataFrame:
    """(video_id, frame, part): frames with boxes; a part begins where none were for longer than max_gap, so that no track reaches over."""
    frames = boxes.groupBy("video_id", "frame").agg(F.max(per_video(max_gap)).alias("gap"))
    w = Window.partitionBy("video_id").orderBy("frame")
    new = F.coalesce(F.col("frame") - F.lag("frame").over(w) - 1 > F.col("gap"), F.lit(True))
    return frames.withColumn("new", new.cast("long")).select("video_id", "frame", "gap", F.sum("new").over(w).alias("part"))


def link_tracks(boxes: DataFrame, link_iou: float = 0.5, max_gap: Frames = 25, keep: tuple[str, ...] = ()) -> DataFrame:
    """(video_id, frame, det, track, keep): ids count from 0 in each video, in the order of first frames. keep: columns of boxes that come along.

    Parts of a video between which every track has ended are linked by tasks of their own, and their ids shifted by the tracks before. A part is read as a stream in
    the order of frames: only open tracks and one frame are held, however long it is.
    """
    cols = ["video_id", "frame", "det", "x1", "y1", "x2", "y2"]
    parts = settled(parts_of(boxes, max_gap))
    read = boxes.select(*cols, *[c for c in keep if c not in cols]).join(parts, ["video_id", "frame"])
    out = ["video_id", "part", "frame", "det", "track", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker, now = None, None

        def linked(t: pa.Table) -> pa.RecordBatch:
            nonlocal linker, now
            video, part, frame, gap = (np.asarray(t.column(c)) for c in ("video_id", "part", "frame", "gap"))
            xy = np.stack([np.asarray(t.column(c), dtype=np.float64) for c in ("x1", "y1", "x2", "y2")], axis=1)
            cuts, ids = starts_of(video, part), []
            for lo, hi in zip(cuts, [*cuts[1:], len(frame)], strict=True):
                if now != (video[lo], part[lo]):
                    now, linker = (video[lo], part[lo]), Linker(link_iou, int(gap[lo]))
                ids.append(linker.rows(frame[lo:hi], xy[lo:hi]))
            t = t.append_column("track", pa.array(np.concatenate(ids))).select(out)
            return t.combine_chunks().to_batches()[0]

        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            if not t.num_rows:
                continue
            last = int(starts_of(*(np.asarray(t.column(c)) for c in ("video_id", "part", "frame")))[-1])  # the last frame may go on in the next batch
            if last:
                yield linked(t.slice(0, last))
            held = t.slice(last)
        if held is not None and held.num_rows:
            yield linked(held)

    kinds = "".join(f", {c} {boxes.schema[c].dataType.simpleString()}" for c in keep)
    rows = read.withColumns({c: F.col(c).cast("long") for c in ("video_id", "frame", "det")}).repartition("video_id", "part").sortWithinPartitions("video_id", "part", "frame", "det")
    got = rows.mapInArrow(run, f"video_id long, part long, frame long, det long, track long{kinds}")
    if parts.where("part > 1").limit(1).count() == 0:
        return got.drop("part")
    got = settled(got)
    n = got.groupBy("video_id", "part").agg((F.max("track") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("video_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    n = n.select("video_id", "part", F.coalesce(before, F.lit(0)).alias("before"))
    return got.join(n, ["video_id", "part"]).withColumn("track", F.col("track") + F.col("before")).select("video_id", "frame", "det", "track", *keep)


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys begins, the first row included."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def track_summary(rows: DataFrame, least: Frames = 1, width: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(video_id, track, length, x1..y2, scale): lengths, median boxes, and the median known width of tracks of at least ``least`` boxes.

    carry: columns with one value for a video, which come along.
    """
    med = [F.median(c).alias(c) for c in ("x1", "y1", "x2", "y2")]
    enough = F.count("*") >= (F.max(least) if isinstance(least, Column) else F.lit(least))
    scale = F.when(enough, F.median(width)) if width else F.lit(None).cast("double")
    return rows.groupBy("video_id", "track").agg(F.count("*").alias("length"), *med, scale.alias("scale"), *[F.max(c).alias(c) for c in carry])


#: Boxes whose nearest ones are remembered; beyond it all are searched anew.
REMEMBERED = 100_000


class Boxes:
    """Different boxes in the order they came, each with the first name it was given."""

    def __init__(self):
        self.room, self.names, self.known, self.found = np.zeros((1, 4)), [], set(), {}

    @property
    def boxes(self) -> np.ndarray:
        return self.room[: len(self.names)]

    def add(self, box: np.ndarray, name: int) -> None:
        if (key := box.tobytes()) in self.known:
            return
        self.known.add(key)
        if len(self.names) == len(self.room):
            self.room = np.concatenate([self.room, np.zeros_like(self.room)])
        self.room[len(self.names)] = box
        self.names.append(name)

    def nearest(self, box: np.ndarray) -> tuple[float, int]:
        """(overlap, name) of the box that overlaps most, the first of equal ones. A box that was asked before is held against those that came since only."""
        seen, best, i = self.found.get(key := box.tobytes(), (0, -1.0, -1))
        if seen < len(self.names):
            over = pair_iou(box[None], self.room[seen : len(self.names)])[0]
            if over[k := int(np.argmax(over))] > best:
                best, i = float(over[k]), seen + k
            if len(self.found) >= REMEMBERED:
                self.found.clear()
            self.found[key] = len(self.names), best, i
        return best, self.names[i]


class Founding:
    """The spots of a video so far. Feed tracks by falling length, then by their numbers."""

    def __init__(self, p: TrackParams):
        self.p, self.founders, self.seen, self.anchors = p, [], Boxes(), []  # of spots with the same box the first one counts

    def place(self, box: np.ndarray, width: float, long: bool) -> tuple[int, bool, bool]:
        """(spot, whether it is an anchor of it, whether it founds it) of a track."""
        side = float(np.sqrt(max(0, (box[2] - box[0]) * (box[3] - box[1]))))
        if self.founders:
            over, k = self.seen.nearest(box)
            near = over >= self.p.link_iou and alike(*zip((side, width), self.founders[k], strict=True), self.p.fit_scale)
            if near and (long or self.anchors[k].nearest(box)[0] >= self.p.fit_iou):
                if long:
                    self.anchors[k].add(box, 0)
                return k, long, False
        k = len(self.founders)
        self.founders.append((side, width))
        self.anchors.append(Boxes())
        self.seen.add(box, k)
        self.anchors[k].add(box, 0)
        return k, True, True


SPOTS = "video_id long, track long, spot long, anchor boolean, founder boolean"


def found_spots(tracks: DataFrame, p: TrackParams, min_visit: Frames, anchor: Frames) -> DataFrame:
    """(video_id, track, spot, anchor): tracks take a spot, longest first, or found one; shorter ones than min_visit have none.

    A video's tracks (not boxes) are read by one task, as a stream in the order in which they are placed: only the spots and their anchors are held.
    """
    asked = tracks.where(F.col("length") >= per_video(min_visit)).select("video_id", "track", "length", "x1", "y1", "x2", "y2", "scale", (F.col("length") >= per_video(anchor)).alias("long"))
    kinds = {"video_id": "long", "track": "long", "length": "long", **{c: "double" for c in ("x1", "y1", "x2", "y2", "scale")}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = spots = None
        for b in batches:
            video, track = (b.column(c).to_pylist() for c in ("video_id", "track"))
            xy = np.stack([np.asarray(b.column(c), dtype=np.float64) for c in ("x1", "y1", "x2", "y2")], axis=1)
            width, long = b.column("scale").to_numpy(zero_copy_only=False).astype(np.float64).tolist(), b.column("long").to_pylist()
            out = []
            for j, v in enumerate(video):
                if spots is None or v != now:
                    now, spots = v, Founding(p)
                out.append(spots.place(xy[j], width[j], long[j]))
            spot, held, founder = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(video, pa.int64()), pa.array(track, pa.int64()), pa.array(spot, pa.int64()), pa.array(held, pa.bool_()), pa.array(founder, pa.bool_())], names=["video_id", "track", "spot", "anchor", "founder"])

    rows = asked.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})
    return rows.repartition("video_id").sortWithinPartitions("video_id", F.desc("length"), "track").mapInArrow(run, SPOTS)


def alike(side: tuple[float, float], width: tuple[float, float], factor: float) -> bool:
    """Whether two boxes' sides, and their widths where both are known, are within a factor of each other; factor 0: always; a second side of 0: never."""
    if factor <= 0 or not side[1] > 0:
        return factor <= 0
    ratio = np.array([np.float64(side[0]) / side[1], np.divide(np.float64(width[0]), width[1])])
    return not ((ratio < 1 / factor) | (ratio > factor)).any()  # an unknown ratio is neither


def placed_tracks(rows: DataFrame, p: TrackParams, min_visit: Frames, anchor: Frames, width: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The tracks that have a spot: track_summary() and found_spots() of linked boxes."""
    t = track_summary(rows, min_visit, width, carry)
    return t.join(found_spots(t, p, min_visit, anchor), ["video_id", "track"])


def spot_rows(rows: DataFrame, p: TrackParams, min_visit: Frames, anchor: Frames, merge_gap: Frames, half: Frames, width: str | None = None, placed: DataFrame | None = None) -> DataFrame:
    """Rows of segments: (video_id, frame, det, track, spot, segment, box columns): those of a spot's tracks that lie on it, the best one a frame.

    rows: linked boxes (video_id, frame, det, track, x1..y2, and width, null where unknown); placed: their placed_tracks(), if known already.
    """
    s = placed if placed is not None else placed_tracks(rows, p, min_visit, anchor, width)
    named = {c: f"s_{c}" for c in ("x1", "y1", "x2", "y2", "scale")}
    spots = s.where("founder").select("video_id", "spot", *[F.col(c).alias(n) for c, n in named.items()])
    tracks = s.select("video_id", "track", "spot", "anchor", *[F.col(c).alias(f"t_{c}") for c in named]).join(spots, ["video_id", "spot"])
    r = rows.join(tracks, ["video_id", "track"])
    own, spot, mid = box_of(), box(*[F.col(f"s_{c}") for c in ("x1", "y1", "x2", "y2")]), box(*[F.col(f"t_{c}") for c in ("x1", "y1", "x2", "y2")])
    moved = F.col("anchor") & (iou(mid, spot) < p.fit_iou)
    r = r.withColumn("fit", iou(spot, own)).withColumn("on", (F.col("fit") >= p.link_iou) | (moved & (iou(mid, own) >= p.link_iou)))
    if width and (p.max_scale > 0 or p.min_scale > 0):
        ref = F.when(F.col("anchor") & F.col("t_scale").isNotNull(), F.col("t_scale")).otherwise(F.col("s_scale"))
        r = r.withColumn("s_near", ranges.scaled(F.col("frame"), per_video(half)))
        w = ranges.near(["video_id", "track"], "s_near", ranges.UNIT)
        r = r.withColumn("on", F.col("on") & ranges.narrow(F.col(width), ref, w, p.min_scale, p.max_scale or float("inf")))
    r = ranges.best_per(r.where("on"), ["video_id", "spot", "frame"], [F.desc("fit"), F.col("det")])
    return ranges.segments(r, "video_id", "spot", "frame", merge_gap).drop(*[c for c in r.columns if c.startswith(("s_", "t_"))], "on")


def main_spot(rows: DataFrame, lengths: DataFrame, share: float, prior: Column | None = None) -> DataFrame:
    """(video_id, main): among spots present in enough frames, the prior's favourite, then the most present, then the first."""
    g = rows.groupBy("video_id", "spot").agg(F.countDistinct("frame").alias("present"), (prior if prior is not None else F.lit(0.0)).alias("prior"))
    g = g.join(lengths, "video_id").where(F.col("present") >= share * F.col("n"))
    return g.groupBy("video_id").agg(F.max_by("spot", F.struct("prior", "present", -F.col("spot"))).alias("main"))


def steady_segments(rows: DataFrame, window: Frames, density: float, active: float = 0.0) -> DataFrame:
    """(video_id, segment, t, cover): frames of each segment's span at which it is steady (and active) within window frames to either side.

    rows: (video_id, segment, frame, active boolean), a row a frame. Each row counts from window frames before it to window frames after it: cover only changes at these two
    ends, which are sorted once and summed as they come; frames between two ends become rows last of all.
    """
    at, w, on = F.col("frame").cast("long"), per_video(window).cast("long"), F.coalesce(F.col("active"), F.lit(False)).cast("int")
    ends = F.array(F.struct((at - w).alias("e"), F.lit(1).alias("s"), on.alias("m")), F.struct((at + w + 1).alias("e"), F.lit(-1).alias("s"), (-on).alias("m")))
    g = rows.select("video_id", "segment", w.alias("w"), F.inline(ends))
    whole = Window.partitionBy("video_id", "segment")
    upto = whole.orderBy("e").rowsBetween(Window.unboundedPreceding, 0)
    g = g.select("*", F.lead("e").over(whole.orderBy("e")).alias("next"), F.sum("s").over(upto).alias("cover"), F.sum("m").over(upto).alias("moving"), F.min("e").over(whole).alias("first"), F.max("e").over(whole).alias("last"))
    g = g.withColumn("lo", F.col("first") + F.col("w")).withColumn("hi", F.col("last") - F.col("w") - 1)
    g = g.withColumn("a", F.greatest("e", "lo")).withColumn("b", F.least(F.col("next") - 1, "hi")).where((F.col("a") <= F.col("b")) & (F.col("cover") >= density) & (F.col("moving") >= active * F.col("cover")))
    g = g.select("video_id", "segment", "w", "lo", "hi", "cover", F.explode(F.sequence("a", "b")).alias("t"))
    width = F.least("hi", F.col("t") + F.col("w")) - F.greatest("lo", F.col("t") - F.col("w")) + 1
    return g.where(F.col("cover") >= density * width).select("video_id", "segment", "t", "cover")


def segment_per_frame(steady: DataFrame, info: DataFrame) -> DataFrame:
    """(video_id, t, segment): the steady segment with the best cover, then prior, then presence, then the earlier one.

    info: (video_id, segment, prior, presence).
    """
    s = steady.join(info, ["video_id", "segment"])
    return s.groupBy("video_id", "t").agg(F.max_by("segment", F.struct("cover", "prior", "presence", -F.col("segment"))).alias("segment"))


def with_main(best: DataFrame, main_spans: DataFrame) -> DataFrame:
    """best, with the main spot's segments over all of their spans (a later segment over an earlier one)."""
    own = main_spans.select("video_id", "segment", F.explode(F.sequence("lo", "hi")).alias("t")).groupBy("video_id", "t").agg(F.max("segment").alias("m"))
    return best.join(own, ["video_id", "t"], "full").select("video_id", "t", F.coalesce("m", "segment").alias("segment"))


def clock(lengths: DataFrame, p: TrackParams, rate: float) -> DataFrame:
    """(video_id, n, and the rule's durations in frames): each video's own rate fps_num / fps_den where lengths has it, else ``rate``."""
    own = F.col("fps_num") / F.col("fps_den") if {"fps_num", "fps_den"} <= set(lengths.columns) else F.lit(float(rate))
    frames = lambda s: F.rint(F.lit(float(s)) * own).cast("long")
    some = F.greatest(F.lit(1), F.floor(F.lit(p.max_visit_share) * F.col("n")))
    times = {"c_gap": p.max_gap_s, "c_anchor": p.anchor_s, "c_merge": p.merge_gap_s, "c_track": p.min_track_s, "c_window": p.window_s, "c_fill": p.fill_min_s}
    # the median's window is half of a duration to either side: rounded after halving
    return lengths.select("video_id", "n", F.least(frames(p.min_visit_s), some).alias("c_visit"), F.rint(F.lit(p.scale_window_s) * own / 2).cast("long").alias("c_half"), *[frames(s).alias(c) for c, s in times.items()])


def signer_choice(rows: DataFrame, lengths: DataFrame, p: TrackParams = TrackParams(), rate: float = 25.0, width: str | None = None, prior: Column | None = None, fill: bool = False) -> DataFrame:
    """(video_id, t, det): the signer's row in each frame that has one; lengths: (video_id, n) frames, and fps_num, fps_den where videos have their own rates.

    rows: posed boxes (video_id, frame, det, x1..y2), with ``active`` if p.min_active asks for it.
    """
    times = settled(clock(lengths, p, rate))
    carry = ("c_visit", "c_anchor", "c_merge", "c_half", "c_track", "c_window", "c_fill")
    boxes = rows.join(F.broadcast(times) if times.count() <= 200_000 else times, "video_id")
    keep = tuple(c for c in boxes.columns if c not in ("video_id", "frame", "det", "n", "c_gap"))
    linked = settled(link_tracks(boxes, p.link_iou, F.col("c_gap"), keep))
    placed = settled(placed_tracks(linked, p, F.col("c_visit"), F.col("c_anchor"), width, carry))
    seg = spot_rows(linked, p, 0, 0, F.col("c_merge"), F.col("c_half"), width, placed.drop(*carry))
    if "active" not in seg.columns:
        seg = seg.withColumn("active", F.lit(True))
    seg = settled(seg)
    prior = prior if prior is not None else F.lit(0.0)
    main = settled(main_spot(seg, lengths.select("video_id", "n"), p.main_share, prior))
    info = seg.groupBy("video_id", "spot", "segment").agg(F.count("*").alias("presence"), F.min("frame").alias("lo"), F.max("frame").alias("hi"), F.max("c_track").alias("c_track"), F.max("c_fill").alias("c_fill"))
    keys = seg.groupBy("video_id", "spot").agg(prior.cast("double").alias("prior"))
    info = info.join(keys, ["video_id", "spot"]).join(main, "video_id", "left")
    info = settled(info)
    is_main = F.coalesce(F.col("spot") == F.col("main"), F.lit(False))
    others = info.where(~is_main & (F.col("presence") >= F.col("c_track")))
    if p.other_iou > 0 or p.other_scale > 0:
        others = gated(others, seg, main, placed, p, width)
    steady = steady_segments(seg.join(others.select("video_id", "segment"), ["video_id", "segment"]), F.col("c_window"), p.min_density, p.min_active)
    best = segment_per_frame(steady, others.select("video_id", "segment", "prior", "presence"))
    best = with_main(best, info.where(is_main).select("video_id", "segment", "lo", "hi"))
    if fill:
        gaps = gap_signers(seg, info.where(is_main), F.col("c_fill"), p.fill_cover, p.min_active)
        filled = gaps.select("video_id", F.col("segment").alias("g"), F.explode(F.sequence("a", F.col("b") - 1)).alias("t"))
        best = best.join(filled, ["video_id", "t"], "left").select("video_id", "t", F.coalesce("g", "segment").alias("segment"))
    at = seg.select("video_id", "segment", F.col("frame").alias("t"), "det")
    return best.join(at, ["video_id", "segment", "t"]).select("video_id", "t", "segment", "det")


def gated(others: DataFrame, seg: DataFrame, main: DataFrame, placed: DataFrame, p: TrackParams, width: str | None = None) -> DataFrame:
    """Segments that fit one of the main spot's anchors: their median box overlaps its box by other_iou, and both sizes are within other_scale.

    placed: placed_tracks(), whose anchors count; of videos without a main spot all segments pass.
    """
    scale = F.median(width) if width else F.lit(None).cast("double")
    own = seg.groupBy("video_id", "segment").agg(*[F.median(c).alias(c) for c in ("x1", "y1", "x2", "y2")], scale.alias("own_scale"))
    held = placed.where("anchor").join(main, "video_id").where("spot = main")
    held = held.select("video_id", *[F.col(c).alias(f"m_{c}") for c in ("x1", "y1", "x2", "y2", "scale")])
    m = box(*[F.col(f"m_{c}") for c in ("x1", "y1", "x2", "y2")])
    ok = (iou(box_of(), m) >= p.other_iou) & fits_scale(area(box_of()), F.col("own_scale"), area(m), F.col("m_scale"), p.other_scale)
    passed = own.join(held, "video_id", "left").where(F.col("m_x1").isNull() | ok).select("video_id", "segment")
    return others.join(passed, ["video_id", "segment"], "left_semi")


def gap_signers(seg: DataFrame, mains: DataFrame, least: Frames, cover: float, active: float = 0.0) -> DataFrame:
    """(video_id, a, b, segment): gaps of the main segments' spans, at least ``least`` frames long, and the segment that fills each.

    The filler must be present in enough of the gap and active enough; the most active, then most present, then earliest one wins.
    """
    from .runs import islands

    spans = mains.select("video_id", F.col("segment").alias("own"), per_video(least).alias("least"), F.explode(F.sequence("lo", "hi")).alias("t"))
    seen = seg.join(mains.select("video_id", "spot").distinct(), ["video_id", "spot"]).select("video_id", F.col("frame").alias("t")).distinct().withColumn("seen", F.lit(True))
    grid = spans.join(seen, ["video_id", "t"], "left").select(F.struct("video_id", "own", "least").alias("key"), "t", F.col("seen").isNull().alias("gone"))
    gaps = islands(grid, "gone", "key").where(F.col("b") - F.col("a") >= F.col("key.least")).select("key.video_id", "key.own", "a", "b")
    other = seg.join(mains.select("video_id", F.col("spot").alias("ms")).distinct(), "video_id").where("spot <> ms")
    hits = by_bucket(other, gaps, "video_id", "frame", "a", "b", GAP_BUCKET, closed=False)
    g = hits.groupBy("video_id", "own", "a", "b", "segment").agg(F.count("*").alias("present"), F.sum(F.col("active").cast("int")).alias("moving"))
    g = g.where((F.col("present") >= cover * (F.col("b") - F.col("a"))) & (F.col("moving") >= active * F.col("present")))
    return g.groupBy("video_id", "a", "b").agg(F.max_by("segment", F.struct("moving", "present", -F.col("segment"))).alias("segment"))


def person_tracks(rows: DataFrame, jump: float = 0.10, keys: tuple[str, ...] = ("video_id",)) -> DataFrame:
    """rows (keys, frame, pos, cx, cy) with ``person``: each joins the nearest person known when its frame began and not yet taken, within jump, else a new one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = frame = None
        for b in batches:
            names = list(zip(*[b.column(k).to_pylist() for k in keys], strict=True))
            t, cx, cy = (b.column(c).to_numpy(zero_copy_only=False) for c in ("frame", "cx", "cy"))
            out = []
            for name, f, x, y in zip(names, t.tolist(), cx.tolist(), cy.tolist(), strict=True):
                if now != name or frame is None:
                    now, frame, last, n = name, None, np.zeros((16, 2)), 0  # last: n people, room for more
                if f != frame:
                    frame, known, taken = f, n, []
                d = np.hypot(last[:known, 0] - x, last[:known, 1] - y)
                if taken:
                    d[taken] = np.inf
                k = int(np.argmin(d)) if known else -1
                if k >= 0 and d[k] <= jump:
                    taken.append(k)
                    last[k] = x, y
                else:
                    if n == len(last):
                        last = np.concatenate([last, np.zeros_like(last)])
                    k, n = n, n + 1
                    last[k] = x, y
                out.append(k)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], names=[*b.schema.names, "person"])

    by = rows.repartition(*keys).sortWithinPartitions(*keys, "frame", "pos")  # read as a stream: the people of one video are held, not its rows
    return by.mapInArrow(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema)}, person long")


def pooled_std(rows: DataFrame, keys: list[str], joints: list[tuple[str, str]], least: int = 10) -> DataFrame:
    """(keys, motion): the largest population deviation of any joint and axis of any person with at least so many observations."""
    each = [F.when(F.count(x) >= least, F.greatest(F.stddev_pop(x), F.stddev_pop(y))) for x, y in joints]
    per = rows.groupBy(*keys, "person").agg((F.greatest(*each) if len(each) > 1 else each[0]).alias("m"))
    return per.groupBy(*keys).agg(F.max("m").alias("motion"))


def match_boxes(pairs: DataFrame, keys: tuple[str, ...] = ("video_id", "frame"), tol: float = 1.0) -> DataFrame:
    """(keys, i, j): one-to-one pairs of two box lists of a frame, nearest first, closer than tol.

    pairs: all pairs of a frame within tol (keys, i, j, dist), which a join with a residual condition gives. A fold, no Python.
    """
    near = pairs.where(F.col("dist") < tol).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("dist", "i", "j"))).alias("p"))
    return near.select(*keys, F.explode(matched(F.col("p"))).alias("m")).select(*keys, "m.i", "m.j")


def matched(p: Column) -> Column:
    """The one-to-one pairs of a frame out of its sorted candidates (dist, i, j): each pair whose sides are both free takes them."""
    free = lambda m, p: F.when(F.exists(m, lambda x: (x["i"] == p["i"]) | (x["j"] == p["j"])), m).otherwise(F.array_append(m, p))
    return F.aggregate(p, F.array().cast("array<struct<dist:double,i:bigint,j:bigint>>"), free)
