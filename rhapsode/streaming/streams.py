"""Structured Streaming forms of the stateful operators.

Segments are session windows (a segment ends after so many empty seconds), the tracker keeps its open tracks in state, chunks are checked for
order, and commits are idempotent by partition.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tracks import Linker


def segments(rows: DataFrame, key: str, ts: str, gap: str, late: str) -> DataFrame:
    """(key, first_seen, last_end, n): runs of rows at most gap apart; rows later than ``late`` behind the newest are dropped."""
    g = rows.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap)).agg(F.count("*").alias("n"))
    return g.select(key, F.col("session_window.start").alias("first_seen"), F.col("session_window.end").alias("last_end"), "n")


def tumbling(rows: DataFrame, key: str, ts: str, width: str, late: str, slide: str | None = None) -> DataFrame:
    """Counts and sums of value in windows of event time."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    g = rows.withWatermark(ts, late).groupBy(key, w).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(key, F.col("window.start").alias("start"), "n", "total")


def tracks(boxes: DataFrame, link_iou: float = 0.5, max_gap: int = 25) -> DataFrame:
    """(video_id, frame, det, track): the tracker over a stream; frames of a video must come in order over the batches, in any order within one."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(["frame", "det"], kind="stable")
        old = None
        if state.exists:
            ids, box, last, nxt, seen = json.loads(state.get[0])
            old = (ids, np.array(box, dtype=np.float64).reshape(-1, 4), last, nxt)
            if rows["frame"].min() <= seen:
                raise ValueError(f"video {key[0]}: frame {rows['frame'].min()} after frame {seen}")
        linker = Linker(link_iou, max_gap, old)
        found = linker.rows(rows["frame"].to_numpy(dtype=np.int64), rows[["x1", "y1", "x2", "y2"]].to_numpy(dtype=np.float64))
        ids, box, last, nxt = linker.state()
        state.update((json.dumps([ids, box.tolist(), last, nxt, int(rows["frame"].max())]),))
        yield rows[["frame", "det"]].assign(video_id=key[0], track=found)[["video_id", "frame", "det", "track"]]

    from pyspark.sql.streaming.state import GroupStateTimeout

    return boxes.groupBy("video_id").applyInPandasWithState(step, "video_id long, frame long, det long, track long", "state string", "append", GroupStateTimeout.NoTimeout)


def contiguous(chunks: DataFrame) -> DataFrame:
    """(video_id, frames): chunks (video_id, start, count) must follow each other; an empty last one is legal."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        so_far = state.get[0] if state.exists else 0
        for start, count in pd.concat(list(frames)).sort_values(["start", "count"])[["start", "count"]].itertuples(index=False):
            if start != so_far:
                raise ValueError(f"video {key[0]}: chunk at {start}, expected {so_far}")
            so_far += int(count)
        state.update((so_far,))
        yield pd.DataFrame({"video_id": [key[0]], "frames": [so_far]})

    from pyspark.sql.streaming.state import GroupStateTimeout

    return chunks.groupBy("video_id").applyInPandasWithState(step, "video_id long, frames long", "so_far long", "update", GroupStateTimeout.NoTimeout)


def followed(expected: DataFrame, commits: DataFrame, grace: str, late: str) -> DataFrame:
    """(key, video_id, ts, committed_at): each expected row (key, video_id, ts) with each commit (video_id, ts) of its video up to ``grace`` after it, or once with null when the
    watermark has passed that time without one.

    A stream-stream outer join: state holds what is within grace and lateness, and rows later than ``late`` behind the newest of their stream are dropped.
    """
    e = expected.withWatermark("ts", late)
    c = commits.select(F.col("video_id").alias("of"), F.col("ts").alias("committed_at")).withWatermark("committed_at", late)
    within = (F.col("video_id") == F.col("of")) & (F.col("committed_at") >= F.col("ts")) & (F.col("committed_at") <= F.col("ts") + F.expr(f"interval {grace}"))
    return e.join(c, within, "leftOuter").drop("of")


def log_sessions(lines: DataFrame) -> DataFrame:
    """(video_id, log, at, session, n, lines): what ``incremental.log_sessions`` finds, as logs grow; lines (log, n, line) of a log must come in order over the batches.

    A row comes for a COMMIT, with the lines of the video's last session so far, and again when that session, still open, has got more. The row of the greatest (log, at, session, n) is the
    video's state; ``last_sessions`` takes it. State of a log: its session, and the last and the committed session of each video.
    """
    import re

    from ..operators.incremental import MARKER, REPEATED

    marker, repeated = re.compile(MARKER), re.compile(REPEATED)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        s = json.loads(state.get[0]) if state.exists else {"session": 0, "video": None, "ended": False, "was_open": False, "seen": -1, "lines": {}, "last": {}, "taken": {}}
        touched: set[str] = set()
        rows = pd.concat(list(frames)).sort_values("n", kind="stable")
        if len(rows) and rows["n"].iloc[0] <= s["seen"]:
            raise ValueError(f"log {key[0]}: line {rows['n'].iloc[0]} after line {s['seen']}")

        def say(text: str) -> None:
            s["lines"][str(s["session"])].append(text)
            touched.add(str(s["session"]))

        for text in rows["line"]:
            m = marker.match(text)
            kind, who, before = (m.group(2), m.group(3), m.group(1).strip(" ")) if m else ("", "", "")
            if kind == "BEGIN":
                if before and s["was_open"]:
                    say(before)
                s["session"], s["video"], s["ended"], s["was_open"] = s["session"] + 1, who, False, True
                s["lines"][str(s["session"])], s["last"][who] = [], s["session"]
                continue
            s["was_open"] = s["session"] > 0 and not s["ended"]
            if s["was_open"]:
                if kind and before:
                    say(before)
                elif not kind and text.strip(" ") and not repeated.match(text):
                    say(text)
            if kind == "END" and who == s["video"]:
                s["ended"] = True
            if kind == "COMMIT" and s["session"] > 0 and who in s["last"]:
                s["taken"][who] = [s["session"], s["last"][who]]
                touched.add(str(s["last"][who]))
        s["seen"] = int(rows["n"].iloc[-1]) if len(rows) else s["seen"]
        needed = {str(s["session"]), *(str(x) for x in s["last"].values()), *(str(x) for _, x in s["taken"].values())}
        s["lines"] = {k: v for k, v in s["lines"].items() if k in needed}
        state.update((json.dumps(s),))
        out = [(who, key[0], at, session, s["seen"], s["lines"][str(session)]) for who, (at, session) in s["taken"].items() if str(session) in touched]
        yield pd.DataFrame(out, columns=["video_id", "log", "at", "session", "n", "lines"])

    from pyspark.sql.streaming.state import GroupStateTimeout

    return lines.groupBy("log").applyInPandasWithState(step, "video_id string, log long, at long, session long, n long, lines array<string>", "state string", "append", GroupStateTimeout.NoTimeout)


def last_sessions(rows: DataFrame) -> DataFrame:
    """(video_id, lines) of what ``log_sessions`` has given so far."""
    last = rows.groupBy("video_id").agg(F.max_by("lines", F.struct("log", "at", "session", "n")).alias("lines"))
    return last.where(F.size("lines") > 0)


def run_to_table(stream: DataFrame, path: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Runs a stream over all that is there now (with backpressure as its source sets it) into Parquet, or through ``each``."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}.state").trigger(availableNow=True)
    q = w.foreachBatch(each).start() if each else w.format("parquet").start(path)
    q.awaitTermination()


def replace_partitions(path: str, by: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes a batch's partitions whole, so that a batch that comes again changes nothing."""

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)

    return put


def put_batch(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A sink for update mode: each batch in a folder of its own epoch; the last value of each key is read back by latest()."""

    def put(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{path}/epoch={epoch:08d}")

    return put
