"""What has to be computed again: state tables, hashes, retries, log sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stage import settled


def resume_action(wanted: DataFrame, done: DataFrame, key: str = "video_id") -> DataFrame:
    """(key, action): skip where both hashes and sizes match and the summary exists; derive where only the derived part is old; else extract.

    wanted: (key, extraction_hash, derivation_hash, bytes, has_meta); done: (key, done_extraction, done_derivation, done_bytes).
    """
    j = wanted.join(done, key, "left")
    raw = F.coalesce((F.col("done_extraction") == F.col("extraction_hash")) & (F.col("done_bytes") == F.col("bytes")), F.lit(False))
    derived = F.coalesce((F.col("done_derivation") == F.col("derivation_hash")) & F.col("has_meta"), F.lit(False))
    return j.select(key, F.when(~raw, "extract").when(~derived, "derive").otherwise("skip").alias("action"))


def schedule(videos: DataFrame, order: tuple[str, ...], limit: int | None = None) -> DataFrame:
    """videos by split order (others last), then size, largest first, then id."""
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("split"))
    rank = F.when(rank > 0, rank).otherwise(len(order) + 1)
    out = videos.orderBy(rank, F.desc("size"), "video_id")
    return out.limit(limit) if limit is not None else out


def round_robin(videos: DataFrame, order: tuple[str, ...], seed: int = 0) -> DataFrame:
    """videos with ``place``: splits in turn, each in a seeded hash order.

    Turns are counted in buckets of the hash, to which the sizes of the buckets before are added; places follow from the sizes of the splits,
    so that no task sorts a whole split, or all videos. With an order of many splits the sizes are a row of as many numbers.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("split"))
    rank = F.when(rank > 0, rank).otherwise(len(order) + 1).cast("int")
    shuffled = F.sha2(F.concat_ws("/", F.lit(str(seed)), F.col("video_id").cast("string")), 256)
    v = videos.withColumn("rank_", rank).withColumn("hash_", shuffled).withColumn("bucket_", F.substring("hash_", 1, 3))
    sizes = v.groupBy("rank_", "bucket_").agg(F.count("*").alias("size_"))  # 4,096 buckets a split
    before = F.sum("size_").over(Window.partitionBy("rank_").orderBy("bucket_")) - F.col("size_")
    turn = F.row_number().over(Window.partitionBy("rank_", "bucket_").orderBy("hash_")) + F.col("before_")
    v = v.join(F.broadcast(sizes.withColumn("before_", before).drop("size_")), ["rank_", "bucket_"]).withColumn("turn_", turn)
    of = [F.coalesce(F.sum(F.when(F.col("rank_") == r, F.col("size_"))), F.lit(0)) for r in range(1, len(order) + 2)]
    v = v.join(F.broadcast(sizes.agg(F.array(*of).alias("sizes_"))))  # one row
    ahead = F.transform("sizes_", lambda n, i: F.least(n, F.col("turn_") - F.when(i + 1 < F.col("rank_"), 0).otherwise(1)))
    place = F.aggregate(ahead, F.lit(0).cast("long"), lambda s, x: s + x) + 1
    return v.withColumn("place", place.cast("int")).select(*videos.columns, "place")


def spread_windows(videos: DataFrame, windows: int, length: int, n: str = "nb_frames", seed: int = 0) -> DataFrame:
    """(video_id, start, count): one window at a hashed offset in each of so many equal parts, or the whole where they don't fit."""
    k = F.explode(F.sequence(F.lit(0), F.lit(windows - 1)))
    v = videos.select("video_id", F.col(n).alias("n"), F.when(F.col(n) > windows * length, F.lit(True)).otherwise(False).alias("fits"))
    parts = v.where("fits").select("video_id", "n", k.alias("k"))
    lo, hi = F.floor(F.col("k") * F.col("n") / windows), F.floor((F.col("k") + 1) * F.col("n") / windows)
    draw = F.conv(F.substring(F.sha2(F.concat_ws("/", F.lit(str(seed)), F.col("video_id").cast("string"), F.col("k").cast("string")), 256), 1, 12), 16, 10).cast("long")
    some = parts.select("video_id", (lo + draw % (hi - lo - length + 1)).cast("long").alias("start"), F.lit(length).cast("long").alias("count"))
    return some.union(v.where("not fits").select("video_id", F.lit(0).cast("long"), F.col("n").cast("long")))


def retry_policy(attempts: DataFrame, most: int = 2) -> DataFrame:
    """(video_id, failures, suspicions, status) of attempt events (video_id, outcome: ok, failed or suspected).

    A video is done once an attempt is ok, failed after so many failures or suspicions, and else queued again.
    """
    n = lambda o: F.sum((F.col("outcome") == o).cast("long"))
    g = attempts.groupBy("video_id").agg(n("ok").alias("oks"), n("failed").alias("failures"), n("suspected").alias("suspicions"))
    status = F.when(F.col("oks") > 0, "done").when((F.col("failures") >= most) | (F.col("suspicions") >= most), "failed").otherwise("queued")
    return g.select("video_id", "failures", "suspicions", status.alias("status"))


def silent_periods(beats: DataFrame, key: str, ts: str, seconds: int) -> DataFrame:
    """(key, last_seen, silence_s): times after which nothing came for longer than so many seconds."""
    w = Window.partitionBy(key).orderBy(ts)
    gap = F.unix_micros(F.lead(ts).over(w)) - F.unix_micros(ts)
    return beats.withColumn("g_", gap).where(F.col("g_") > seconds * 1_000_000).select(key, F.col(ts).alias("last_seen"), F.floor(F.col("g_") / 1_000_000).cast("long").alias("silence_s"))


def respawns(silent: DataFrame, key: str, last_seen: str, seconds: int, limit: int = 3, window_s: int = 3600) -> DataFrame:
    """silent periods with (recent, allowed): how many respawns fell into the last ``window_s`` seconds, this one included, and whether it is allowed.

    A worker is respawned ``seconds`` after it was last seen; once one would be the respawn after ``limit`` within the window, it and all later ones are not allowed.
    """
    at = F.unix_micros(last_seen) + seconds * 1_000_000
    w = Window.partitionBy(key).orderBy("at_")
    s = silent.withColumn("at_", at).withColumn("recent", F.count("*").over(w.rangeBetween(-window_s * 1_000_000, Window.currentRow)))
    over = F.max((F.col("recent") > limit).cast("int")).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return s.withColumn("allowed", over == 0).drop("at_")


#: Fixed patterns of log markers and repeated lines.
MARKER = r"^(.*?)(BEGIN|END|COMMIT) ([A-Za-z0-9._-]+)(?: attempt (\d+))? at (\S+)$"
REPEATED = r"^\s*Last message repeated \d+ times?\s*$"


def log_sessions(lines: DataFrame, log: str = "log", n: str = "n", text: str = "line") -> DataFrame:
    """(video_id, lines): what was printed while each video's last committed session was open; videos without such lines are left out.

    lines: (log, n, line), logs in the order of their names. A session ends at its END, at the next BEGIN or with the log. A COMMIT inside it counts at its end; a
    later one takes the video's last session of that log. Text before a marker on its line belongs to the open session.
    """
    part = lambda i: F.regexp_extract(text, MARKER, i)
    w = Window.partitionBy(log).orderBy(n).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = lines.withColumn("kind", F.when(F.col(text).rlike(MARKER), part(2)).otherwise("")).withColumn("who", part(3)).withColumn("before", F.trim(part(1)))
    x = x.withColumn("session", F.sum((F.col("kind") == "BEGIN").cast("long")).over(w))
    open_by = F.max(F.when(F.col("kind") == "BEGIN", F.struct(n, "who"))).over(w)["who"]
    ws = Window.partitionBy(log, "session").orderBy(n)
    x = x.withColumn("video", open_by)
    ended = F.coalesce(F.max(((F.col("kind") == "END") & (F.col("who") == F.col("video"))).cast("int")).over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    x = x.withColumn("open", (F.col("session") > 0) & ~ended)
    said = F.when(F.col("kind") == "", F.when((F.trim(text) != "") & ~F.col(text).rlike(REPEATED), F.col(text))).when(F.col("before") != "", F.col("before"))
    # a BEGIN's own line belongs to the session before it only by what stands in front of the marker
    x = x.withColumn("said", F.when(F.col("open") & (F.col("kind") != "BEGIN"), said))
    spill = F.lead(F.when((F.col("kind") == "BEGIN") & (F.col("before") != ""), F.struct("before"))).over(Window.partitionBy(log).orderBy(n))
    x = x.withColumn("spill", F.when(F.col("open"), spill["before"]))
    # which session counts is settled by numbers alone; only its lines are gathered
    marks = settled(x.where(F.col("kind").isin("BEGIN", "COMMIT") & (F.col("session") > 0)).select(log, "kind", F.col("who").alias("video"), "session"))
    begun = marks.where("kind = 'BEGIN'").select(log, "video", "session")
    first = begun.groupBy(log, "video").agg(F.min("session").alias("first"))
    at = marks.where("kind = 'COMMIT'").groupBy(log, "video").agg(F.max("session").alias("at")).join(first, [log, "video"]).where("first <= at")
    last = at.groupBy("video").agg(F.max(F.struct(log, "at")).alias("c")).select("video", f"c.{log}", "c.at")
    chosen = begun.join(last, [log, "video"]).where("session <= at").groupBy(log, "video").agg(F.max("session").alias("session"))
    spoken = x.select(log, "session", "video", n, F.array_compact(F.array("said", "spill")).alias("t")).where(F.size("t") > 0).join(chosen, [log, "session", "video"], "left_semi")
    taken = spoken.groupBy("video").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(n).alias("n"), "t"))), lambda a: a["t"])).alias("lines"))
    return taken.select(F.col("video").alias("video_id"), "lines")


def heartbeats(rows: DataFrame, key: str, ts: str, seconds: int = 15) -> DataFrame:
    """(key, beats): beats from each key's first row to its last, one every so many seconds."""
    span = F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))
    return rows.groupBy(key).agg((F.floor(span / (seconds * 1_000_000)) + 1).cast("long").alias("beats"))


def merge_points(commits: DataFrame, key: str, ts: str, every: int = 50, seconds: int = 1800) -> DataFrame:
    """(key, merges, left): how often a merge is due, after so many commits or so long after the last one, and the commits since it.

    A fold over each key's commits in time order: whether one is due depends on when the last one was.
    """
    at = F.array_sort(F.collect_list(F.unix_micros(ts)))
    rows = commits.groupBy(key).agg(at.alias("at"))
    start = F.struct(F.element_at("at", 1).alias("last"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("merges"))

    def step(s, t):
        due = (s["n"] + 1 >= every) | (t - s["last"] >= seconds * 1_000_000)
        return F.struct(F.when(due, t).otherwise(s["last"]).alias("last"), F.when(due, F.lit(0).cast("long")).otherwise(s["n"] + 1).alias("n"), (s["merges"] + due.cast("long")).alias("merges"))

    done = F.aggregate("at", start, step)
    return rows.select(key, done.alias("s")).select(key, F.col("s.merges").alias("merges"), F.col("s.n").alias("left"))
