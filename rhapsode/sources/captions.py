"""Timed text: reading, cleaning and writing WebVTT, as column expressions over whole files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import cue_text
from ..functions.timing import format_millis, parse_timestamp, to_millis

BLANK_LINE = r"\n[ \t]*\n"
#: Blocks that hold no cue.
OTHER_BLOCK = r"^(NOTE|STYLE|REGION)([ \t]|$)"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): a row for each file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def cues_of(files: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, seq, start_s, end_s, text): the cues of WebVTT texts, times as exact decimals.

    Byte order mark, CRLF and CR are accepted; the header may hold the first cue; a cue may have an id line; notes, styles and regions are
    passed over. A block without a timing line (or with one below its second line) is an error, as is a text without the header.
    """
    t = F.regexp_replace(F.regexp_replace(F.col(text), "^﻿", ""), "\r\n?", "\n")
    blocks = F.filter(F.split(F.regexp_replace(t, r"^\n+|\n+$", ""), BLANK_LINE), lambda b: F.trim(F.translate(b, "\n\t", "  ")) != "")
    rows = files.select(F.col(key), blocks.alias("bs"))
    rows = rows.where(F.when(F.get("bs", F.lit(0)).startswith("WEBVTT"), True).otherwise(F.raise_error(F.lit("not a WebVTT file")).cast("boolean")))
    b = rows.select(key, F.posexplode("bs").alias("i", "b")).where((F.col("i") == 0) | ~F.split("b", "\n")[0].rlike(OTHER_BLOCK))
    lines = F.split("b", "\n")
    at = F.array_position(F.transform(lines, lambda x: x.contains("-->")), True) - 1
    b = b.withColumn("lines", lines).withColumn("at", at).where((F.col("at") >= 0) | (F.col("i") > 0))
    bad = (F.col("at") < 0) | ((F.col("i") > 0) & (F.col("at") > 1))
    b = b.where(F.when(bad, F.raise_error(F.lit("block without a timing line")).cast("boolean")).otherwise(True))
    timing = F.get("lines", F.col("at").cast("int"))
    start, rest = F.substring_index(timing, "-->", 1), F.regexp_extract(timing, r"-->[ \t]*(\S*)", 1)
    body = F.array_join(F.slice("lines", F.col("at").cast("int") + 2, 1 << 20), " ")
    return b.select(key, F.col("i").cast("long").alias("seq"), parse_timestamp(start).alias("start_s"), parse_timestamp(rest).alias("end_s"), body.alias("text"))


def cleaned(cues: DataFrame, start_ms: str = "start_ms", end_ms: str = "end_ms") -> DataFrame:
    """cues with cleaned text; those whose text is then empty, or that end at or before their start, are dropped."""
    return cues.withColumn("text", cue_text(F.col("text"))).where((F.col("text") != "") & (F.col(end_ms) > F.col(start_ms)))


def dropped(cues: DataFrame, by: list[str]) -> DataFrame:
    """Cues kept and dropped by cleaning, per group."""
    ok = (cue_text(F.col("text")) != "") & (F.col("end_ms") > F.col("start_ms"))
    return cues.groupBy(*by).agg(F.sum(ok.cast("long")).alias("kept"), F.sum((~ok).cast("long")).alias("dropped"))


def in_millis(cues: DataFrame) -> DataFrame:
    return cues.select("*", to_millis(F.col("start_s")).alias("start_ms"), to_millis(F.col("end_s")).alias("end_ms"))


def block(start_ms: Column, end_ms: Column, text: Column) -> Column:
    return F.concat(format_millis(start_ms), F.lit(" --> "), format_millis(end_ms), F.lit("\n"), text, F.lit("\n"))


def vtt_texts(cues: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """(keys, vtt): the file of each key's cleaned cues, in order."""
    parts = F.array_sort(F.collect_list(F.struct(order, block(F.col("start_ms"), F.col("end_ms"), F.col("text")).alias("b"))))
    return cues.groupBy(*keys).agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(parts, lambda p: p["b"]), "\n")).alias("vtt"))


def dated_captions(videos: DataFrame, by_frame: DataFrame, files: DataFrame) -> DataFrame:
    """(video_id, start_ms, end_ms, text), lower-cased: of each video by its own kind of source.

    videos: (video_id, fps_num, fps_den, frames boolean). Where ``frames``, its rows of by_frame (video_id, begin, end, text) count frames at the exact rate; else
    its WebVTT text is read from files (video_id, text).
    """
    ms = lambda c: F.floor(F.col(c) * F.col("fps_den") * 1000.0 / F.col("fps_num") + 0.5).cast("long")
    counted = by_frame.join(videos.where("frames"), "video_id").select("video_id", ms("begin").alias("start_ms"), ms("end").alias("end_ms"), "text")
    timed = in_millis(cues_of(files.join(videos.where("not frames").select("video_id"), "video_id", "left_semi"), "video_id"))
    return counted.union(timed.select("video_id", "start_ms", "end_ms", "text")).withColumn("text", F.lower("text"))
