"""Seconds, frames, time stamps and their three roundings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_to_frames(seconds: Column | float, fps: Column) -> Column:
    """Frames of a duration, rounded up but for a hundredth of a frame, at least 1."""
    return F.greatest(F.lit(1), F.ceil(fps * seconds - 0.01)).cast("long")


def round_half_even(x: Column) -> Column:
    return F.rint(x).cast("long")


def duration(frames: Column, num: Column, den: Column) -> Column:
    return frames * den / num


def loader_fps(frames: Column, num: Column, den: Column) -> Column:
    """Frames over the duration, in this order of operations."""
    return frames / duration(frames, num, den)


_STAMP = r"^(?:(\d+):)?(\d{1,2}):(\d{1,2})(?:[.,](\d+))?$"


def parse_timestamp(text: Column) -> Column:
    """[HH:]MM:SS[.,fraction] as exact decimal seconds; null if it isn't one."""
    t = F.trim(text)
    part = lambda i: F.regexp_extract(t, _STAMP, i)
    whole = F.coalesce(F.nullif(part(1), F.lit("")).cast("long"), F.lit(0)) * 3600 + part(2).cast("long") * 60 + part(3).cast("long")
    exact = F.concat(whole.cast("string"), F.lit("."), F.rpad(part(4), 9, "0")).cast("decimal(20,9)")
    return F.when(t.rlike(_STAMP), exact)


def to_millis(seconds: Column) -> Column:
    """Whole milliseconds, rounded half up, from exact decimals."""
    return F.floor(seconds.cast("decimal(20,9)") * 1000 + F.lit(0.5).cast("decimal(2,1)")).cast("long")


def format_millis(ms: Column) -> Column:
    """HH:MM:SS.mmm; an error below 0."""
    text = F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3_600_000).cast("long"), (F.floor(ms / 60_000) % 60).cast("long"), (F.floor(ms / 1000) % 60).cast("long"), ms % 1000)
    return F.when(ms >= 0, text).otherwise(F.raise_error(F.lit("negative time")))
