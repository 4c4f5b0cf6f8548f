"""Ids, names, cells and classifiers of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns and value lists.
SAFE_ID = r"^[A-Za-z0-9._-]+$"
SEGMENT_ID = r"_segment_\d+$"
TAG = r"\[[A-Z][A-Z _-]*\]"
TRACK = r"^[A-Za-z0-9][A-Za-z0-9-]*$"
CAPTION_SOURCES = ("human", "mt", "shard", "none")
DECODER_LINE = r"\[[^\[\]@]+ @ 0x[0-9A-Fa-f]+\] |\[ ?(?:WARN|ERROR|FATAL)[^\]]*\].*(?:videoio|cap_)"
GPU_ERROR = r"(?i)cuda|cudnn|cublas|tensorrt|nvrtc|device-side assert"


def safe_id(text: Column) -> Column:
    """Runs of characters that ids can't hold become one underscore; none at either end."""
    return F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def id_valid(text: Column) -> Column:
    return text.rlike(SAFE_ID) & ~text.rlike(SEGMENT_ID)


def id_from_date(name: Column, prefix: str) -> Column:
    """'... D M YYYY' to 'prefix_YYYY-MM-DD'; null if the name ends otherwise."""
    pattern = r"(\d{1,2}) (\d{1,2}) (\d{4})$"
    d, m, y = (F.lpad(F.regexp_extract(name, pattern, i), 4 if i == 3 else 2, "0") for i in (1, 2, 3))
    return F.when(name.rlike(pattern), F.concat(F.lit(prefix + "_"), y, F.lit("-"), m, F.lit("-"), d))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))


def cue_text(text: Column) -> Column:
    """White space collapsed; the arrow that would read as a timing line is shortened."""
    return F.regexp_replace(collapse(text), "-->", "->")


def relative_path(path: Column, root: str) -> Column:
    root = root if root.endswith("/") else root + "/"
    return F.when(path.startswith(root), F.substring(path, len(root) + 1, 1 << 20)).otherwise(path)


def cell(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def ratio_cell(value: Column) -> Column:
    return F.coalesce(F.format_string("%.4f", value), F.lit(""))


def canonical_hash(**fields: Column) -> Column:
    """sha256 of 'name=value' lines in the order of names; null values read as null."""
    lines = [F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit("null"))) for k, v in sorted(fields.items())]
    return F.sha2(F.concat_ws("\n", *lines), 256)


def extraction_hash(fields: dict[str, Column], rule: Column, params: Column, plain: tuple[str, ...] = ("largest_bbox", "highest_score")) -> Column:
    """The hash of what decides detections; the posing rule enters only where it isn't a plain one."""
    own = ~rule.isin(*plain)
    return canonical_hash(**fields, posing_rule=F.when(own, rule), posing_rule_params=F.when(own, params))


def derivation_hash(fields: dict[str, Column], rule: Column, params: Column, meta_version: int) -> Column:
    """The hash of what decides derived rows: rule, its parameters, and the version of the definitions."""
    return canonical_hash(**fields, primary_rule=rule, primary_rule_params=params, meta_version=F.lit(meta_version))


def commit_hash(fields: dict[str, Column], rule: Column) -> Column:
    """The hash of a first commit: without parameters and version, so that it never equals derivation_hash()."""
    return canonical_hash(**fields, primary_rule=rule)
