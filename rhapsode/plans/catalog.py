"""All registered queries of the frame-series operators, and their SQL."""

from __future__ import annotations

from . import extras, frames, scalars, series, tables, tracking  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401

FLAGSHIP = "frame_people"
