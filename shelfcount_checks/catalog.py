"""All registered queries."""

from __future__ import annotations

from . import cleaning, files, matching, staff, streams, summaries  # noqa: F401
from .inputs import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
