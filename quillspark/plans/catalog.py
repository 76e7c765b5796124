"""All queries by name, and their DuckDB twins."""

from __future__ import annotations

from . import recovery, relational, runs, scalars, sources, texts  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
