"""All registered queries and their SQL."""

from __future__ import annotations

from . import queries_connect, queries_more, queries_ops, queries_pages, queries_steps, queries_text  # noqa: F401  they register their queries
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
