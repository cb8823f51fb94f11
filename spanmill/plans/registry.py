"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

from . import (queries, queries_assemble, queries_extra, queries_generate,  # noqa: F401
               queries_profile, queries_rules)
from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
