"""Registered queries with their DuckDB counterparts, by area."""

from __future__ import annotations

from kawaraban.queries import (  # noqa: F401  (importing registers)
    articles,
    jobs,
    markup,
    sentences,
    strings,
    upkeep,
)
from kawaraban.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
