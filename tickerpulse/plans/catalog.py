"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

from . import q_counts, q_market, q_sinks, q_sources, q_streaming, q_text, q_views  # noqa: F401
from .registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
