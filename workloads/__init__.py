"""Registered queries: each Spark query next to the SQL that states its expected result."""

from __future__ import annotations

import importlib

MODULES = ["market", "quality", "encoding", "anomaly", "modeling", "retrieval", "streaming", "sources"]


def load():
    """All registered queries and their SQL."""
    for name in MODULES:
        importlib.import_module(f"workloads.{name}")
    from workloads.base import QUERIES, SQL

    return QUERIES, SQL
