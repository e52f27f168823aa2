"""All contract queries, imported for their registration side effect."""

from __future__ import annotations

import importlib

from .registry import CHECK, ORACLE, QUERIES

MODULES = [
    "q_windows",
    "q_graph",
    "q_sketch",
    "q_text",
    "q_ingest",
    "q_risk",
    "q_anomaly",
    "q_stream",
]

for _m in MODULES:
    importlib.import_module(f"{__package__}.{_m}")

__all__ = ["QUERIES", "ORACLE", "CHECK"]
