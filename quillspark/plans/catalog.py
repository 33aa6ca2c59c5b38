"""Query catalogue: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

import importlib

MODULES = ["q_series", "q_cleaning", "q_reports", "q_text", "q_graph", "q_models"]


def registry() -> dict:
    out: dict = {}
    for m in MODULES:
        mod = importlib.import_module(f"{__package__}.{m}")
        for k, v in mod.REGISTRY.items():
            if k in out:
                raise ValueError(f"duplicate query name {k}")
            out[k] = v
    return out
