"""Query catalogue.

``@query(key, oracle=...)`` registers a callable (spark, sf_dir) -> DataFrame
and, when the operation is SQL-expressible, the DuckDB SQL computing the
same result from the base tables.  Column names are aliased identically
on both sides; floats are rounded the same way on both sides.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

PLAN_MODULES = ("scans", "portfolio_q", "windows_q", "cleaning_q", "risk_q", "joins_q", "screening_q",
                "matrices_q", "sources_q", "models_q", "cluster_q", "optimize_q",
                "streams_q", "vendor_q")


def query(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def load_all() -> None:
    for m in PLAN_MODULES:
        mod = importlib.import_module(f"tickframe.plans.{m}")
        if hasattr(mod, "register"):
            mod.register()


def queries() -> dict[str, Callable]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
