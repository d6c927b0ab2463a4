"""Queries of this subpackage: ``opN_<name>`` per operator plus ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from tickframe.llm import queries as _q


def queries() -> dict[str, Callable]:
    import corpus_pipeline

    return {**_q.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    out = dict(_q.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
