"""Queries by name, gathered from the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from strandframe.plans import queries_demux, queries_enrich, queries_explore, queries_sequence, queries_sources
from strandframe.sources.package import ship

_MODULES = (queries_sequence, queries_demux, queries_enrich, queries_explore, queries_sources)


def _shipped(f: Callable) -> Callable:
    def run(spark, sf_dir):
        ship(spark)
        return f(spark, sf_dir)

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    return run


def queries() -> dict[str, Callable]:
    return {name: _shipped(f) for m in _MODULES for name, (f, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, (_, sql) in m.QUERIES.items() if sql}
