"""Registered queries: name → (Spark callable, SQL or None), collected from the modules here."""

from __future__ import annotations

from . import alignment, features, panel, screens, sources, streams, versions, windows

MODULES = (sources, versions, alignment, windows, features, panel, screens, streams)


def collect() -> tuple[dict, dict]:
    queries, oracle = {}, {}
    for module in MODULES:
        for name, (run, sql) in module.QUERIES.items():
            if name in queries:
                raise ValueError(f"query {name!r} is registered twice")
            queries[name] = run
            if sql is not None:
                oracle[name] = sql
    return queries, oracle
