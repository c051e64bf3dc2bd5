"""Queries of this subpackage, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from creditloom.queries.registry import Query

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run

    return register
