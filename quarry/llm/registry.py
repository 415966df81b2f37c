"""Queries of this subpackage: ``{name: (callable, DuckDB SQL or None)}``."""

from __future__ import annotations

REGISTRY: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco
