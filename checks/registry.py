"""One registry of queries; each may carry the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pricetide.session import shared_folder
from pricetide.sources.readers import load_or_build

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def with_ctes(*parts: str) -> str:
    """A WITH list, and the final select as the last part."""
    *ctes, final = parts
    return "with " + ",\n".join(c.strip() for c in ctes) + "\n" + final


_KEPT: dict = {}


def once(name: str, spark, folder: str, build):
    """A model or other driver-side object that several queries share, built once per application."""
    key = (name, spark.sparkContext.applicationId, folder)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def staged(name: str, spark, folder: str, build):
    """A pipeline stage as Parquet in the shared folder, written by the first query that needs it."""
    path = once(f"stage-{name}", spark, folder, lambda: shared_folder(spark, name))
    return load_or_build(spark, path, build)
