"""Registry of driver queries: Spark plan + DuckDB oracle SQL per name."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def query(name: str, oracle: str | None = None, headline: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        if headline:
            HEADLINE.append(name)
        return fn
    return deco
