"""Registry of named queries: a Spark callable plus (optionally) DuckDB SQL.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole input tables. The SQL is an independent formulation of the same
result used as the correctness oracle; it is omitted for iterative or
non-SQL operators, which are unit-tested against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def rnd_sql(x: str, n: int) -> str:
    """SQL twin of ``functions.numeric.rnd`` (half away from zero)."""
    return f"((CASE WHEN ({x}) < 0 THEN -1e0 ELSE 1e0 END) * floor(abs({x}) * 1e{n} + 5e-1 + 1e-9) / 1e{n})"


def avg_sql(x: str) -> str:
    """The plain double mean."""
    return f"AVG({x})"


def clamp_sql(x: str, lo: str, hi: str) -> str:
    return f"greatest({lo}, least({hi}, {x}))"


def load_all() -> None:
    """Import every query module so that it registers itself."""
    import importlib
    for m in ("reading_queries", "ingest_queries", "segment_queries", "weather_queries",
              "incident_queries", "construction_queries", "model_queries", "kept_queries", "layout_queries"):
        importlib.import_module(f"corridor.plans.{m}")
