"""Registry of the named analyses (one per SURVEY section 2 operator).

Each entry binds an operator of ``tidemark.operators`` to its input tables:
``build(spark, sf_dir) -> DataFrame`` plus, where the result is expressible
in SQL, the DuckDB text that must give the same rows.  ``__spark_entry__``
only exposes this registry.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .sources.fixture_sql import with_views


@dataclass(frozen=True)
class Analysis:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Analysis] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate analysis {name}")
        REGISTRY[name] = Analysis(name, fn, with_views(sql) if sql else None)
        return fn
    return deco


def load_all() -> dict[str, Analysis]:
    # importing the suite modules fills REGISTRY
    from . import suite  # noqa: F401
    return REGISTRY
