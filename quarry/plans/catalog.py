"""Registry of table-in, table-out jobs: key -> (Spark builder, oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables. The oracle SQL (DuckDB dialect, driver tables pre-registered as
views) states the same answer declaratively; keys without SQL are checked by
fixtures in ``tests/``. Column names and types agree on both sides: counts are
``bigint``, floating results are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every area module so its keys register."""
    from . import (q_graph, q_rating, q_basket, q_roc, q_text,  # noqa: F401
                   q_answers, q_cluster, q_io)
