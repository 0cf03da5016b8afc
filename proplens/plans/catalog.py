"""Registered queries: one per operator of the workflow, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through the prepared ``sales`` view) so
its work grows with them.  SQL twins for the DuckDB oracle live next to each
query; queries whose result is not expressible in SQL (fitted ML models) have
none and are checked by row counts plus unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from proplens.plans import q_evaluation, q_features, q_models, q_prep, q_reports  # noqa: F401
