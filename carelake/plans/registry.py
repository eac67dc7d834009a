"""Query registry: each key pairs a Spark builder with its DuckDB oracle SQL.

A builder takes ``(spark, sf_dir)`` and returns a DataFrame; it reads the
given tables (or data Spark derives from them), never a made-up input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.session import apply_runtime_conf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy attribute access to the parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._cache[name]


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name`` with its oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all():
    """Import every query module so that all keys are registered."""
    from carelake.plans import (  # noqa: F401
        q_cohorts, q_aggregates, q_sequences, q_lookups, q_functions, q_filters,
        q_loads, q_domain, q_streams, q_sources, q_panels, q_commits, q_landed, q_routine,
    )
    return QUERIES, ORACLES
