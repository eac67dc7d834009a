"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["union_distinct", "union_all", "union_ragged", "union_tagged", "id_difference"]


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenate same-shape frames by name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SQL ``UNION`` (distinct rows)."""
    return union_all(*dfs).distinct()


def union_ragged(*dfs: DataFrame) -> DataFrame:
    """U3/schema drift: union of differing schemas, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_tagged(parts: dict, tag: str) -> DataFrame:
    """Union with a literal provenance column (sheet, form type, site)."""
    return union_ragged(*[df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


def id_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """U4: distinct ids of ``a`` absent from ``b``."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")
