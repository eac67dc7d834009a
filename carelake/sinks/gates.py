"""Incremental-load control.

Gates and probes are one-row DataFrames (aggregates without grouping keys),
so the decision costs one small job and only one row reaches the driver.
Keyed dedupe is a left anti join: the batch's keys never travel to the
driver as an ``IN (...)`` list, so an empty batch cannot produce broken SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.dates import in_range, monday_of
from carelake.operators.lookup import anti

__all__ = [
    "gate", "gates", "rows_after", "range_probe", "watermark_of", "new_rows", "new_in_partitions", "new_ids", "fallback_period",
    "load_window", "mark_new_vs_previous",
]


def load_window(grain: str, on: dt.date, legacy_week: bool = False) -> tuple[dt.date, dt.date]:
    """Half-open ``[lo, hi)`` day bounds for a gate grain.

    weekly: Monday .. next Monday (7 days); ``legacy_week`` stops before the
    Sunday (Monday <= d < Sunday), as the source gate did.
    """
    if grain == "daily":
        return on, on + dt.timedelta(days=1)
    if grain == "monthly":
        lo = on.replace(day=1)
        hi = (lo + dt.timedelta(days=32)).replace(day=1)
        return lo, hi
    if grain == "weekly":
        lo = monday_of(on)
        return lo, lo + dt.timedelta(days=6 if legacy_week else 7)
    raise ValueError(f"unknown grain {grain!r}")


def gates(log: DataFrame, table: str, on: dt.date, grains: dict, table_col: str = "idBigquery",
          at_col: str = "fechaCargue") -> DataFrame:
    """G1-G3 for several grains at once: one row, one scan of the log.

    ``grains``: column name -> (grain, legacy_week). The scan is bounded by
    the widest window.
    """
    days = {n: load_window(g, on, lg) for n, (g, lg) in grains.items()}
    lo, hi = min(d[0] for d in days.values()), max(d[1] for d in days.values())
    hits = log.filter((F.col(table_col) == F.lit(table)) & in_range(at_col, lo, hi))
    return hits.agg(*[F.count_if(in_range(at_col, a, z)).alias(n) for n, (a, z) in days.items()])


def gate(log: DataFrame, table: str, grain: str, on: dt.date, legacy_week: bool = False,
         table_col: str = "idBigquery", at_col: str = "fechaCargue") -> DataFrame:
    """``totalCargues`` loads of ``table`` in the grain's window and
    ``proceed`` = 1 when there were none."""
    lo, hi = load_window(grain, on, legacy_week)
    hits = log.filter((F.col(table_col) == F.lit(table)) & in_range(at_col, lo, hi))
    return hits.agg(F.count(F.lit(1)).alias("totalCargues")).withColumn(
        "proceed", F.when(F.col("totalCargues") == 0, 1).otherwise(0))


def range_probe(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """``has_rows`` 0/1 for ``lo <= col <= hi`` (stops at the first row)."""
    return df.filter(F.col(col).between(F.lit(lo), F.lit(hi))).limit(1).agg(
        F.count(F.lit(1)).alias("has_rows"))


def watermark_of(df: DataFrame, col: str, name: str = "watermark") -> DataFrame:
    """``max(col)`` as a one-row frame."""
    return df.agg(F.max(col).alias(name))


def rows_after(df: DataFrame, col: str, target: DataFrame, target_col: str | None = None) -> DataFrame:
    """Rows after the target's high watermark, all rows for an empty target.

    The watermark is one value on the driver, so that it is a literal in the
    scan's filters (row groups and partitions are pruned).
    """
    at = watermark_of(target, target_col or col).first()[0]
    return df if at is None else df.filter(F.col(col) > F.lit(at))


def new_rows(batch: DataFrame, target: DataFrame, key, since=None, since_col: str | None = None,
             target_key=None, null_safe: bool = False) -> DataFrame:
    """Batch rows whose key is absent from the target.

    ``since`` limits the target to recent rows (partition-prunable filter).
    Duplicates inside the batch are kept; an empty batch gives an empty
    result; NULL keys are kept (they match nothing), or with ``null_safe``
    match the target's NULL keys, so that a replay adds nothing twice.
    """
    if since is not None:
        target = target.filter(F.col(since_col) >= F.lit(since))
    return anti(batch, target, key, right_on=target_key, null_safe=null_safe)


def new_in_partitions(batch: DataFrame, target: DataFrame, key, partition_by: str, null_safe: bool = False) -> DataFrame:
    """G6/G8 against a target partitioned by a column that belongs to the key:
    only the partitions that the batch has rows of are read.

    Their values, one per partition, are literals in the target's filter (the
    NULL partition is one), so what a load looks at follows its batch and not
    the table's history.
    """
    from carelake.sinks.tables import in_values
    keys = [*([key] if isinstance(key, str) else key), partition_by]
    held = [r[0] for r in batch.select(partition_by).distinct().collect()]  # a row a partition
    return anti(batch, target.filter(in_values(partition_by, held)), keys, null_safe=null_safe)


def new_ids(batch: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None) -> DataFrame:
    """As new_rows with both keys compared as strings."""
    ik = ids_key or key
    b = batch.withColumn("__sk", F.col(key).cast("string"))
    i = ids.select(F.col(ik).cast("string").alias("__sk"))
    return b.join(i, "__sk", "left_anti").drop("__sk")


def fallback_period(df: DataFrame, period_col: str, on: dt.date) -> DataFrame:
    """Rows of the latest period <= ``on``, relabelled with ``on``
    (reuse last month's population when this month has none). The period is one
    value on the driver, so that it is a literal in the scan's filters."""
    latest = df.filter(F.col(period_col) <= F.lit(on)).agg(F.max(period_col)).first()[0]
    rows = df.filter(F.lit(False)) if latest is None else df.filter(F.col(period_col) == F.lit(latest))
    return rows.withColumn(period_col, F.lit(on))


def mark_new_vs_previous(current: DataFrame, previous: DataFrame, key: str, name: str = "nuevo") -> DataFrame:
    """``'SI'`` when the key was not on the previous roster."""
    from carelake.plans.population import mark_new
    return mark_new(current, previous, key, name)
