"""Per-entity sequence logic (W1-W6) that a hot key doesn't stall.

Whole-row picks are ``row_number() = 1``: Spark plans a WindowGroupLimit on
the map side as well, so each task sends one candidate row per key to the
shuffle. Narrow picks (a value or two) are ``min_by``/``max_by`` aggregates,
and partition totals an aggregate and a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions._col import as_col
from carelake.functions.dates import day_span

__all__ = ["last_per", "first_per", "dedupe", "first_last", "partition_total", "latest_scaled"]


def _pick(df: DataFrame, key, order, last: bool) -> DataFrame:
    """The first row of each key; a NULL in the order ranks behind any value."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [as_col(o) for o in ([order] if isinstance(order, (str, Column)) else order)]
    by = [o.desc_nulls_last() if last else o.asc_nulls_last() for o in order]
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def last_per(df: DataFrame, key, order) -> DataFrame:
    """The whole row with the greatest ``order`` per key.

    Give a unique tiebreak as the last order column to make the pick
    deterministic.
    """
    return _pick(df, key, order, last=True)


def first_per(df: DataFrame, key, order) -> DataFrame:
    return _pick(df, key, order, last=False)


def dedupe(df: DataFrame, subset=None, keep: str = "first", order=None) -> DataFrame:
    """One row per ``subset``, first or last by an explicit order.

    Without ``order`` only identical duplicates may be collapsed
    (``distinct`` / ``dropDuplicates`` on the whole row).
    """
    if order is None:
        if subset is not None and set(subset) != set(df.columns):
            raise ValueError("dedupe on a subset needs an explicit order")
        return df.distinct()
    return (first_per if keep == "first" else last_per)(df, subset, order)


def first_last(df: DataFrame, key, ts: str, value: str, tiebreak: str | None = None) -> DataFrame:
    """Per key the first and last value and date, the day span, the
    change (first - last) and the number of rows, in one aggregate. Rows
    without a date count, but are neither first nor last."""
    keys = [key] if isinstance(key, str) else list(key)
    order = F.when(F.col(ts).isNotNull(), F.struct(F.col(ts), F.col(tiebreak))) if tiebreak else F.col(ts)
    g = df.groupBy(*keys).agg(
        F.min_by(F.struct(F.col(ts).alias("d"), F.col(value).alias("v")), order).alias("__f"),
        F.max_by(F.struct(F.col(ts).alias("d"), F.col(value).alias("v")), order).alias("__l"),
        F.count(F.lit(1)).alias("n_results"),
    )
    return g.select(
        *keys,
        F.col("__f.v").alias("first_value"), F.col("__f.d").alias("first_date"),
        F.col("__l.v").alias("last_value"), F.col("__l.d").alias("last_date"),
        day_span("__f.d", "__l.d").alias("span_days"),
        (F.col("__f.v") - F.col("__l.v")).alias("drop"),
        "n_results",
    )


def partition_total(df: DataFrame, part, value: str, name: str = "partition_total") -> DataFrame:
    """``SUM(value) OVER (PARTITION BY part)`` as aggregate + join.

    The aggregate has one row per partition key and is computed with partial
    combining; its join back is planned by AQE (broadcast when the measured
    size is small, otherwise a skew-split shuffle join). A hot partition key
    never lands in a single window task. The NULL partition has its sum, too.
    """
    parts = [part] if isinstance(part, str) else list(part)
    tot = df.groupBy(*[F.col(p).alias(f"__p_{p}") for p in parts]).agg(F.sum(value).alias(name))
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__p_{p}")) for p in parts])
    return df.join(tot, same, "left").drop(*[f"__p_{p}" for p in parts])


def latest_scaled(df: DataFrame, order: str, value: str, factor: float, name: str) -> DataFrame:
    """The most recent value times ``factor``, truncated to an integer (one row)."""
    return df.agg(F.max_by(F.col(value), F.col(order)).alias("__v")).select(
        (F.col("__v") * F.lit(factor)).try_cast("bigint").alias(name))
