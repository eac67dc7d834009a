"""Row filters (F1-F20) that are more than a one-line ``filter``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions._col import as_col
from carelake.functions.text import blank

__all__ = [
    "drop_blank_rows", "blank_row_counts", "truncate_at_blank", "drop_sentinels", "wide_exclusion", "like_any",
    "latest_period", "either_equals", "drop_footer", "since_coerced", "not_equal_keep_null",
]

# Identifier placeholders that mean "no identifier".
ID_SENTINELS = ("", "0", "00", "000", "noencontrado")


def drop_blank_rows(df: DataFrame, cols) -> DataFrame:
    """drop rows where every listed column is NULL or blank."""
    return df.filter(~reduce(lambda a, b: a & b, [blank(c) for c in cols]))


def blank_row_counts(df: DataFrame, cols, by=None) -> DataFrame:
    """``kept`` and ``removed`` rows of drop_blank_rows, per ``by`` group; one pass."""
    gone = reduce(lambda a, b: a & b, [blank(c) for c in cols])
    keys = [by] if isinstance(by, str) else list(by or [])
    return df.groupBy(*keys).agg(F.count_if(~gone).alias("kept"), F.count_if(gone).alias("removed"))


def truncate_at_blank(df: DataFrame, cols, order: str, by=None) -> DataFrame:
    """keep the rows before the first all-blank row (per ``by`` group).

    The first blank position per group is a grouped ``min`` (one row per
    group; without groups exactly one row, joined by broadcast).
    """
    is_blank = reduce(lambda a, b: a & b, [blank(c) for c in cols])
    keys = [by] if isinstance(by, str) else list(by or [])
    cut = df.filter(is_blank).groupBy(*keys).agg(F.min(order).alias("__cut"))
    if keys:
        j = df.join(cut, keys, "left")
    else:
        j = df.crossJoin(F.broadcast(cut))
    return j.filter(F.col("__cut").isNull() | (F.col(order) < F.col("__cut"))).drop("__cut")


def drop_sentinels(df: DataFrame, col: str, values=ID_SENTINELS) -> DataFrame:
    """drop NULL ids and placeholder values (compared trimmed)."""
    c = F.col(col)
    return df.filter(c.isNotNull() & ~F.trim(c.cast("string")).isin(*values))


def wide_exclusion(df: DataFrame, flags, when: Column | None = None) -> DataFrame:
    """F16: drop rows (optionally only those meeting ``when``) whose every
    flag is 0. NULL flags count as not-0, so those rows are kept."""
    all_zero = reduce(lambda a, b: a & b, [F.col(f) == 0 for f in flags])
    cond = all_zero if when is None else (when & all_zero)
    return df.filter(~F.coalesce(cond, F.lit(False)))


def like_any(df: DataFrame, col: str, patterns) -> DataFrame:
    """``col LIKE '%p1%' OR ...`` (patterns given without wildcards)."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(col).contains(p) for p in patterns]))


def latest_period(df: DataFrame, col: str) -> DataFrame:
    """rows of the latest period (none when every period is NULL).

    The period is one value on the driver: as a literal it reaches the scan's
    filters, so only its partitions or row groups are read.
    """
    top = df.agg(F.max(col)).first()[0]
    return df.filter(F.col(col) == F.lit(top)) if top is not None else df.filter(F.lit(False))


def either_equals(df: DataFrame, cols, value) -> DataFrame:
    """value found in any of several columns (``Rol`` or ``Rol 2``)."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c) == F.lit(value) for c in cols]))


def drop_footer(df: DataFrame, n: int, file_col: str, pos_col: str) -> DataFrame:
    """Drop the last ``n`` rows of every file (needs a position column)."""
    last = df.groupBy(file_col).agg(F.max(pos_col).alias("__last"))
    return (df.join(last, file_col, "left")
            .filter(F.col(pos_col) <= F.col("__last") - F.lit(n)).drop("__last"))


def since_coerced(df: DataFrame, parsed: Column, lo) -> DataFrame:
    """lower bound on a tolerant date parse; unparsable rows drop out."""
    return df.filter(parsed >= F.lit(lo))


def not_equal_keep_null(c, value) -> Column:
    """F18 with pandas semantics: ``!=`` keeps NULLs (SQL ``<>`` drops them)."""
    col = as_col(c)
    return col.isNull() | (col != F.lit(value))
