"""Projection and schema shaping (P1-P8, P13-P17) and the table spec.

Each operator is one projection on the plan, so Catalyst prunes the unused
source columns at the scan.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions import coerce as C
from carelake.functions._col import as_col

__all__ = [
    "select_required", "rename", "rename_positional", "rename_checked", "add_missing",
    "drop_cols", "drop_incomplete", "insert_at", "with_literal", "cast_groups", "cast_all_but",
    "split_key", "broadcast_scalar", "TableSpec", "apply_spec", "conform",
]


def select_required(df: DataFrame, cols, present_only: bool = False) -> DataFrame:
    """Ordered subset (``present_only`` skips absent names)."""
    cols = [c for c in cols if c in df.columns] if present_only else list(cols)
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename by name; names absent from ``df`` are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def rename_positional(df: DataFrame, names) -> DataFrame:
    """Rename the first ``min(n, m)`` columns, keep the rest, warn on a
    count mismatch."""
    names = list(names)
    if len(names) != len(df.columns):
        warnings.warn(f"expected {len(names)} columns, found {len(df.columns)}")
    k = min(len(names), len(df.columns))
    return df.toDF(*(names[:k] + df.columns[k:]))


def rename_checked(df: DataFrame, mapping: dict) -> tuple[DataFrame, list[str]]:
    """Rename, keep only mapped columns; also return the missing sources."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        warnings.warn(f"missing columns: {missing}")
    return df.select(*[F.col(k).alias(v) for k, v in mapping.items() if k in df.columns]), missing


def add_missing(df: DataFrame, cols, default=0) -> DataFrame:
    """P5: create absent columns with a default."""
    return df.withColumns({c: F.lit(default) for c in cols if c not in df.columns})


def drop_cols(df: DataFrame, cols) -> DataFrame:
    """Drop, absent names tolerated."""
    return df.drop(*cols)


def drop_incomplete(df: DataFrame, keep=()) -> DataFrame:
    """Drop every column that has a missing value (``keep`` excepted).

    One aggregate finds them; only one row of flags reaches the driver. An
    empty table keeps all columns.
    """
    cols = [c for c in df.columns if c not in keep]
    has = df.agg(*[F.coalesce(F.max(F.col(c).isNull()), F.lit(False)).alias(c) for c in cols]).first()
    return df.drop(*[c for c in cols if has[c]])


def insert_at(df: DataFrame, pos: int, name: str, expr) -> DataFrame:
    """A derived column at a given position."""
    cols = [c for c in df.columns if c != name]
    return df.select(*cols[:pos], as_col(expr).alias(name), *cols[pos:])


def with_literal(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    """Constant column (run date, default flag...)."""
    v = F.lit(value)
    return df.withColumn(name, v.cast(dtype) if dtype else v)


def cast_groups(df: DataFrame, strings=(), dates=(), ints=(), floats=(), timestamps=(),
                date_formats=("yyyy-MM-dd",)) -> DataFrame:
    """List-driven tolerant casts on the columns that are present, one select."""
    plan = {}
    for c in strings:
        plan[c] = F.col(c).cast("string")
    for c in ints:
        plan[c] = C.coerce_int(c)
    for c in floats:
        plan[c] = C.coerce_float(c)
    for c in dates:
        plan[c] = C.coerce_date(c, *date_formats)
    for c in timestamps:
        plan[c] = C.coerce_ts(c, *date_formats)
    return df.select(*[plan[c].alias(c) if c in plan else F.col(c) for c in df.columns])


def cast_all_but(df: DataFrame, exceptions=()) -> DataFrame:
    """Every column not listed becomes a string."""
    return df.select(*[F.col(c) if c in exceptions else F.col(c).cast("string").alias(c)
                       for c in df.columns])


def split_key(df: DataFrame, col: str, sep: str, parts: dict) -> DataFrame:
    """Split a composed key into named parts (index -> name).

    Negative indexes count from the end; a missing part is NULL (no error).
    """
    arr = F.split(F.col(col), sep)
    return df.withColumns({name: F.try_element_at(arr, F.lit(i + 1 if i >= 0 else i))
                           for i, name in parts.items()})


def broadcast_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row frame on every row.

    The right side is an aggregate without grouping keys: exactly one row,
    so broadcasting it is size-bounded.
    """
    return df.crossJoin(F.broadcast(one_row))


@dataclass
class TableSpec:
    """Ordered target schema + rename map + defaults for absent columns."""

    schema: T.StructType
    renames: dict = field(default_factory=dict)
    defaults: dict = field(default_factory=dict)
    date_formats: tuple = ("yyyy-MM-dd",)


def _coerce_to(c: Column, dtype: T.DataType, fmts) -> Column:
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        return C.coerce_int(c, default=None).cast(dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return C.to_double(c).cast(dtype)
    if isinstance(dtype, T.DecimalType):
        return c.try_cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.coalesce(c.try_cast("date"), C.coerce_date(c, *fmts))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(c.try_cast(dtype), C.coerce_ts(c, *fmts).cast(dtype))
    return c.cast(dtype)


def apply_spec(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rename, coerce each column to the spec type, create absent
    ones from defaults (or NULL); output exactly the spec, in its order."""
    df = rename(df, spec.renames)
    out = []
    for f in spec.schema.fields:
        if f.name in df.columns:
            src = F.col(f.name)
            same = df.schema[f.name].dataType == f.dataType
            out.append((src if same else _coerce_to(src, f.dataType, spec.date_formats)).alias(f.name))
        else:
            out.append(F.lit(spec.defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*out)


def conformed(c: Column, have: T.DataType, want: T.DataType, date_formats=("yyyy-MM-dd",)) -> Column:
    """One column in the target's type; text that can't be converted is NULL."""
    return c if have == want else _coerce_to(c, want, date_formats)


def conform(df: DataFrame, schema: T.StructType, date_formats=("yyyy-MM-dd",)) -> DataFrame:
    """Explicit types on write, in the target's order (tolerant casts:
    one bad cell is NULL and doesn't fail the load)."""
    return df.select(*[conformed(F.col(f.name), df.schema[f.name].dataType, f.dataType, date_formats).alias(f.name)
                       for f in schema.fields])


#: Whole numbers from narrow to wide, then decimals; a column that comes in several kinds takes the widest.
_WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DecimalType(38, 9)]


def widest(kinds) -> T.DataType:
    """The type that holds, without loss, what every one of ``kinds`` holds.

    Void gives way; dates and timestamps make a timestamp; a double holds
    whole numbers of 32 bits; all else that differs is text.
    """
    kinds = [k for k in kinds if not isinstance(k, T.NullType)]
    if not kinds:
        return T.StringType()
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    number = [_WIDER[-1] if isinstance(k, T.DecimalType) and k.scale <= 9 and k.precision - k.scale <= 29 else
              T.DoubleType() if isinstance(k, T.FloatType) else k for k in kinds]
    if all(k in _WIDER for k in number):
        return max(number, key=_WIDER.index)
    if all(k == T.DoubleType() or k in _WIDER[:3] for k in number):
        return T.DoubleType()
    if all(isinstance(k, (T.DateType, T.TimestampNTZType)) for k in kinds):
        return T.TimestampNTZType()
    return T.StringType()


def reconciled(schemas, overrides: dict | None = None) -> T.StructType:
    """One schema for several: every column that any has, in order of first appearance, with the widest of its types.

    Names are compared without case and surrounding blanks. ``overrides``
    (name -> type) decides for a column, as the string override of a sheet's code column does.
    """
    found: dict[str, list[T.DataType]] = {}
    names: dict[str, str] = {}
    for s in schemas:
        for f in s.fields:
            k = f.name.strip().lower()
            names.setdefault(k, f.name.strip())
            found.setdefault(k, []).append(f.dataType)
    forced = {k.strip().lower(): v for k, v in (overrides or {}).items()}
    return T.StructType([T.StructField(names[k], forced.get(k) or widest(v)) for k, v in found.items()])


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in a reconciled schema: columns by name, absent ones NULL, others cast (wider types only, so nothing is lost)."""
    have = {c.strip().lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def datetime_text(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """K7: every date and timestamp column as text of one format (NULL stays NULL)."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(*[F.date_format(f.name, fmt).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name) for f in df.schema.fields])
