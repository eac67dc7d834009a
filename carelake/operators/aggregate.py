"""Aggregation operators.

The source jobs build dozens of filter+group frames and inner-join them back
together (one scan and one shuffle per cohort). Here every cohort is a
conditional count inside ONE ``groupBy`` (A8): one scan, one shuffle with
map-side partial aggregation, so a hot site cannot overload a reducer.
Totals use grouping sets in the same pass (A4/A5).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions._col import as_col

__all__ = [
    "Cohort", "cohort", "cohort_counts", "grouped_with_total", "with_total_row",
    "pivot_count", "ratio", "conditional_sums", "count_distinct_pairs",
    "indicator_sum", "all_of",
]

_OPS = {"eq": "=", "gt": ">", "ge": ">=", "lt": "<", "le": "<="}


@dataclass(frozen=True)
class Cohort:
    """A declarative age/sex cohort: ``kind`` in all/between/eq/gt/ge/lt/le."""

    name: str
    kind: str = "all"
    a: int | None = None
    b: int | None = None
    sex: str | None = None

    def predicate(self, age: Column, sex: Column) -> Column:
        if self.kind == "all":
            p = F.lit(True)
        elif self.kind == "between":
            p = (age >= F.lit(self.a)) & (age <= F.lit(self.b))
        elif self.kind == "eq":
            p = age == F.lit(self.a)
        elif self.kind == "gt":
            p = age > F.lit(self.a)
        elif self.kind == "ge":
            p = age >= F.lit(self.a)
        elif self.kind == "lt":
            p = age < F.lit(self.a)
        elif self.kind == "le":
            p = age <= F.lit(self.a)
        else:
            raise ValueError(f"unknown cohort kind {self.kind!r}")
        return p & (sex == F.lit(self.sex)) if self.sex is not None else p

    def sql(self, age: str, sex: str) -> str:
        """The same predicate as SQL text (used by oracles and SQL plans)."""
        if self.kind == "all":
            p = "TRUE"
        elif self.kind == "between":
            p = f"{age} BETWEEN {self.a} AND {self.b}"
        else:
            p = f"{age} {_OPS[self.kind]} {self.a}"
        return f"({p} AND {sex} = '{self.sex}')" if self.sex is not None else f"({p})"


def cohort(kind: str, a: int | None = None, b: int | None = None,
           sex: str | None = None, name: str | None = None) -> Cohort:
    """A9 parametric cohort: all six comparison kinds, optional sex."""
    if name is None:
        bounds = "_".join(str(x) for x in (a, b) if x is not None)
        name = "_".join(p for p in ("n", kind, bounds, (sex or "").lower()) if p)
    return Cohort(name, kind, a, b, sex)


def cohort_counts(df: DataFrame, keys, cohorts, age: str = "age", sex: str = "sex",
                  strict: bool = False, total_label: str | None = None,
                  label_col: str | None = None) -> DataFrame:
    """One pass, one conditional count per cohort, per group of ``keys``.

    ``total_label`` adds the network-total row (A5) in the same aggregation
    through grouping sets; ``strict=True`` keeps only groups whose every
    cohort count is > 0 (what chained inner joins of per-cohort frames do);
    the total is over the groups that are kept.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = [F.count_if(c.predicate(as_col(age), as_col(sex))).alias(c.name) for c in cohorts]
    out = df.groupBy(*keys).agg(*aggs)
    if strict:  # before the total: dropped groups are not part of it
        out = out.filter(reduce(lambda x, y: x & y, [F.col(c.name) > 0 for c in cohorts]))
    if total_label is not None:
        # Counts re-aggregate exactly, so the total row is summed from the
        # per-group result (one row per group) instead of expanding every
        # input row for a grouping set; the shuffle is reused, not repeated.
        out = with_total_row(out, keys, [c.name for c in cohorts], total_label, label_col or keys[-1])
    return out


def grouped_with_total(df: DataFrame, keys, aggs, label: str, label_col: str | None = None) -> DataFrame:
    """A4/A5: aggregate per ``keys`` plus a total over ``label_col`` in one pass.

    Grouping sets ``(keys)`` and ``(keys - label_col)``; the total row carries
    ``label`` in ``label_col``. ``grouping()`` (not ``isNull``) tells the total
    apart from a real NULL group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    label_col = label_col or keys[-1]
    outer = [k for k in keys if k != label_col]
    g = df.groupingSets([keys, outer], *keys).agg(*aggs, F.grouping(label_col).alias("__total"))
    names = [c for c in g.columns if c not in ("__total",)]
    return g.select(*[
        (F.when(F.col("__total") == 1, F.lit(label)).otherwise(F.col(c).cast("string")).alias(c)
         if c == label_col else F.col(c)) for c in names
    ])


def with_total_row(agg: DataFrame, keys, sum_cols, label: str, label_col: str) -> DataFrame:
    """A5 for additive measures: append ``sum(col)`` over ``label_col`` (per
    remaining keys) to a frame aggregated by ``keys``, labelled ``label``.

    Each aggregated row counts for its group and for the total, and both are
    summed in one more aggregate of those few rows: the frame is planned once.
    Without remaining keys there is always a total row, of NULLs when ``agg``
    is empty; a group that happens to be called ``label`` stays a group.
    """
    outer = [k for k in keys if k != label_col]
    as_group = F.struct(F.lit(0).alias("total"), F.col(label_col).cast("string").alias("name"))
    as_total = F.struct(F.lit(1).alias("total"), F.lit(label).alias("name"))
    rows = agg.select(*outer, *sum_cols, F.explode(F.array(as_group, as_total)).alias("__row"))
    if not outer:
        nothing = [F.lit(None).cast(agg.schema[c].dataType).alias(c) for c in sum_cols]
        rows = rows.unionByName(agg.sparkSession.range(1, numPartitions=1).select(*nothing, as_total.alias("__row")))
    out = rows.groupBy(*outer, "__row").agg(*[F.sum(c).alias(c) for c in sum_cols])
    return out.withColumn(label_col, F.col("__row.name")).select(*agg.columns)


def pivot_count(df: DataFrame, keys, col: str, values, fill: int = 0,
                name=lambda v: str(v)) -> DataFrame:
    """Count per ``keys`` x listed values of ``col`` (missing combos -> 0).

    Written as conditional counts so the listed values fix the output schema
    and no extra pass is needed to discover them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = [F.count_if(F.col(col) == F.lit(v)).alias(name(v)) for v in values]
    return df.groupBy(*keys).agg(*aggs)


def ratio(df: DataFrame, keys, num: Column, den: Column, name: str = "ratio",
          total_label: str | None = None, digits: int | None = 4) -> DataFrame:
    """``sum(num)/sum(den)`` per group (+ total row); 0 denominators -> NULL."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = [F.sum(num).alias("numerator"), F.sum(den).alias("denominator")]
    g = (grouped_with_total(df, keys, aggs, total_label) if total_label
         else df.groupBy(*keys).agg(*aggs))
    r = F.try_divide(F.col("numerator").cast("double"), F.col("denominator").cast("double"))
    return g.withColumn(name, F.round(r, digits) if digits is not None else r)


def conditional_sums(df: DataFrame, keys, measures: dict, predicates: dict) -> DataFrame:
    """``sum(when(pred, measure))`` for every measure x predicate, one pass.

    ``measures``: name -> Column; ``predicates``: suffix -> Column. The sum of
    nothing is 0 (pandas semantics), not NULL.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = []
    for m, mc in measures.items():
        for p, pc in predicates.items():
            aggs.append(F.coalesce(F.sum(F.when(pc, mc)), F.lit(0)).alias(f"{m}_{p}"))
    return df.groupBy(*keys).agg(*aggs)


def count_distinct_pairs(df: DataFrame, keys, *cols, name: str = "n_distinct") -> DataFrame:
    """A10: distinct-then-count, one aggregate (Spark plans the two-level
    aggregation with partial combining on both levels)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count_distinct(*[as_col(c) for c in cols]).alias(name))


def indicator_sum(pred: Column) -> Column:
    """``sum(when(pred,1) else 0)``; the sum of nothing is 0."""
    return F.coalesce(F.sum(F.when(pred, 1).otherwise(0)), F.lit(0)).cast("bigint")


def all_of(*flags) -> Column:
    """1 iff every flag is 1."""
    return F.when(reduce(lambda x, y: x & y, [as_col(f) == 1 for f in flags]), 1).otherwise(0)


def distinct_with_total(df: DataFrame, key: str, distinct: dict, sums: dict, label: str) -> DataFrame:
    """A10+A5: exact distinct counts and sums per ``key``, and a total row ``label``.

    ``distinct``: name -> whole-number column (NULL is not counted), ``sums``:
    name -> column. Distincts are bitmaps of 32,768 numbers each, which add up
    by OR: rows are aggregated once per (key, bucket) on the map side, and the
    total is made from the keys' bitmaps, so no row is expanded for a second
    distinct or for the total.
    """
    one = F.lit(None).cast("binary")
    each = []
    for name, col in distinct.items():
        c = F.col(col)
        part = df.filter(c.isNotNull()).groupBy(F.col(key).alias("__key"), F.bitmap_bucket_number(c).alias("__b")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("__bits"))
        each.append(part.select("__key", F.lit(name).alias("__what"), "__b", "__bits"))
    plain = df.groupBy(F.col(key).alias("__key")).agg(*[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()])
    bits = reduce(lambda a, b: a.unionByName(b), each) if each else plain.select(
        "__key", F.lit("").alias("__what"), F.lit(0).cast("bigint").alias("__b"), one.alias("__bits")).filter("false")
    total = bits.groupBy("__what", "__b").agg(F.bitmap_or_agg("__bits").alias("__bits"))
    sized = bits.select("__key", F.lit(False).alias("__total"), "__what", F.bitmap_count("__bits").alias("__n")).unionByName(
        total.select(F.lit(None).cast(df.schema[key].dataType).alias("__key"), F.lit(True).alias("__total"), "__what",
                     F.bitmap_count("__bits").alias("__n")))
    zero = [F.lit(0).cast("bigint").alias(n) for n in sums]
    both = plain.unionByName(plain.groupBy().agg(*[F.sum(n).alias(n) for n in sums]).select(
        F.lit(None).cast(df.schema[key].dataType).alias("__key"), *sums).withColumn("__t", F.lit(True)), allowMissingColumns=True)
    rows = both.select("__key", F.coalesce("__t", F.lit(False)).alias("__total"), F.lit("").alias("__what"), F.lit(0).cast("bigint").alias("__n"), *sums)
    rows = rows.unionByName(sized.select("*", *zero))
    out = rows.groupBy("__key", "__total").agg(
        *[F.sum(n).cast("bigint").alias(n) for n in sums],
        *[F.sum(F.when(F.col("__what") == n, F.col("__n")).otherwise(0)).cast("bigint").alias(n) for n in distinct])
    name = F.when(F.col("__total"), F.lit(label)).otherwise(F.col("__key").cast("string")).alias(key)
    return out.select(name, *sums, *distinct)
