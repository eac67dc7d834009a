"""Chronic-disease panel rules.

HbA1c compensation (D12): a patient is compensated when the last result is
<= 7.0 below age 65 or <= 8.0 from 65 on; otherwise, with more than one
result spanning at least 335 days, when the fall from the first to the last
result reaches the tier of the first value (> 10: 2.0; 8..10: 1.0;
< 8: 0.5). Results are compared in hundredths so that float noise cannot
move a boundary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.sequence import first_last

# Compensation thresholds.
AGE_CUT = 65
LAST_MAX_YOUNG = 7.0
LAST_MAX_OLD = 8.0
MIN_SPAN_DAYS = 335
TIERS = ((10.0, 2.0), (8.0, 1.0), (None, 0.5))  # (first value above/at, required fall)


def _hund(c: Column) -> Column:
    return F.round(c * 100)


def improved(first: str = "first_value", last: str = "last_value", n: str = "n_results",
             span: str = "span_days", min_span: int = MIN_SPAN_DAYS) -> Column:
    """1 when the first->last fall meets the tier of the first value."""
    f, fall = F.col(first), _hund(F.col(first) - F.col(last))
    tier = (F.when(f > 10, fall >= 200)
            .when((f >= 8) & (f <= 10), fall >= 100)
            .when(f < 8, fall >= 50))
    ok = (F.col(n) > 1) & (F.col(span) >= min_span) & F.coalesce(tier, F.lit(False))
    return F.when(ok, 1).otherwise(0)


def last_result_ok(age: Column, last: Column) -> Column:
    """1 when the last result is within the age-specific limit."""
    young = (age < AGE_CUT) & (_hund(last) <= LAST_MAX_YOUNG * 100)
    old = (age >= AGE_CUT) & (_hund(last) <= LAST_MAX_OLD * 100)
    return F.coalesce(young | old, F.lit(False))


def compensation(results: DataFrame, ages: DataFrame, key: str = "patient", ts: str = "result_date",
                 value: str = "result", tiebreak: str = "result_id") -> DataFrame:
    """Per patient: first/last summary, age, and ``compensated`` 0/1.

    One aggregate over the results (min_by/max_by, skew-safe), then one join
    with the ages (an inner join: patients need an age).
    """
    fl = first_last(results, key, ts, value, tiebreak=tiebreak)
    j = fl.join(ages, key, "inner")
    return j.withColumn("compensated",
                        F.when(last_result_ok(F.col("age"), F.col("last_value")), 1).otherwise(improved()))
