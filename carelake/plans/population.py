"""Population cohorts.

``STANDARD_COHORTS`` is the 45-cohort monthly population table: 3 totals,
8 age bands x (F, M, all), 12 all-sex bands and 6 women-only bands, all on
completed years of age. Bounds are inclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.dates import age_months, age_years
from carelake.operators.aggregate import Cohort, cohort_counts

# The age bands of the monthly population table (years, inclusive).
_SEX_BANDS = [
    ("lt1", "lt", 1, None), ("1_4", "between", 1, 4), ("lt5", "lt", 5, None),
    ("5_14", "between", 5, 14), ("6_19", "between", 6, 19), ("15_44", "between", 15, 44),
    ("45_59", "between", 45, 59), ("ge60", "ge", 60, None),
]
_ALL_BANDS = [
    ("12_17", "between", 12, 17), ("18_28", "between", 18, 28), ("29_59", "between", 29, 59),
    ("ge18", "ge", 18, None), ("6_10", "between", 6, 10), ("18_85", "between", 18, 85),
    ("ge40", "ge", 40, None), ("lt18", "lt", 18, None), ("le40", "le", 40, None),
    ("le2", "le", 2, None), ("lt16", "lt", 16, None), ("gt64", "gt", 64, None),
]
_WOMEN_BANDS = [
    ("15_19", "between", 15, 19), ("15_49", "between", 15, 49), ("10_49", "between", 10, 49),
    ("10_14", "between", 10, 14), ("14_49", "between", 14, 49), ("ge18", "ge", 18, None),
]

NETWORK_LABEL = "NETWORK TOTAL"


def _standard() -> list[Cohort]:
    out = [Cohort("total"), Cohort("total_f", sex="F"), Cohort("total_m", sex="M")]
    for tag, kind, a, b in _SEX_BANDS:
        out.append(Cohort(f"f_{tag}", kind, a, b, "F"))
        out.append(Cohort(f"m_{tag}", kind, a, b, "M"))
        out.append(Cohort(f"all_{tag}", kind, a, b))
    out += [Cohort(f"all_{tag}", kind, a, b) for tag, kind, a, b in _ALL_BANDS]
    out += [Cohort(f"women_{tag}", kind, a, b, "F") for tag, kind, a, b in _WOMEN_BANDS]
    return out


STANDARD_COHORTS: list[Cohort] = _standard()
assert len(STANDARD_COHORTS) == 45


def with_ages(roll: DataFrame, born: str, on) -> DataFrame:
    """Add ``age`` (years, X18) and ``age_m`` (months, X19) at the run date."""
    return roll.withColumns({"age": age_years(born, on), "age_m": age_months(born, on)})


def population_cohorts(roll: DataFrame, site: str, cohorts=None, period: str | None = None,
                       label: str = NETWORK_LABEL, strict: bool = False) -> DataFrame:
    """Cohort counts per site (and period) plus the network-total row.

    ``roll`` needs ``age`` and ``sex``; one scan and one aggregation.
    """
    keys = ([period] if period else []) + [site]
    return cohort_counts(roll, keys, cohorts or STANDARD_COHORTS, strict=strict,
                         total_label=label, label_col=site)


def cohort_sql(cohorts, age: str = "age", sex: str = "sex") -> str:
    """``count_if`` select-list for SQL plans and oracles."""
    return ",\n  ".join(f"CAST(count_if{c.sql(age, sex)} AS BIGINT) AS {c.name}" for c in cohorts)


def new_affiliates(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Rows of the current roll whose key is absent from the previous."""
    return current.join(previous.select(key).distinct(), key, "left_anti")


def mark_new(current: DataFrame, previous: DataFrame, key: str, name: str = "nuevo",
             yes: str = "SI", no: str = "NO") -> DataFrame:
    """``'SI'`` for keys missing from the previous roll, else ``'NO'``."""
    prev = previous.select(F.col(key).alias("__k")).distinct().withColumn("__hit", F.lit(1))
    return (current.join(prev, current[key] == prev["__k"], "left")
            .withColumn(name, F.when(F.col("__hit").isNull(), yes).otherwise(no))
            .drop("__k", "__hit"))
