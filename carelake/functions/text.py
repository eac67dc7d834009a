"""Text cleanup expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions._col import as_col

__all__ = [
    "digits_only", "strip_letters", "strip_unit", "accent_fold", "time_of_day",
    "first_dash_number", "concat_nullsafe", "trim_concat", "blank",
    "drop_days", "from_char", "capitalize",
]

# Accented capitals folded by the source jobs, and their plain forms.
ACCENTED_UPPER = "ÁÉÍÓÚÑ"
PLAIN_UPPER = "AEIOUN"
ACCENTED_LOWER = "áéíóúñ"
PLAIN_LOWER = "aeioun"


def digits_only(c) -> Column:
    """Remove every non-digit."""
    return F.regexp_replace(as_col(c).cast("string"), r"[^0-9]", "")


def strip_letters(c) -> Column:
    """Remove ASCII letters."""
    return F.regexp_replace(as_col(c).cast("string"), r"[a-zA-Z]", "")


def strip_unit(c, unit: str) -> Column:
    """Remove a unit word (e.g. ``'45 Años'`` -> ``'45'``) and trim."""
    return F.trim(F.replace(as_col(c).cast("string"), F.lit(unit), F.lit("")))


def accent_fold(c, lower_too: bool = False) -> Column:
    """Fold Á É Í Ó Ú Ñ (and optionally the lower-case forms)."""
    src, dst = ACCENTED_UPPER, PLAIN_UPPER
    if lower_too:
        src, dst = src + ACCENTED_LOWER, dst + PLAIN_LOWER
    return F.translate(as_col(c), src, dst)


def time_of_day(c) -> Column:
    """``'0 days 08:30:00'`` -> ``'08:30:00'`` (last space-separated token)."""
    return F.element_at(F.split(F.trim(as_col(c).cast("string")), " "), -1)


def drop_days(c) -> Column:
    """``'2 days'`` / ``'2 days 08:30:00'`` with the day words removed and trimmed."""
    return F.trim(F.regexp_replace(as_col(c).cast("string"), r"\bdays?\b", ""))


def from_char(c, n: int) -> Column:
    """The text without its first ``n`` characters (a fixed-width prefix)."""
    return F.substring(as_col(c).cast("string"), n + 1, 2**31 - 1)


def capitalize(c) -> Column:
    """First character upper, the rest lower."""
    s = as_col(c).cast("string")
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 2**31 - 1)))


def first_dash_number(c) -> Column:
    """Digits of the first ``-digits`` group, NULL when absent."""
    v = F.regexp_extract(as_col(c).cast("string"), r"-([0-9]+)", 1)
    return F.when(v != "", v)


def concat_nullsafe(*cols, sep: str = " ") -> Column:
    """``concat(ifnull(a,''), sep, ifnull(b,''))``: a NULL part is empty."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(as_col(c).cast("string"), F.lit("")))
    return F.concat(*parts)


def trim_concat(*cols, sep: str = "") -> Column:
    """``ltrim(rtrim(concat(...)))`` (NULL when any part is NULL)."""
    parts = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(as_col(c).cast("string"))
    return F.trim(F.concat(*parts))


def blank(c) -> Column:
    """True when NULL or empty after trimming."""
    col = as_col(c)
    return col.isNull() | (F.trim(col.cast("string")) == "")
