"""Tolerant type coercion.

The source data arrives as text from files, sheets and operational views.
Every coercion is total: a value that cannot be parsed becomes NULL (or the
stated default) instead of failing the job, which matters under ANSI mode
where a plain ``cast`` raises.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions._col import as_col

__all__ = [
    "NULL_WORDS", "to_double", "coerce_float", "coerce_int", "int_if_digits",
    "coerce_ts", "coerce_date", "locale_number", "percent", "strip_dot_zero",
    "null_literals", "clamp_censored", "to_utc", "bad_value",
]

# The words that stand for a missing value in exported text.
NULL_WORDS = ("nan", "none", "null", "nul", "nat", "")


def to_double(c) -> Column:
    """Text or number -> double; unparsable, NaN and infinities -> NULL.

    Blank text and text that begins with a letter is not cast (a failed
    ``try_cast`` costs an exception): digits, signs, the point and blanks all
    sort before a colon. Of numbers in words only booleans have a value."""
    s, d = as_col(c).cast("string"), as_col(c).try_cast("double")
    looks = ((s != "") & (s < ":")) | s.isin("true", "false")
    return F.when(looks, F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d))


def coerce_float(c, default: float | None = 0.0) -> Column:
    """X3 float: coerce, missing -> ``default`` (0.0 like the source jobs)."""
    d = to_double(c)
    return d if default is None else F.coalesce(d, F.lit(float(default)))


def coerce_int(c, default: int | None = 0) -> Column:
    """X3 integer: coerce through decimal(38,9), missing -> default, truncate toward 0.

    ``'2.9'`` -> 2, ``'-2.9'`` -> -2, ``' 7 '`` -> 7, ``'x'``/NULL/``'nan'`` -> 0.
    Every bigint keeps its value (a double would corrupt ids above 2**53).
    Only text that looks like a number is cast: a failed ``try_cast`` costs an
    exception. Other types than text are cast as they are.
    """
    s = as_col(c).cast("string")
    d = as_col(c).try_cast("decimal(38,9)")
    whole = F.when(d < 0, F.ceil(d)).otherwise(F.floor(d)).try_cast("bigint")
    i = F.when(s.rlike(r"^\s*[+-]?[0-9]{1,18}\s*$"), as_col(c).try_cast("bigint")).when(
        s.rlike(r"[0-9]") | s.isin("true", "false"), whole)
    return i if default is None else F.coalesce(i, F.lit(int(default)).cast("bigint"))


def int_if_digits(c) -> Column:
    """The integer when the text is only digits, else NULL."""
    s = F.trim(as_col(c).cast("string"))
    return F.when(s.rlike(r"^[0-9]+$"), s.try_cast("bigint"))


def _shape(fmt: str) -> str:
    """Regex of the text shape a datetime pattern accepts (digits per letter run)."""
    out, i = [], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch.isalpha():
            if ch not in "yMdHhmsS":
                out.append(r"\S+")
            elif run == 1:
                out.append(r"\d{1,2}" if ch != "y" else r"\d+")
            else:
                out.append(r"\d{%d}" % run)
        else:
            out.append(re.escape(fmt[i:j]))
        i = j
    return "^" + "".join(out) + "$"


def coerce_ts(c, *fmts: str) -> Column:
    """First format that parses wins; none parses -> NULL.

    With no format the ISO forms are tried (``yyyy-MM-dd[ HH:mm:ss]``). Each
    attempt is guarded by a cheap shape test so that only plausible text
    reaches the parser (a failed parse is the expensive path).
    """
    fmts = fmts or ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
    s = F.trim(as_col(c).cast("string"))
    return F.coalesce(*[F.when(s.rlike(_shape(f)), F.try_to_timestamp(s, F.lit(f))) for f in fmts])


def coerce_date(c, *fmts: str) -> Column:
    return coerce_ts(c, *fmts).cast("date")


def locale_number(c, as_int: bool = False) -> Column:
    """``'1.234,5'`` -> 1234.5 (``.`` thousands, ``,`` decimals); bad -> 0."""
    s = F.translate(F.translate(as_col(c).cast("string"), ".", ""), ",", ".")
    return coerce_int(s) if as_int else coerce_float(s)


def percent(c, blank: str = "zero") -> Column:
    """``'85,5%'`` -> 0.855.

    ``blank='zero'`` maps an empty cell to 0 (X6); ``blank='null'`` keeps it
    NULL (X7). Unparsable text is NULL in both modes; count it with
    :func:`bad_value`.
    """
    s = F.trim(F.translate(F.translate(as_col(c).cast("string"), "%", ""), ",", "."))
    v = to_double(s) / F.lit(100.0)
    if blank == "zero":
        return F.when(s == "", F.lit(0.0)).otherwise(v)
    return F.when(s == "", F.lit(None).cast("double")).otherwise(v)


def bad_value(raw, parsed) -> Column:
    """1 when a non-blank raw cell failed to parse, else 0 (sum it for X7)."""
    r = as_col(raw)
    return F.when(r.isNotNull() & (F.trim(r.cast("string")) != "") & as_col(parsed).isNull(), 1).otherwise(0)


def strip_dot_zero(c) -> Column:
    """Drop one trailing ``.0`` (``'12.0'`` -> ``'12'``, ``'10.05'`` kept)."""
    return F.regexp_replace(as_col(c).cast("string"), r"\.0$", "")


def null_literals(c, replacement: str | None = None, words=NULL_WORDS) -> Column:
    """Map null words (case-insensitive, trimmed) and NULL to ``replacement``."""
    s = as_col(c).cast("string")
    return F.when(s.isNull() | F.lower(F.trim(s)).isin(*words), F.lit(replacement)).otherwise(s)


def clamp_censored(c) -> Column:
    """X11: ``'>18.50'`` -> 18.5, ``'<0.5'`` -> 0.5; other text -> NULL."""
    return to_double(F.regexp_replace(F.trim(as_col(c).cast("string")), r"^[<>]=?\s*", ""))


def to_utc(c, source_tz: str | None = None) -> Column:
    """Naive values are read as ``source_tz`` (UTC when None) and
    returned as a UTC wall-clock ``timestamp_ntz``."""
    col = as_col(c)
    if source_tz is None:
        return col.cast("timestamp_ntz")
    return F.convert_timezone(F.lit(source_tz), F.lit("UTC"), col.cast("timestamp_ntz"))
