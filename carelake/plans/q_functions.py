"""Registered scalar-function queries.

The driver data has no malformed text, so each query renders text from
numeric columns (through integer arithmetic, so both engines print the same
digits) and corrupts some of it by a rule on the row id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions import coerce as C
from carelake.functions import text as X
from carelake.functions.dates import age_months, age_years, mid_month
from carelake.functions.labels import bins
from carelake.operators.lookup import enrich
from carelake.operators.shape import split_key
from carelake.plans.registry import query


def _case(key: Column, mod: int, branches: dict, default: Column) -> Column:
    expr = None
    for v, out in branches.items():
        expr = F.when(key % mod == v, out) if expr is None else expr.when(key % mod == v, out)
    return expr.otherwise(default)


def _s(c) -> Column:
    return c.cast("string")


def _money_text(c: Column, dec: str = ".") -> Column:
    cents = F.round(c * 100).cast("bigint")
    return F.concat(_s(F.floor(cents / 100).cast("bigint")), F.lit(dec),
                    F.lpad(_s(cents % 100), 2, "0"))


_QTY = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"
_NUM_RAW_SQL = f"""CASE l_linenumber % 7 WHEN 0 THEN {_QTY} WHEN 1 THEN ' ' || {_QTY} || ' '
  WHEN 2 THEN {_QTY} || '.9' WHEN 3 THEN '-' || {_QTY} || '.9' WHEN 4 THEN 'x' WHEN 5 THEN NULL ELSE 'nan' END"""
_DBL_SQL = "CASE WHEN isnan(TRY_CAST(raw AS DOUBLE)) OR isinf(TRY_CAST(raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END"


@query("coerce_numbers", f"""
SELECT l_orderkey, l_linenumber, raw, coalesce(CAST(trunc({_DBL_SQL}) AS BIGINT), 0) AS as_int,
       coalesce({_DBL_SQL}, 0.0) AS as_float
FROM (SELECT l_orderkey, l_linenumber, {_NUM_RAW_SQL} AS raw FROM lineitem) x
""")
def coerce_numbers(t):
    """Tolerant int/float coercion: padded, fractional, negative, junk, NULL, 'nan'."""
    q = _s(F.col("l_quantity").cast("bigint"))
    raw = _case(F.col("l_linenumber"), 7, {
        0: q, 1: F.concat(F.lit(" "), q, F.lit(" ")), 2: F.concat(q, F.lit(".9")),
        3: F.concat(F.lit("-"), q, F.lit(".9")), 4: F.lit("x"), 5: F.lit(None).cast("string")}, F.lit("nan"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return li.withColumns({"as_int": C.coerce_int("raw"), "as_float": C.coerce_float("raw")})


@query("coerce_dates", """
SELECT l_orderkey, l_linenumber, raw,
  CAST(coalesce(try_strptime(raw, '%d/%m/%Y %H:%M:%S'), try_strptime(raw, '%d/%m/%Y'),
                try_strptime(raw, '%Y-%m-%d')) AS DATE) AS parsed
FROM (SELECT l_orderkey, l_linenumber,
        CASE l_linenumber % 4 WHEN 0 THEN strftime(l_shipdate, '%d/%m/%Y')
             WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 2 THEN strftime(l_shipdate, '%d/%m/%Y %H:%M:%S')
             ELSE 'sin fecha' END AS raw FROM lineitem) x
""")
def coerce_dates(t):
    """Multi-format date parse; unparsable -> NULL."""
    d = F.col("l_shipdate")
    raw = _case(F.col("l_linenumber"), 4, {
        0: F.date_format(d, "dd/MM/yyyy"), 1: F.date_format(d, "yyyy-MM-dd"),
        2: F.date_format(d, "dd/MM/yyyy HH:mm:ss")}, F.lit("sin fecha"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return li.withColumn("parsed", C.coerce_date("raw", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "yyyy-MM-dd"))


@query("locale_numbers", """
SELECT l_orderkey, l_linenumber, raw, coalesce(v, 0.0) AS as_float, CAST(trunc(coalesce(v, 0.0)) AS BIGINT) AS as_int
FROM (SELECT *, TRY_CAST(replace(replace(raw, '.', ''), ',', '.') AS DOUBLE) AS v FROM (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber % 5 WHEN 3 THEN 'abc' WHEN 4 THEN ''
      ELSE replace(format('{:,}', CAST(round(l_extendedprice * 100) AS BIGINT) // 100), ',', '.') || ',' ||
           lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') END AS raw
  FROM lineitem) x) y
""")
def locale_numbers(t):
    """X5: '68.423,46' (dot thousands, comma decimals) -> 68423.46; junk -> 0."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    txt = F.concat(F.replace(F.format_number(F.floor(cents / 100).cast("bigint"), 0), F.lit(","), F.lit(".")),
                   F.lit(","), F.lpad(_s(cents % 100), 2, "0"))
    raw = _case(F.col("l_linenumber"), 5, {3: F.lit("abc"), 4: F.lit("")}, txt)
    li = t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return li.withColumns({"as_float": C.locale_number("raw"), "as_int": C.locale_number("raw", as_int=True)})


@query("percent_parse", f"""
SELECT l_orderkey, l_linenumber, raw,
  CASE WHEN s = '' THEN 0.0 ELSE TRY_CAST(s AS DOUBLE) / 100 END AS pct_zero,
  CASE WHEN s = '' THEN NULL ELSE TRY_CAST(s AS DOUBLE) / 100 END AS pct_null,
  CASE WHEN raw IS NOT NULL AND trim(raw) <> '' AND (CASE WHEN s = '' THEN NULL ELSE TRY_CAST(s AS DOUBLE) END) IS NULL
       THEN 1 ELSE 0 END AS bad
FROM (SELECT *, trim(replace(replace(raw, '%', ''), ',', '.')) AS s FROM (
  SELECT l_orderkey, l_linenumber, CASE l_linenumber % 6 WHEN 4 THEN 'n/a' WHEN 5 THEN ''
    ELSE {_QTY} || ',' || CAST(l_linenumber AS VARCHAR) || '%' END AS raw FROM lineitem) x) y
""")
def percent_parse(t):
    """X6/X7: '85,5%' -> 0.855; blank -> 0 or NULL by mode; bad text counted."""
    raw = _case(F.col("l_linenumber"), 6, {4: F.lit("n/a"), 5: F.lit("")},
                F.concat(_s(F.col("l_quantity").cast("bigint")), F.lit(","), _s(F.col("l_linenumber")), F.lit("%")))
    li = t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    li = li.withColumns({"pct_zero": C.percent("raw", "zero"), "pct_null": C.percent("raw", "null")})
    return li.withColumn("bad", C.bad_value("raw", "pct_null"))


@query("strip_suffix", f"""
SELECT l_orderkey, l_linenumber, raw, regexp_replace(raw, '\\.0$', '') AS stripped,
       replace(raw, '.0', '') AS stripped_plain
FROM (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN {_QTY} || '.0'
        WHEN 1 THEN {_QTY} || '.05' ELSE {_QTY} || '.00' END AS raw FROM lineitem) x
""")
def strip_suffix(t):
    """Anchored '.0' removal vs the plain replace-everywhere variant."""
    q = _s(F.col("l_quantity").cast("bigint"))
    raw = _case(F.col("l_linenumber"), 3, {0: F.concat(q, F.lit(".0")), 1: F.concat(q, F.lit(".05"))},
                F.concat(q, F.lit(".00")))
    li = t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return li.withColumns({"stripped": C.strip_dot_zero("raw"),
                           "stripped_plain": F.replace(F.col("raw"), F.lit(".0"), F.lit(""))})


@query("regex_digits", """
SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits,
       regexp_replace(c_name, '[a-zA-Z]', '', 'g') AS no_letters,
       regexp_extract(c_mktsegment || '-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(c_nationkey AS VARCHAR),
                      '-([0-9]+)', 1) AS first_number,
       trim(replace(CAST(c_nationkey AS VARCHAR) || ' Años', 'Años', '')) AS age_text
FROM customer
""")
def regex_digits(t):
    """Digits only, letters removed, first -digits group, unit word stripped."""
    c = t.customer
    composed = F.concat_ws("-", "c_mktsegment", _s(F.col("c_custkey")), _s(F.col("c_nationkey")))
    return c.select("c_custkey", X.digits_only("c_name").alias("digits"),
                    X.strip_letters("c_name").alias("no_letters"),
                    X.first_dash_number(composed).alias("first_number"),
                    X.strip_unit(F.concat(_s(F.col("c_nationkey")), F.lit(" Años")), "Años").alias("age_text"))


@query("accent_fold", """
SELECT doc_id, md5(translate(text, 'ÁÉÍÓÚÑ', 'AEIOUN')) AS folded_md5,
       md5(translate(text, 'ÁÉÍÓÚÑáéíóúñ', 'AEIOUNaeioun')) AS folded_all_md5,
       CAST(length(text) AS BIGINT) AS n_chars
FROM documents
""")
def accent_fold(t):
    """Accent folding over whole document texts (digest of the result)."""
    d = t.documents
    return d.select("doc_id", F.md5(X.accent_fold("text")).alias("folded_md5"),
                    F.md5(X.accent_fold("text", lower_too=True)).alias("folded_all_md5"),
                    F.length("text").cast("bigint").alias("n_chars"))


_ID_SQL = ("'P' || CAST(o_custkey % 97 AS VARCHAR) || '-x-' || CAST(o_custkey AS VARCHAR) || '-' || "
           "strftime(o_orderdate, '%Y-%m-%d') || '-' || CAST(o_orderkey AS VARCHAR)")


@query("split_parts", f"""
SELECT o_orderkey, p[1] AS professional, p[3] AS patient, p[4] || '-' || p[5] || '-' || p[6] AS visit_date,
       p[-1] AS tail, p[9] AS missing
FROM (SELECT o_orderkey, string_split({_ID_SQL}, '-') AS p FROM orders) x
""")
def split_parts(t):
    """Composed id -> professional, patient, rebuilt date; absent part NULL."""
    oid = F.concat(F.lit("P"), _s(F.col("o_custkey") % 97), F.lit("-x-"), _s(F.col("o_custkey")), F.lit("-"),
                   F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), _s(F.col("o_orderkey")))
    o = t.orders.select("o_orderkey", oid.alias("id"))
    o = split_key(o, "id", "-", {0: "professional", 2: "patient", 3: "y", 4: "m", 5: "d", -1: "tail",
                                 8: "missing"})
    return o.select("o_orderkey", "professional", "patient",
                    F.concat_ws("-", "y", "m", "d").alias("visit_date"), "tail", "missing")


_VAL_TXT_SQL = ("CAST(CAST(round(value * 100) AS BIGINT) // 100 AS VARCHAR) || '.' || "
                "lpad(CAST(CAST(round(value * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')")


@query("clamp_censored", f"""
SELECT event_id, raw, TRY_CAST(regexp_replace(trim(raw), '^[<>]=?\\s*', '') AS DOUBLE) AS result
FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '>' || {_VAL_TXT_SQL} WHEN 1 THEN '<=' || {_VAL_TXT_SQL}
        WHEN 2 THEN 'MEMO' ELSE {_VAL_TXT_SQL} END AS raw FROM events) x
""")
def clamp_censored(t):
    """X11: censored results ('>18.50', '<=0.5') clamped to their bound; text -> NULL."""
    txt = _money_text(F.col("value"))
    raw = _case(F.col("event_id"), 5, {0: F.concat(F.lit(">"), txt), 1: F.concat(F.lit("<="), txt),
                                       2: F.lit("MEMO")}, txt)
    e = t.events.select("event_id", raw.alias("raw"))
    return e.withColumn("result", C.clamp_censored("raw"))


@query("null_literals", """
SELECT event_id, raw, cleaned, coalesce(CAST(trunc(CASE WHEN isnan(TRY_CAST(cleaned AS DOUBLE)) THEN NULL
       ELSE TRY_CAST(cleaned AS DOUBLE) END) AS BIGINT), 0) AS as_int
FROM (SELECT *, CASE WHEN raw IS NULL OR lower(trim(raw)) IN ('nan', 'none', 'null', 'nul', 'nat', '') THEN ''
                     ELSE raw END AS cleaned FROM (
  SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN 'null' WHEN 3 THEN ''
    WHEN 4 THEN NULL WHEN 5 THEN 'nul' ELSE CAST(user_id AS VARCHAR) END AS raw FROM events) x) y
""")
def null_literals(t):
    """Null words -> '' and then numeric coercion ('' -> 0)."""
    raw = _case(F.col("event_id"), 7, {0: F.lit("nan"), 1: F.lit("None"), 2: F.lit("null"), 3: F.lit(""),
                                       4: F.lit(None).cast("string"), 5: F.lit("nul")}, _s(F.col("user_id")))
    e = t.events.select("event_id", raw.alias("raw")).withColumn("cleaned", C.null_literals("raw", ""))
    return e.withColumn("as_int", C.coerce_int("cleaned"))


@query("time_of_day", """
SELECT event_id, string_split(trim(raw), ' ')[-1] AS hhmmss
FROM (SELECT event_id, '0 days ' || strftime(ts, '%H:%M:%S') AS raw FROM events) x
""")
def time_of_day(t):
    """X22: '0 days HH:MM:SS' -> 'HH:MM:SS'."""
    raw = F.concat(F.lit("0 days "), F.date_format("ts", "HH:mm:ss"))
    return t.events.select("event_id", X.time_of_day(raw).alias("hhmmss"))


@query("time_text_forms", """
SELECT event_id, trim(regexp_replace(raw, '\\bdays?\\b', '', 'g')) AS no_days, raw[8:] AS tail,
       upper(event_type[1]) || lower(event_type[2:]) AS kind,
       CAST(date_trunc('week', ts) AS DATE) AS week_start, CAST(isodow(ts) - 1 AS INTEGER) AS weekday
FROM (SELECT *, event_id % 3 || ' days ' || strftime(ts, '%H:%M:%S') AS raw FROM events) x
""")
def time_text_forms(t):
    """Day words removed, fixed-width prefix cut, capitalized text,
    Monday of the week and weekday number as columns."""
    from carelake.functions.dates import week_start, weekday
    raw = F.concat((F.col("event_id") % 3).cast("string"), F.lit(" days "), F.date_format("ts", "HH:mm:ss"))
    return t.events.select("event_id", X.drop_days(raw).alias("no_days"), X.from_char(raw, 7).alias("tail"),
                           X.capitalize("event_type").alias("kind"), week_start("ts").alias("week_start"),
                           weekday("ts").alias("weekday"))


@query("sheet_complete_columns", """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS sede FROM customer
""")
def sheet_complete_columns(t):
    """One column read as text, columns with any missing value dropped."""
    from carelake.operators.shape import cast_groups, drop_incomplete
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("sede"),
                          F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("nombre"),
                          F.when(F.col("c_custkey") > 5, F.col("c_acctbal")).alias("saldo"))
    return drop_incomplete(cast_groups(c, strings=["sede"]))


@query("concat_nullsafe", """
SELECT c_custkey, coalesce(c_name, '') || ' ' || coalesce(seg, '') AS full_name,
       trim(c_name || ' ' || seg) AS trimmed, upper(c_name) AS upper_name, lower(c_mktsegment) AS lower_seg
FROM (SELECT *, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer) x
""")
def concat_nullsafe(t):
    """NULL-safe concat, trimmed concat (NULL-propagating), case."""
    c = t.customer.withColumn("seg", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")))
    return c.select("c_custkey", X.concat_nullsafe("c_name", "seg").alias("full_name"),
                    X.trim_concat("c_name", "seg", sep=" ").alias("trimmed"),
                    F.upper("c_name").alias("upper_name"), F.lower("c_mktsegment").alias("lower_seg"))


@query("age_bins", """
SELECT p_partkey, CASE WHEN a >= 0 AND a <= 5 THEN '0-5' WHEN a > 5 AND a <= 14 THEN '6-14'
  WHEN a > 14 AND a <= 44 THEN '15-44' WHEN a > 44 AND a <= 59 THEN '45-59' WHEN a > 59 THEN '60+' END AS age_bin
FROM (SELECT p_partkey, p_size - 2 AS a FROM part) x
""")
def age_bins(t):
    """Uneven right-closed bins, lowest edge included, outside -> NULL."""
    return t.part.select("p_partkey", bins(F.col("p_size") - 2, [0, 5, 14, 44, 59, float("inf")],
                                           ["0-5", "6-14", "15-44", "45-59", "60+"]).alias("age_bin"))


@query("age_years_months", """
SELECT l_orderkey, l_linenumber,
  CAST(year(l_shipdate) - year(o_orderdate) - CASE WHEN month(l_shipdate) * 100 + day(l_shipdate)
       < month(o_orderdate) * 100 + day(o_orderdate) THEN 1 ELSE 0 END AS INTEGER) AS age_years,
  CAST((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS INTEGER) AS age_months,
  CAST(date_trunc('month', l_shipdate) AS DATE) + 14 AS mid_month
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def age_years_months(t):
    """Completed years, calendar months and the mid-month key."""
    j = enrich(t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate"),
               t.orders.select("o_orderkey", "o_orderdate"), "l_orderkey", right_on="o_orderkey", how="inner")
    return j.select("l_orderkey", "l_linenumber", age_years("o_orderdate", "l_shipdate").alias("age_years"),
                    age_months("o_orderdate", "l_shipdate").alias("age_months"),
                    mid_month("l_shipdate").alias("mid_month"))


@query("cast_groups", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       coalesce(CAST(trunc(TRY_CAST(CASE WHEN c_custkey % 9 = 0 THEN 'x' ELSE CAST(c_nationkey AS VARCHAR) END AS DOUBLE)) AS BIGINT), 0) AS c_nationkey,
       c_acctbal, coalesce(c_mktsegment, 'SIN SEGMENTO') AS c_mktsegment
FROM (SELECT c_custkey, c_name, c_nationkey, c_acctbal,
             CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer) x
""")
def cast_groups_q(t):
    """List-driven tolerant casts, the rest to string, NULL fill."""
    from carelake.operators.shape import cast_all_but, cast_groups
    c = t.customer.withColumns({
        "c_nationkey": F.when(F.col("c_custkey") % 9 == 0, F.lit("x")).otherwise(F.col("c_nationkey").cast("string")),
        "c_mktsegment": F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))})
    c = cast_groups(c, ints=["c_nationkey"], floats=["c_acctbal"])
    c = cast_all_but(c, ["c_nationkey", "c_acctbal"])
    return c.na.fill({"c_mktsegment": "SIN SEGMENTO"})


@query("utc_normalize", """
SELECT event_id, ts AS ts_utc, CAST(timezone('UTC', timezone('America/Bogota', ts)) AS TIMESTAMP) AS ts_from_bogota,
       CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, strftime(ts, '%Y-%m') AS ym, CAST(ts AS DATE) AS d
FROM events
""")
def utc_normalize(t):
    """Naive local times to UTC wall clock; SQL date parts."""
    e = t.events
    return e.select("event_id", C.to_utc("ts").alias("ts_utc"), C.to_utc("ts", "America/Bogota").alias("ts_from_bogota"),
                    F.year("ts").alias("y"), F.month("ts").alias("m"), F.date_format("ts", "yyyy-MM").alias("ym"),
                    F.to_date("ts").alias("d"))
