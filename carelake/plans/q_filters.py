"""Registered filter and calendar-window queries.

Run dates are fixed parameters; every window is a literal half-open range on
the raw timestamp column, so it appears under PushedFilters at the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from carelake.functions import dates as D
from carelake.operators import filters as FL
from carelake.operators.aggregate import cohort_counts
from carelake.operators.aggregate import Cohort
from carelake.plans.registry import query
from carelake.plans.standins import AFFILIATES_SQL, affiliates

EVENTS_RUN = dt.date(2024, 1, 17)      # a Wednesday
ORDERS_RUN = dt.date(2001, 3, 20)


def _sql_day(d: dt.date) -> str:
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


def _sql_days(col: str, lo: dt.date, hi: dt.date) -> str:
    return f"{col} >= {_sql_day(lo)} AND {col} < {_sql_day(hi + dt.timedelta(days=1))}"


def _count_in(df, col, group, windows: dict):
    """Count rows per group for several named windows in one pass."""
    return df.groupBy(group).agg(*[F.count_if(D.in_days(col, lo, hi)).alias(n)
                                   for n, (lo, hi) in windows.items()])


def _count_sql(table: str, col: str, group: str, windows: dict) -> str:
    sel = ", ".join(f"CAST(count_if({_sql_days(col, lo, hi)}) AS BIGINT) AS {n}" for n, (lo, hi) in windows.items())
    return f"SELECT {group}, {sel} FROM {table} GROUP BY {group}"


_PREV_WEEK = {"n_prev_week": D.prev_week(EVENTS_RUN), "n_prev_week_legacy": D.prev_week(EVENTS_RUN, legacy=True),
              "n_prev_iso_week": D.prev_iso_week(EVENTS_RUN)}


@query("prev_week_window", _count_sql("events", "ts", "event_type", _PREV_WEEK))
def prev_week_window(t):
    """previous week (Mon..Sun), the legacy 8-day Sunday..Sunday form,
    and the previous ISO week, counted per test type."""
    return _count_in(t.events, "ts", "event_type", _PREV_WEEK)


_CUR = {"n_current_week": D.current_week(EVENTS_RUN),
        "n_current_week_sun": D.current_week(EVENTS_RUN, sunday_start=True),
        "n_yesterday": D.day_window(EVENTS_RUN, 1), "n_today": D.day_window(EVENTS_RUN, 0)}


@query("current_week", _count_sql("events", "ts", "event_type", _CUR))
def current_week(t):
    """current week from Monday (or Sunday), yesterday and today."""
    return _count_in(t.events, "ts", "event_type", _CUR)


_NOW = dt.datetime(2024, 1, 17, 9, 30)
_H24 = D.last_24h(_NOW)


@query("last_24h", f"""
SELECT event_type, CAST(count(*) AS BIGINT) AS n_24h FROM events
WHERE ts >= TIMESTAMP '{_H24[0]}' AND ts < TIMESTAMP '{_H24[1]}' GROUP BY event_type
""")
def last_24h(t):
    """``now - 24h <= ts < now``."""
    e = t.events.filter(D.in_range("ts", *_H24))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_24h"))


_FORT = {"n_fortnight_16": D.fortnight(dt.date(2024, 1, 16)),
         "n_fortnight_1": D.fortnight(dt.date(2001, 3, 1))}


@query("fortnight", f"""
SELECT e.event_type, e.n_fortnight_16, o.n_fortnight_1 FROM
 (SELECT event_type, CAST(count_if({_sql_days('ts', *_FORT['n_fortnight_16'])}) AS BIGINT) AS n_fortnight_16
  FROM events GROUP BY 1) e
 JOIN (SELECT CAST(count_if({_sql_days('o_orderdate', *_FORT['n_fortnight_1'])}) AS BIGINT) AS n_fortnight_1
  FROM orders) o ON TRUE
""")
def fortnight(t):
    """run on the 16th -> days 1..15; run on the 1st -> 16..end of last month."""
    assert D.fortnight(dt.date(2024, 1, 10)) is None
    e = _count_in(t.events, "ts", "event_type", {"n_fortnight_16": _FORT["n_fortnight_16"]})
    lo, hi = _FORT["n_fortnight_1"]
    o = t.orders.agg(F.count_if(D.in_days("o_orderdate", lo, hi)).alias("n_fortnight_1"))
    return e.crossJoin(F.broadcast(o))


_MONTHS = {"n_prev_month": D.prev_month(ORDERS_RUN), "n_lag15": D.lagged_month(ORDERS_RUN, 15),
           "n_lag25": D.lagged_month(ORDERS_RUN, 25)}


@query("prev_month", _count_sql("orders", "o_orderdate", "o_orderpriority", _MONTHS))
def prev_month(t):
    """Previous calendar month and lagged months (run - 15 / - 25 days)."""
    return _count_in(t.orders, "o_orderdate", "o_orderpriority", _MONTHS)


_LB_RUN = dt.date(2001, 6, 1)
_LB_LO = _LB_RUN - dt.timedelta(days=211)


@query("strict_lookback", f"""
SELECT o_custkey,
  CAST(count_if(o_orderdate > {_sql_day(_LB_LO)} AND o_orderdate < {_sql_day(_LB_RUN)}) AS BIGINT) AS n_strict,
  CAST(count_if(o_orderdate > {_sql_day(_LB_LO)} AND o_orderdate <= {_sql_day(_LB_RUN)}) AS BIGINT) AS n_lax
FROM orders WHERE o_orderdate > {_sql_day(_LB_LO)} AND o_orderdate <= {_sql_day(_LB_RUN)}
GROUP BY o_custkey
""")
def strict_lookback(t):
    """``> d-211 and < d`` vs ``> d-211 and <= d``, both kept as stated."""
    lax = D.in_range("o_orderdate", _LB_LO, _LB_RUN, hi_inclusive=True, lo_inclusive=False)
    strict = D.in_range("o_orderdate", _LB_LO, _LB_RUN, lo_inclusive=False)
    return t.orders.filter(lax).groupBy("o_custkey").agg(F.count_if(strict).alias("n_strict"),
                                                         F.count_if(lax).alias("n_lax"))


_BLANKS_SQL = """SELECT event_id, user_id,
  CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN '  ' ELSE event_type END AS c1,
  CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS c2
FROM events"""


def _blanks(t):
    k = F.col("event_id")
    c1 = F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 7 == 1, F.lit("  ")).otherwise(F.col("event_type"))
    c2 = F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit(None).cast("string")).otherwise(
        F.col("user_id").cast("string"))
    return t.events.select("event_id", "user_id", c1.alias("c1"), c2.alias("c2"))


@query("drop_blank_rows", f"""
SELECT * FROM ({_BLANKS_SQL}) x
WHERE NOT ((c1 IS NULL OR trim(c1) = '') AND (c2 IS NULL OR trim(c2) = ''))
""")
def drop_blank_rows(t):
    """rows blank in both columns dropped."""
    return FL.drop_blank_rows(_blanks(t), ["c1", "c2"])


@query("truncate_at_blank", f"""
WITH b AS ({_BLANKS_SQL}),
cut AS (SELECT user_id, min(event_id) AS first_blank FROM b
        WHERE (c1 IS NULL OR trim(c1) = '') AND (c2 IS NULL OR trim(c2) = '') GROUP BY user_id)
SELECT b.* FROM b LEFT JOIN cut USING (user_id) WHERE cut.first_blank IS NULL OR b.event_id < cut.first_blank
""")
def truncate_at_blank(t):
    """per patient sheet, rows before the first all-blank row (by id)."""
    return FL.truncate_at_blank(_blanks(t), ["c1", "c2"], "event_id", by="user_id")


@query("sentinel_blacklist", """
SELECT event_id, id FROM (SELECT event_id, CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '00'
  WHEN 3 THEN '000' WHEN 4 THEN 'noencontrado' WHEN 5 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS id
  FROM events) x
WHERE id IS NOT NULL AND trim(id) NOT IN ('', '0', '00', '000', 'noencontrado')
""")
def sentinel_blacklist(t):
    """NULL ids and placeholder ids dropped."""
    k = F.col("event_id") % 9
    idc = (F.when(k == 0, "").when(k == 1, "0").when(k == 2, "00").when(k == 3, "000")
           .when(k == 4, "noencontrado").when(k == 5, F.lit(None).cast("string"))
           .otherwise(F.col("user_id").cast("string")))
    return FL.drop_sentinels(t.events.select("event_id", idc.alias("id")), "id")


_FLAGS = [f"f{i}" for i in range(6)]


@query("wide_exclusion", f"""
SELECT c_custkey, age FROM (SELECT c_custkey, age,
  {', '.join(f"CASE WHEN c_custkey % 97 = {i} THEN NULL ELSE (c_custkey // {2 ** i}) % 2 END AS f{i}" for i in range(6))}
  FROM ({AFFILIATES_SQL}) a) x
WHERE NOT coalesce(age >= 18 AND {' AND '.join(f'{f} = 0' for f in _FLAGS)}, FALSE)
""")
def wide_exclusion(t):
    """F16: adults whose every risk flag is 0 are excluded; NULL flags keep the row."""
    a = affiliates(t.customer)
    k = F.col("c_custkey")
    a = a.select("c_custkey", "age", *[F.when(k % 97 == i, F.lit(None).cast("bigint"))
                                      .otherwise(F.floor(k / 2 ** i).cast("bigint") % 2).alias(f"f{i}")
                                      for i in range(6)])
    return FL.wide_exclusion(a, _FLAGS, when=F.col("age") >= 18).select("c_custkey", "age")


@query("like_any", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR p_name LIKE '%bolt%' OR p_name LIKE '%red w%'
""")
def like_any(t):
    """any of several substring patterns."""
    return FL.like_any(t.part.select("p_partkey", "p_name"), "p_name", ["ring", "bolt", "red w"])


@query("latest_period", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)
""")
def latest_period(t):
    """rows of the latest period (scalar max subquery)."""
    o = t.orders.select("o_orderkey", "o_orderdate", F.trunc(F.to_date("o_orderdate"), "MM").alias("period"))
    return FL.latest_period(o, "period").drop("period")


@query("in_lists", """
SELECT o_orderkey FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus NOT IN ('P')
  AND o_orderdate BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31'
""")
def in_lists(t):
    """IN, NOT IN and an inclusive BETWEEN."""
    o = t.orders
    return o.filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & ~F.col("o_orderstatus").isin("P")
                    & F.col("o_orderdate").between(F.lit(dt.datetime(1999, 1, 1)), F.lit(dt.datetime(1999, 12, 31)))
                    ).select("o_orderkey")


@query("either_role", """
SELECT s_suppkey FROM (SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS rol,
                              CAST(s_suppkey % 25 AS VARCHAR) AS rol2 FROM supplier) x
WHERE rol = '3' OR rol2 = '3'
""")
def either_role(t):
    """a value in either of two role columns."""
    s = t.supplier.select("s_suppkey", F.col("s_nationkey").cast("string").alias("rol"),
                          (F.col("s_suppkey") % 25).cast("string").alias("rol2"))
    return FL.either_equals(s, ["rol", "rol2"], "3").select("s_suppkey")


@query("result_sentinels", """
SELECT event_type,
  CAST(count_if(r <> 'MEMO' AND r <> 'undefined') AS BIGINT) AS n_sql,
  CAST(count_if(r IS NULL OR (r <> 'MEMO' AND r <> 'undefined')) AS BIGINT) AS n_keep_null
FROM (SELECT event_type, CASE event_id % 10 WHEN 0 THEN 'MEMO' WHEN 1 THEN 'undefined' WHEN 2 THEN NULL
        ELSE CAST(user_id AS VARCHAR) END AS r FROM events) x GROUP BY event_type
""")
def result_sentinels(t):
    """SQL ``<>`` drops NULL results, the pandas form keeps them."""
    k = F.col("event_id") % 10
    r = (F.when(k == 0, "MEMO").when(k == 1, "undefined").when(k == 2, F.lit(None).cast("string"))
         .otherwise(F.col("user_id").cast("string")))
    e = t.events.select("event_type", r.alias("r"))
    sql_form = (F.col("r") != "MEMO") & (F.col("r") != "undefined")
    keep = FL.not_equal_keep_null("r", "MEMO") & FL.not_equal_keep_null("r", "undefined")
    return e.groupBy("event_type").agg(F.count_if(sql_form).alias("n_sql"), F.count_if(keep).alias("n_keep_null"))


@query("coerced_date_floor", """
SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber % 4 = 0 THEN 'no date' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS raw FROM lineitem) x
WHERE try_strptime(raw, '%Y-%m-%d') >= TIMESTAMP '2000-01-01'
""")
def coerced_date_floor(t):
    """lower bound on a tolerant parse; unparsable rows drop out."""
    from carelake.functions.coerce import coerce_ts
    raw = F.when(F.col("l_linenumber") % 4 == 0, F.lit("no date")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return FL.since_coerced(li, coerce_ts("raw", "yyyy-MM-dd"), dt.datetime(2000, 1, 1)).select(
        "l_orderkey", "l_linenumber")


@query("dropna_modes", """
SELECT CAST(count_if(NOT (a IS NULL AND b IS NULL)) AS BIGINT) AS n_not_all_null,
       CAST(count_if(a IS NOT NULL) AS BIGINT) AS n_key_present
FROM (SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS a,
             CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS b FROM events) x
""")
def dropna_modes(t):
    """``dropna(how='all')`` and ``dropna(subset=[key])``."""
    k = F.col("event_id")
    e = t.events.select(F.when(k % 3 != 0, F.col("value")).alias("a"), F.when(k % 4 != 0, F.col("event_type")).alias("b"))
    n_all = e.na.drop(how="all").agg(F.count(F.lit(1)).alias("n_not_all_null"))
    n_key = e.na.drop(subset=["a"]).agg(F.count(F.lit(1)).alias("n_key_present"))
    return n_all.crossJoin(n_key)
