"""Registered per-entity sequence queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.operators.sequence import dedupe, first_last, last_per, latest_scaled, partition_total
from carelake.plans.chronic import compensation
from carelake.plans.registry import query
from carelake.plans.standins import AFFILIATES_SQL, affiliates

HBA1C_SQL = "round(o_totalprice / 40000, 1)"
# (order, line) is not unique in the line table: the order lists every
# remaining column so that the kept row is fully determined.
LINE_ORDER = ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]


def hba1c_results(t):
    """Lab-result stand-in: one HbA1c-like value per encounter."""
    return t.orders.select(F.col("o_custkey").alias("patient"), F.col("o_orderdate").alias("result_date"),
                           F.col("o_orderkey").alias("result_id"),
                           F.round(F.col("o_totalprice") / 40000, 1).alias("result"))


@query("partition_total_window", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_totalprice,
       round(sum(o_totalprice) OVER (PARTITION BY date_trunc('month', o_orderdate)), 2) AS month_total,
       round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY date_trunc('month', o_orderdate)), 4) AS share
FROM orders
""")
def partition_total_window(t):
    """Each encounter's share of its month total."""
    o = t.orders.select("o_orderkey", "o_totalprice",
                        F.trunc(F.to_date("o_orderdate"), "MM").alias("month"))
    j = partition_total(o, "month", "o_totalprice", "month_total")
    return j.select("o_orderkey", "month", "o_totalprice",
                    F.round("month_total", 2).alias("month_total"),
                    F.round(F.try_divide("o_totalprice", "month_total"), 4).alias("share"))


@query("last_result_per_patient", """
SELECT user_id, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type = 'purchase') WHERE rn = 1
""")
def last_result_per_patient(t):
    """Latest result per patient, ties broken by the highest id."""
    e = t.events.filter(F.col("event_type") == "purchase").select("user_id", "event_id", "ts", "value")
    return last_per(e, "user_id", ["ts", "event_id"])


_FIRST_LAST_SQL = f"""
WITH r AS (SELECT o_custkey AS patient, o_orderdate AS result_date, o_orderkey AS result_id,
                  {HBA1C_SQL} AS result FROM orders),
o AS (SELECT *, row_number() OVER (PARTITION BY patient ORDER BY result_date, result_id) AS rf,
             row_number() OVER (PARTITION BY patient ORDER BY result_date DESC, result_id DESC) AS rl,
             count(*) OVER (PARTITION BY patient) AS n FROM r),
fl AS (SELECT f.patient, f.result AS first_value, f.result_date AS first_date,
              l.result AS last_value, l.result_date AS last_date, CAST(f.n AS BIGINT) AS n_results,
              CAST(date_diff('day', f.result_date, l.result_date) AS INTEGER) AS span_days,
              f.result - l.result AS drop_
       FROM o f JOIN o l ON f.patient = l.patient AND f.rf = 1 AND l.rl = 1)
"""

_IMPROVED_SQL = """CASE WHEN n_results > 1 AND span_days >= 335 AND (
      (first_value > 10 AND round(drop_ * 100) >= 200) OR
      (first_value >= 8 AND first_value <= 10 AND round(drop_ * 100) >= 100) OR
      (first_value < 8 AND round(drop_ * 100) >= 50)) THEN 1 ELSE 0 END"""


@query("first_last_improvement", _FIRST_LAST_SQL + f"""
SELECT patient, first_value, first_date, last_value, last_date, n_results, span_days,
       {_IMPROVED_SQL} AS improved
FROM fl
""")
def first_last_improvement(t):
    """W3/X31/D12 second stage: first vs last result, span and tiered fall."""
    from carelake.plans.chronic import improved
    fl = first_last(hba1c_results(t), "patient", "result_date", "result", tiebreak="result_id")
    return fl.select("patient", "first_value", "first_date", "last_value", "last_date",
                     "n_results", "span_days", improved().alias("improved"))


@query("compensation_status", _FIRST_LAST_SQL + f"""
SELECT fl.patient, a.age, last_value, n_results,
       CASE WHEN (a.age < 65 AND round(last_value * 100) <= 700) OR (a.age >= 65 AND round(last_value * 100) <= 800)
            THEN 1 ELSE {_IMPROVED_SQL} END AS compensated
FROM fl JOIN ({AFFILIATES_SQL}) a ON a.c_custkey = fl.patient
""")
def compensation_status(t):
    """Last-result rule by age, else the first/last improvement rule."""
    ages = affiliates(t.customer).select(F.col("c_custkey").alias("patient"), "age")
    return compensation(hba1c_results(t), ages).select("patient", "age", "last_value", "n_results",
                                                        "compensated")


@query("dedupe_keep_first", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
                                                         ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                                                  l_returnflag, l_linestatus, l_shipdate) AS rn
                     FROM lineitem) WHERE rn = 1
""")
def dedupe_keep_first(t):
    """One line per (order, code), the first by line number."""
    return dedupe(t.lineitem, ["l_orderkey", "l_partkey"], keep="first", order=LINE_ORDER)


@query("dedupe_keep_last", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
                                                         ORDER BY l_linenumber DESC, l_suppkey DESC, l_quantity DESC,
                                                                  l_extendedprice DESC, l_discount DESC, l_tax DESC,
                                                                  l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS rn
                     FROM lineitem) WHERE rn = 1
""")
def dedupe_keep_last(t):
    """One line per (order, code), the last by line number."""
    return dedupe(t.lineitem, ["l_orderkey", "l_partkey"], keep="last", order=LINE_ORDER)


@query("dedupe_subset", """
SELECT event_id, ts, user_id, event_type, value, props, day FROM (
  SELECT *, CAST(ts AS DATE) AS day,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1
""")
def dedupe_subset(t):
    """First event per (patient, day)."""
    e = t.events.withColumn("day", F.to_date("ts"))
    return dedupe(e, ["user_id", "day"], keep="first", order=["ts", "event_id"])


@query("dedupe_whole_row", """
SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders
""")
def dedupe_whole_row(t):
    """Whole-row duplicates collapsed."""
    return dedupe(t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query("latest_population_scaled", """
SELECT CAST(trunc(arg_max(n, month) * 1.05) AS BIGINT) AS projected FROM (
  SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1)
""")
def latest_population_scaled(t):
    """Latest monthly population x 1.05, truncated."""
    m = t.orders.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"))
    return latest_scaled(m, "month", "n", 1.05, "projected")
