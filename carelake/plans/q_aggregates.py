"""Registered aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.operators.aggregate import (
    conditional_sums, count_distinct_pairs, grouped_with_total, indicator_sum, ratio,
)
from carelake.operators.lookup import enrich
from carelake.plans.registry import query

URGENT = ("1-URGENT", "2-HIGH")


def orders_by_customer(t, *cust_cols):
    """orders with customer attributes (customer grows with the data: the
    planner picks the strategy from measured sizes)."""
    return enrich(t.orders, t.customer.select("c_custkey", *cust_cols), "o_custkey",
                  right_on="c_custkey", how="inner")


@query("grand_total_rollup", """
SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'ALL SEGMENTS' ELSE c_mktsegment END AS c_mktsegment,
       CAST(count(*) AS BIGINT) AS n_orders, round(sum(o_totalprice), 2) AS sum_price
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY GROUPING SETS ((c_mktsegment), ())
""")
def grand_total_rollup(t):
    """A4/A5: count and sum per segment plus the total row, one aggregation."""
    o = orders_by_customer(t, "c_mktsegment")
    g = grouped_with_total(o, ["c_mktsegment"], [F.count(F.lit(1)).alias("n_orders"),
                                                 F.sum("o_totalprice").alias("sum_price")],
                           "ALL SEGMENTS")
    return g.withColumn("sum_price", F.round("sum_price", 2))


@query("ratio_indicator", """
SELECT CASE WHEN grouping(n_name) = 1 THEN 'NETWORK TOTAL' ELSE n_name END AS n_name,
       CAST(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS BIGINT) AS numerator,
       CAST(count(*) AS BIGINT) AS denominator,
       round(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END)::DOUBLE / count(*), 4) AS ratio
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY GROUPING SETS ((n_name), ())
""")
def ratio_indicator(t):
    """Share of urgent encounters per site plus the network ratio."""
    o = orders_by_customer(t, "c_nationkey")
    o = enrich(o, t.nation.select("n_nationkey", "n_name"), "c_nationkey", right_on="n_nationkey",
               how="inner", small=True)
    return ratio(o, "n_name", F.when(F.col("o_orderpriority").isin(*URGENT), 1).otherwise(0).cast("bigint"),
                 F.lit(1).cast("bigint"), total_label="NETWORK TOTAL")


@query("conditional_sums", """
SELECT o_orderpriority,
       round(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0), 2) AS price_covered,
       round(coalesce(sum(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END), 0), 2) AS price_not_covered,
       CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END), 0) AS DOUBLE) AS n_covered,
       CAST(coalesce(sum(CASE WHEN o_orderstatus <> 'F' THEN 1 END), 0) AS DOUBLE) AS n_not_covered
FROM orders GROUP BY o_orderpriority
""")
def conditional_sums_q(t):
    """Covered / not-covered measures in one pass."""
    g = conditional_sums(t.orders, "o_orderpriority",
                         {"price": F.col("o_totalprice"), "n": F.lit(1.0)},
                         {"covered": F.col("o_orderstatus") == "F",
                          "not_covered": F.col("o_orderstatus") != "F"})
    return g.withColumns({c: F.round(c, 2) for c in ("price_covered", "price_not_covered")})


@query("multi_measure_group", """
SELECT l_returnflag, l_linestatus,
       CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(l_quantity) AS BIGINT) AS n_qty,
       round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_price,
       round(sum(l_discount), 2) AS sum_disc,
       max(l_tax) AS max_tax, min(l_shipdate) AS first_ship
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def multi_measure_group(t):
    """A1-A3: count (all / non-null), sums, max, min per group."""
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("l_quantity").alias("n_qty"),
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.round(F.sum("l_discount"), 2).alias("sum_disc"),
        F.max("l_tax").alias("max_tax"), F.min("l_shipdate").alias("first_ship"))


@query("distinct_visit_days", """
SELECT user_id, CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS visit_days,
       CAST(count(DISTINCT (CAST(ts AS DATE), event_type)) AS BIGINT) AS visit_day_types
FROM events GROUP BY user_id
""")
def distinct_visit_days(t):
    """A10: distinct days (and distinct day x test pairs) per patient."""
    e = t.events.withColumn("day", F.to_date("ts"))
    return e.groupBy("user_id").agg(
        F.count_distinct("day").alias("visit_days"),
        F.count_distinct("day", "event_type").alias("visit_day_types"))


@query("max_per_key", """
SELECT l_partkey, max(l_extendedprice) AS max_price FROM lineitem GROUP BY l_partkey
""")
def max_per_key(t):
    """Highest tariff per code."""
    return t.lineitem.groupBy("l_partkey").agg(F.max("l_extendedprice").alias("max_price"))


@query("pick_one_per_key", """
SELECT p_brand, arg_min(p_name, p_partkey) AS pick_name, min(p_partkey) AS pick_partkey
FROM part GROUP BY p_brand
""")
def pick_one_per_key(t):
    """One row per key, deterministically the lowest id."""
    return t.part.groupBy("p_brand").agg(F.min_by("p_name", "p_partkey").alias("pick_name"),
                                         F.min("p_partkey").alias("pick_partkey"))


@query("scalar_aggregates", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, max(l_shipdate) AS last_ship,
       round(sum(l_quantity), 2) AS sum_qty,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned
FROM lineitem
""")
def scalar_aggregates(t):
    """Whole-table aggregates in one row."""
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows"), F.max("l_shipdate").alias("last_ship"),
                          F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
                          indicator_sum(F.col("l_returnflag") == "R").alias("n_returned"))


@query("distinct_patients_month", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_patients
FROM orders GROUP BY 1
""")
def distinct_patients_month(t):
    """A10: unique (patient, month) pairs counted per month."""
    return count_distinct_pairs(t.orders.withColumn("month", F.trunc(F.to_date("o_orderdate"), "MM")),
                                "month", "o_custkey", name="n_patients")
