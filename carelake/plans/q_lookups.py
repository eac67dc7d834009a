"""Registered join / lookup queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from carelake.functions.dates import full_months, in_range
from carelake.functions.labels import classify, label
from carelake.operators.aggregate import all_of
from carelake.operators.lookup import (
    StatusRule, anti, count_matching, enrich, fill_for_codes, fill_from, flag_in, flags_in, inverse_flag,
    last_value, match_marker, overwrite_from, status_by_priority, unknown_codes,
)
from carelake.plans.registry import query


# Every seventh encounter names a patient that the roll doesn't have.
_LOST_SQL = "(SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey) FROM orders)"


def _lost(t):
    return t.orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 7 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")))


@query("enrich_left", f"""
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM {_LOST_SQL} o LEFT JOIN customer ON o_custkey = c_custkey
""")
def enrich_left(t):
    """Left enrichment on one key; unmatched keys keep NULL attributes."""
    return enrich(_lost(t).select("o_orderkey", "o_custkey"), t.customer, "o_custkey",
                  right_on="c_custkey", select=["c_name", "c_mktsegment"])


_TARIFF_SQL = """(SELECT l_partkey AS t_part, l_suppkey AS t_supp,
                   max(l_extendedprice / l_quantity) AS unit_tariff FROM lineitem GROUP BY 1, 2)"""


def _tariff(t):
    return t.lineitem.groupBy(F.col("l_partkey").alias("t_part"), F.col("l_suppkey").alias("t_supp")).agg(
        F.max(F.try_divide("l_extendedprice", "l_quantity")).alias("unit_tariff"))


@query("enrich_composite", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unit_tariff
FROM (SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN -l_suppkey ELSE l_suppkey END AS l_suppkey) FROM lineitem) l LEFT JOIN {_TARIFF_SQL} tr ON l_partkey = t_part AND l_suppkey = t_supp
""")
def enrich_composite(t):
    """Left join on a composite key (code, provider)."""
    lost = F.when(F.col("l_orderkey") % 7 == 0, -F.col("l_suppkey")).otherwise(F.col("l_suppkey"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", lost.alias("l_suppkey"))
    return enrich(li, _tariff(t), ["l_partkey", "l_suppkey"], right_on=["t_part", "t_supp"])


@query("enrich_renamed_keys", """
SELECT o_orderkey, c_name, n_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def enrich_renamed_keys(t):
    """Chained left joins with differently named keys; right keys dropped."""
    o = enrich(t.orders.select("o_orderkey", "o_custkey"), t.customer, "o_custkey", right_on="c_custkey",
               select=["c_name", "c_nationkey"])
    o = enrich(o, t.nation, "c_nationkey", right_on="n_nationkey", select=["n_name"], small=True)
    return o.select("o_orderkey", "c_name", "n_name")


@query("inner_lookup", """
SELECT l.l_orderkey, l.l_linenumber, o.o_orderpriority, p.p_brand
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON CASE WHEN l.l_orderkey % 7 = 0 THEN -l.l_partkey ELSE l.l_partkey END = p.p_partkey
WHERE o.o_orderstatus = 'F'
""")
def inner_lookup(t):
    """Inner join with a filter, then a left lookup, projected."""
    o = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderpriority")
    lost = F.when(F.col("l_orderkey") % 7 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    j = enrich(t.lineitem.select("l_orderkey", "l_linenumber", lost.alias("l_partkey")), o, "l_orderkey",
               right_on="o_orderkey", how="inner")
    j = enrich(j, t.part, "l_partkey", right_on="p_partkey", select=["p_brand"])
    return j.select("l_orderkey", "l_linenumber", "o_orderpriority", "p_brand")


@query("double_anti", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate >= TIMESTAMP '2001-01-01')
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
""")
def double_anti(t):
    """Affiliates with no recent and no urgent encounter (two anti joins)."""
    o = t.orders
    recent = o.filter(F.col("o_orderdate") >= F.lit(dt.datetime(2001, 1, 1)))
    urgent = o.filter(F.col("o_orderpriority") == "1-URGENT")
    c = t.customer.select("c_custkey", "c_name")
    return anti(anti(c, recent, "c_custkey", right_on="o_custkey"), urgent, "c_custkey", right_on="o_custkey")


@query("semi_flag", """
SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
       AND o.o_orderdate >= TIMESTAMP '2000-01-01' AND o.o_orderdate < TIMESTAMP '2001-01-01') THEN 1 ELSE 0 END AS seen_2000
FROM customer c
""")
def semi_flag(t):
    """1 if the affiliate had an encounter in 2000, else 0."""
    o = t.orders.filter(in_range("o_orderdate", dt.date(2000, 1, 1), dt.date(2001, 1, 1)))
    return flag_in(t.customer.select("c_custkey"), o, "c_custkey", "seen_2000", right_on="o_custkey")


@query("inverse_flag", """
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
       THEN 0 ELSE 1 END AS nuevo
FROM customer
""")
def inverse_flag_q(t):
    """0 when on the previous list (encounters before 1996), else 1."""
    prev = t.orders.filter(F.col("o_orderdate") < F.lit(dt.datetime(1996, 1, 1)))
    return inverse_flag(t.customer.select("c_custkey"), prev, "c_custkey", "nuevo", right_on="o_custkey")


@query("exam_flags", """
WITH u AS (SELECT DISTINCT user_id FROM events),
f AS (SELECT u.user_id,
  CASE WHEN u.user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') THEN 1 ELSE 0 END AS has_purchase,
  CASE WHEN u.user_id IN (SELECT user_id FROM events WHERE event_type = 'signup') THEN 1 ELSE 0 END AS has_signup,
  CASE WHEN u.user_id IN (SELECT user_id FROM events WHERE event_type = 'click' AND value > 100) THEN 1 ELSE 0 END AS has_big_click
  FROM u)
SELECT *, CASE WHEN has_purchase = 1 AND has_signup = 1 AND has_big_click = 1 THEN 1 ELSE 0 END AS all_exams FROM f
""")
def exam_flags(t):
    """Per-patient flags for tests in a list, and the all-of flag; one
    aggregate of the results whatever the number of flags."""
    flags = {"has_purchase": F.col("event_type") == "purchase", "has_signup": F.col("event_type") == "signup",
             "has_big_click": (F.col("event_type") == "click") & (F.col("value") > 100)}
    u = flags_in(t.events.select("user_id").distinct(), t.events, "user_id", flags)
    return u.withColumn("all_exams", all_of("has_purchase", "has_signup", "has_big_click"))


@query("correlated_count", """
SELECT c_custkey, CAST(coalesce(n, 0) AS BIGINT) AS n_urgent FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
           GROUP BY o_custkey) x ON o_custkey = c_custkey
""")
def correlated_count(t):
    """Per affiliate, number of urgent encounters (0 when none)."""
    return count_matching(t.customer.select("c_custkey"), t.orders, "c_custkey", "n_urgent",
                          predicate=F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), right_on="o_custkey")


@query("correlated_last_date", """
SELECT c_custkey, x.last_date FROM customer
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_date FROM orders WHERE o_orderstatus = 'F'
           AND o_orderpriority = '1-URGENT' GROUP BY o_custkey) x ON o_custkey = c_custkey
""")
def correlated_last_date(t):
    """Per affiliate, last date of a qualifying encounter (NULL when none)."""
    pred = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return last_value(t.customer.select("c_custkey"), t.orders, "c_custkey", "o_orderdate", "last_date",
                      right_on="o_custkey", predicate=pred)


_PRICES_SQL = """(SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity AS unit_price,
            p_retailprice, p_brand
     FROM lineitem LEFT JOIN part ON CASE WHEN l_orderkey % 7 = 0 THEN -l_partkey ELSE l_partkey END = p_partkey)"""


def _prices(t):
    p = t.part.select("p_partkey", "p_retailprice", "p_brand")
    lost = F.when(F.col("l_orderkey") % 7 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", lost.alias("code"),
                           F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"))
    return enrich(li, p, "code", right_on="p_partkey")


@query("coalesce_fill", f"""
SELECT l_orderkey, l_linenumber, coalesce(p_retailprice, unit_price) AS price FROM {_PRICES_SQL} x
""")
def coalesce_fill(t):
    """A missing catalog price is filled from the invoice's unit price."""
    return fill_from(_prices(t), "p_retailprice", "unit_price", name="price").select(
        "l_orderkey", "l_linenumber", "price")


@query("overwrite_from_right", f"""
SELECT l_orderkey, l_linenumber, coalesce(p_retailprice, unit_price) AS unit_price FROM {_PRICES_SQL} x
""")
def overwrite_from_right(t):
    """The catalog price replaces the invoice price where present."""
    return overwrite_from(_prices(t), "unit_price", "p_retailprice").select("l_orderkey", "l_linenumber",
                                                                            "unit_price")


@query("code_conditional_fill", """
SELECT p_partkey, p_brand,
  CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND tariff IS NULL THEN 100.0 ELSE tariff END AS tariff,
  CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND section IS NULL THEN 'SPECIAL' ELSE section END AS section
FROM (SELECT p_partkey, p_brand,
             CASE WHEN p_size > 10 THEN p_retailprice END AS tariff,
             CASE WHEN p_size > 10 THEN p_type END AS section FROM part) x
""")
def code_conditional_fill(t):
    """For three listed codes only, missing tariff and section get fixed values."""
    p = t.part.select("p_partkey", "p_brand",
                      F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("tariff"),
                      F.when(F.col("p_size") > 10, F.col("p_type")).alias("section"))
    return fill_for_codes(p, "p_brand", ["Brand#1", "Brand#2", "Brand#3"],
                          {"tariff": 100.0, "section": "SPECIAL"})


@query("match_marker", """
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)
       THEN 'SI' ELSE 'NO' END AS attended
FROM orders
""")
def match_marker_q(t):
    """SI/NO by whether the key is found on the other side."""
    rich = t.customer.filter(F.col("c_acctbal") > 5000)
    return match_marker(t.orders.select("o_orderkey", "o_custkey"), rich, "o_custkey", "attended",
                        right_on="c_custkey").drop("o_custkey")


@query("unmatched_default", f"""
SELECT o_orderkey, coalesce(c_mktsegment, 'OTRO') AS c_mktsegment, coalesce(c_acctbal, 0.0) AS c_acctbal
FROM {_LOST_SQL} o LEFT JOIN customer ON o_custkey = c_custkey
""")
def unmatched_default(t):
    """Unmatched rows get stated defaults."""
    return enrich(_lost(t).select("o_orderkey", "o_custkey"), t.customer, "o_custkey",
                  right_on="c_custkey", select=["c_mktsegment", "c_acctbal"],
                  defaults={"c_mktsegment": "OTRO", "c_acctbal": 0.0}).drop("o_custkey")


_STATE_SQL = """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '4'
                     WHEN o_orderstatus = 'O' THEN '1' WHEN o_orderstatus = 'F' THEN '2' ELSE '3' END"""


@query("priority_status", f"""
WITH s AS (SELECT o_custkey, {_STATE_SQL} AS state FROM orders),
a AS (SELECT o_custkey, max(CASE WHEN state = '1' THEN 2 WHEN state IN ('2', '3') OR state IS NULL THEN 1 END) AS lvl
      FROM s GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN lvl = 2 THEN 'ACTIVO' WHEN lvl = 1 THEN 'INACTIVO' ELSE 'EXTERNO' END AS status
FROM customer LEFT JOIN a ON o_custkey = c_custkey
""")
def priority_status(t):
    """ACTIVO if any active row; else INACTIVO if any 2/3/NULL state; else EXTERNO."""
    k = F.col("o_orderkey")
    state = (F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 13 == 0, "4")
             .when(F.col("o_orderstatus") == "O", "1").when(F.col("o_orderstatus") == "F", "2").otherwise("3"))
    facts = t.orders.select("o_custkey", state.alias("state"))
    rules = [StatusRule("ACTIVO", F.col("state") == "1"),
             StatusRule("INACTIVO", F.col("state").isin("2", "3") | F.col("state").isNull())]
    return status_by_priority(t.customer.select("c_custkey"), facts, "c_custkey", rules, "EXTERNO",
                              right_on="o_custkey")


@query("unknown_state_codes", f"""
SELECT state, CAST(count(*) AS BIGINT) AS n FROM (SELECT {_STATE_SQL} AS state FROM orders) s
WHERE state IS NOT NULL AND state NOT IN ('1', '2', '3') GROUP BY 1
""")
def unknown_state_codes(t):
    """State codes that no rule knows are counted, not just labelled."""
    k = F.col("o_orderkey")
    state = (F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 13 == 0, "4")
             .when(F.col("o_orderstatus") == "O", "1").when(F.col("o_orderstatus") == "F", "2").otherwise("3"))
    return unknown_codes(t.orders.select(state.alias("state")), "state", ["1", "2", "3"])


@query("code_to_label", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENTE' WHEN '2-HIGH' THEN 'ALTA'
       WHEN '3-MEDIUM' THEN 'MEDIA' END AS priority_label
FROM orders
""")
def code_to_label(t):
    """Code -> label, anything else NULL."""
    m = {"1-URGENT": "URGENTE", "2-HIGH": "ALTA", "3-MEDIUM": "MEDIA"}
    return t.orders.select("o_orderkey", label("o_orderpriority", m).alias("priority_label"))


_SEG = {"AUTOMOBILE": "AUTO", "BUILDING": "CONSTRUCCION", "MACHINERY": "MAQUINARIA"}


@query("map_unmapped_null", """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'BUILDING' THEN 'CONSTRUCCION'
       WHEN 'MACHINERY' THEN 'MAQUINARIA' END AS segment FROM customer
""")
def map_unmapped_null(t):
    """Dictionary lookup, unmapped -> NULL."""
    return t.customer.select("c_custkey", label("c_mktsegment", _SEG).alias("segment"))


@query("replace_keep_unmapped", """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'BUILDING' THEN 'CONSTRUCCION'
       WHEN 'MACHINERY' THEN 'MAQUINARIA' ELSE c_mktsegment END AS segment FROM customer
""")
def replace_keep_unmapped(t):
    """Value replace, unmapped values kept."""
    return t.customer.select("c_custkey", label("c_mktsegment", _SEG, keep=True).alias("segment"))


@query("visit_type_classification", """
SELECT o_orderkey, CASE
  WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O' THEN 'URGENCIA'
  WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PRIORITARIA'
  WHEN o_orderpriority = '3-MEDIUM' THEN 'CONTROL'
  WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'PRIMERA VEZ'
  ELSE 'OTRO' END AS visit_type
FROM orders
""")
def visit_type_classification(t):
    """Nested classification, first match wins, default OTRO."""
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    rules = [(pr.isin("1-URGENT", "2-HIGH") & (st == "O"), "URGENCIA"),
             (pr.isin("1-URGENT", "2-HIGH"), "PRIORITARIA"),
             (pr == "3-MEDIUM", "CONTROL"),
             ((st == "F") & (pr == "4-NOT SPECIFIED"), "PRIMERA VEZ")]
    return t.orders.select("o_orderkey", classify(rules, "OTRO").alias("visit_type"))


@query("tenure_flag", """
SELECT c_custkey, CASE WHEN coalesce(m, 0) <= 4 THEN 1 ELSE 2 END AS tenure_flag FROM customer
LEFT JOIN (SELECT o_custkey, datesub('month', min(o_orderdate), max(o_orderdate)) AS m
           FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) x ON o_custkey = c_custkey
""")
def tenure_flag(t):
    """Full months between first and last encounter; <= 4 -> 1 else 2; none -> 1."""
    o = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey").agg(
        full_months(F.min("o_orderdate"), F.max("o_orderdate")).alias("m"))
    j = enrich(t.customer.select("c_custkey"), o, "c_custkey", right_on="o_custkey", defaults={"m": 0})
    return j.select("c_custkey", F.when(F.col("m") <= 4, 1).otherwise(2).alias("tenure_flag"))


@query("null_safe_join", """
WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS k FROM orders),
r AS (SELECT CASE WHEN i = 0 THEN NULL ELSE p END AS k, i AS code
      FROM (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('x', 0)) v(p, i))
SELECT o_orderkey, code FROM l LEFT JOIN r ON l.k IS NOT DISTINCT FROM r.k
""")
def null_safe_join(t):
    """J1 with pandas key semantics: NULL keys match NULL keys (null_safe=True)."""
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string"))
                        .otherwise(F.col("o_orderpriority")).alias("k"))
    codes = t.orders.sparkSession.createDataFrame([("1-URGENT", 1), ("2-HIGH", 2), (None, 0)],
                                                  "k string, code int")
    return enrich(o, codes, "k", null_safe=True, small=True).select("o_orderkey", "code")


@query("suffixed_self_join", """
SELECT a.o_custkey, a.n AS n_x, b.n AS n_y FROM
 (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
 JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON a.o_custkey = b.o_custkey
""")
def suffixed_self_join(t):
    """Same-shaped frames joined, value columns suffixed _x/_y."""
    def part(st):
        return t.orders.filter(F.col("o_orderstatus") == st).groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"))
    a, b = part("F").alias("a"), part("O").alias("b")
    return a.join(b, "o_custkey").select("o_custkey", F.col("a.n").alias("n_x"), F.col("b.n").alias("n_y"))
