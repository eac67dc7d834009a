"""How the driver tables stand in for the clinic entities.

affiliate = customer (age = floor(c_acctbal/100) clipped at 0, sex by key
parity), site = nation/region, professional = supplier, encounter = orders,
invoice line = lineitem, lab result = events (user_id patient, event_type
test, value result). Each derivation has a Spark form and the same SQL text
for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGE_SQL = "GREATEST(CAST(FLOOR(c_acctbal / 100) AS INTEGER), 0)"
SEX_SQL = "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END"
AFFILIATES_SQL = f"SELECT c.*, {AGE_SQL} AS age, {SEX_SQL} AS sex FROM customer c"


def affiliates(customer: DataFrame) -> DataFrame:
    return customer.withColumns({
        "age": F.greatest(F.floor(F.col("c_acctbal") / 100).cast("int"), F.lit(0)),
        "sex": F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M"),
    })


def visit_type(pr="o_orderpriority", st="o_orderstatus"):
    """Visit-type classification stand-in on encounter priority and status."""
    from carelake.functions.labels import classify
    p, s = F.col(pr), F.col(st)
    return classify([(p.isin("1-URGENT", "2-HIGH") & (s == "O"), "URGENCIA"),
                     (p.isin("1-URGENT", "2-HIGH"), "PRIORITARIA"),
                     (p == "3-MEDIUM", "CONTROL"),
                     ((s == "F") & (p == "4-NOT SPECIFIED"), "PRIMERA VEZ")], "OTRO")


VISIT_SQL = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O' THEN 'URGENCIA'
  WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PRIORITARIA'
  WHEN o_orderpriority = '3-MEDIUM' THEN 'CONTROL'
  WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'PRIMERA VEZ'
  ELSE 'OTRO' END"""
