"""Registered domain plans (D6-D11, D13-D15, D18, D19, D21, D28) on the
driver tables (stand-ins in :mod:`carelake.plans.standins`)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from carelake.functions import coerce as C
from carelake.functions.dates import in_range, mid_month
from carelake.functions.labels import bins, label
from carelake.operators import filters as FL
from carelake.operators.aggregate import all_of, grouped_with_total, ratio
from carelake.operators.lookup import (
    broadcast_small,    StatusRule, enrich, fill_for_codes, flags_in, status_by_priority,
)
from carelake.operators.sequence import dedupe, last_per
from carelake.operators.setops import union_distinct, union_tagged
from carelake.operators.shape import broadcast_scalar, split_key
from carelake.plans.chronic import compensation
from carelake.plans.registry import query
from carelake.plans.standins import AFFILIATES_SQL, VISIT_SQL, affiliates, visit_type


def _ts(y, m, d):
    return dt.datetime(y, m, d)


def _sites(t):
    return t.nation.select("n_nationkey", "n_name")


def _with_site(df, t, key="c_nationkey"):
    # 25-row site dimension: size-bounded broadcast.
    return enrich(df, _sites(t), key, right_on="n_nationkey", how="inner", small=True)


# ---------------------------------------------------------------- D7
@query("encounter_audit", f"""
WITH enc AS (SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS day, n.n_name, {VISIT_SQL} AS visit_type
   FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
   WHERE o.o_orderdate >= TIMESTAMP '2001-02-01' AND o.o_orderdate < TIMESTAMP '2001-03-01'),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, day, visit_type ORDER BY o_orderkey) AS rn
                     FROM enc) x WHERE rn = 1),
cnt AS (SELECT n_name, visit_type, CAST(count(*) AS BIGINT) AS n_encounters FROM d GROUP BY 1, 2),
pop AS (SELECT n_name, CAST(count(*) AS BIGINT) AS population FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT cnt.n_name, visit_type, n_encounters, population,
       (SELECT CAST(sum(population) AS BIGINT) FROM pop) AS network_population,
       n_encounters * 1000 // population AS per_1000
FROM cnt LEFT JOIN pop ON cnt.n_name = pop.n_name
""")
def encounter_audit(t):
    """month's encounters -> site -> visit type -> keyed dedupe (patient,
    day, type) -> counts with the site and network populations."""
    enc = t.orders.filter(in_range("o_orderdate", _ts(2001, 2, 1), _ts(2001, 3, 1)))
    enc = enrich(enc, t.customer.select("c_custkey", "c_nationkey"), "o_custkey", right_on="c_custkey", how="inner")
    enc = _with_site(enc, t).select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "n_name",
                                    visit_type().alias("visit_type"))
    enc = dedupe(enc, ["o_custkey", "day", "visit_type"], keep="first", order="o_orderkey")
    cnt = enc.groupBy("n_name", "visit_type").agg(F.count(F.lit(1)).alias("n_encounters"))
    pop = _with_site(t.customer, t).groupBy("n_name").agg(F.count(F.lit(1)).alias("population"))
    net = pop.agg(F.sum("population").alias("network_population"))
    out = broadcast_scalar(enrich(cnt, pop, "n_name"), net)
    return out.withColumn("per_1000", F.expr("n_encounters * 1000 div population"))


# ---------------------------------------------------------------- D8
_BIN_EDGES = [0, 5, 14, 44, 59, float("inf")]
_BIN_LABELS = ["0-5", "6-14", "15-44", "45-59", "60+"]
_BIN_SQL = ("CASE WHEN age >= 0 AND age <= 5 THEN '0-5' WHEN age > 5 AND age <= 14 THEN '6-14' "
            "WHEN age > 14 AND age <= 44 THEN '15-44' WHEN age > 44 AND age <= 59 THEN '45-59' "
            "WHEN age > 59 THEN '60+' END")


@query("demographics", f"""
WITH a AS (SELECT c_custkey, sex, {_BIN_SQL} AS age_bin FROM ({AFFILIATES_SQL}) x),
e AS (SELECT sex, age_bin, CAST(count(*) AS BIGINT) AS n_encounters FROM orders JOIN a ON o_custkey = c_custkey
      WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-02-01' GROUP BY 1, 2),
p AS (SELECT sex, age_bin, CAST(count(*) AS BIGINT) AS population FROM a GROUP BY 1, 2)
SELECT p.sex, p.age_bin, coalesce(e.n_encounters, 0) AS n_encounters, p.population
FROM p LEFT JOIN e ON p.sex = e.sex AND p.age_bin = e.age_bin
""")
def demographics(t):
    """Month encounters and population by sex x age bin (every bin and
    sex kept: the 6-14 bin and unmapped sexes are not dropped)."""
    a = affiliates(t.customer).select("c_custkey", "sex", bins("age", _BIN_EDGES, _BIN_LABELS).alias("age_bin"))
    e = t.orders.filter(in_range("o_orderdate", _ts(2001, 1, 1), _ts(2001, 2, 1)))
    e = enrich(e, a, "o_custkey", right_on="c_custkey", how="inner").groupBy("sex", "age_bin").agg(
        F.count(F.lit(1)).alias("n_encounters"))
    p = a.groupBy("sex", "age_bin").agg(F.count(F.lit(1)).alias("population"))
    return enrich(p, e, ["sex", "age_bin"], defaults={"n_encounters": 0}).select(
        "sex", "age_bin", "n_encounters", "population")


# ---------------------------------------------------------------- D9
_PROGRAM = {"3-MEDIUM": "CONTROL PRENATAL", "4-NOT SPECIFIED": "CONSULTA", "5-LOW": "CURSO"}
_PROGRAM_SQL = ("CASE o_orderpriority WHEN '3-MEDIUM' THEN 'CONTROL PRENATAL' WHEN '4-NOT SPECIFIED' THEN 'CONSULTA' "
                "WHEN '5-LOW' THEN 'CURSO' ELSE 'OTRO' END")


@query("prenatal_summary", f"""
SELECT n_name, CASE WHEN grouping(program) = 1 THEN 'TOTAL' ELSE program END AS program,
       CAST(count(o_orderkey) AS BIGINT) AS n
FROM (SELECT o_orderkey, n_name, {_PROGRAM_SQL} AS program
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2001-01-01') x
GROUP BY GROUPING SETS ((n_name, program), (n_name))
""")
def prenatal_summary(t):
    """Encounters per site and program plus per-site totals."""
    o = t.orders.filter(in_range("o_orderdate", _ts(2000, 1, 1), _ts(2001, 1, 1)))
    o = enrich(o, t.customer.select("c_custkey", "c_nationkey"), "o_custkey", right_on="c_custkey", how="inner")
    o = _with_site(o, t).withColumn("program", label("o_orderpriority", _PROGRAM, default="OTRO"))
    return grouped_with_total(o, ["n_name", "program"], [F.count("o_orderkey").alias("n")], "TOTAL", "program")


@query("prenatal_indicator", f"""
WITH w AS (SELECT a.*, n_name FROM ({AFFILIATES_SQL}) a JOIN nation ON c_nationkey = n_nationkey
           WHERE sex = 'F' AND age BETWEEN 15 AND 49),
u AS (SELECT n_name, 1 AS num, 0 AS den FROM orders JOIN w ON o_custkey = c_custkey
      WHERE o_orderpriority = '3-MEDIUM' AND o_orderdate >= TIMESTAMP '2000-06-01' AND o_orderdate < TIMESTAMP '2001-03-01'
      UNION ALL SELECT n_name, 0, 1 FROM w)
SELECT CASE WHEN grouping(n_name) = 1 THEN 'NETWORK TOTAL' ELSE n_name END AS n_name,
       CAST(sum(num) AS BIGINT) AS numerator, CAST(sum(den) AS BIGINT) AS denominator,
       round(sum(num)::DOUBLE / sum(den), 4) AS ratio
FROM u GROUP BY GROUPING SETS ((n_name), ())
""")
def prenatal_indicator(t):
    """Prenatal controls in 9 months per woman aged 15-49, per site
    and network (numerator and denominator rows in one aggregation)."""
    w = _with_site(affiliates(t.customer), t).filter((F.col("sex") == "F") & F.col("age").between(15, 49))
    o = t.orders.filter((F.col("o_orderpriority") == "3-MEDIUM") &
                        in_range("o_orderdate", _ts(2000, 6, 1), _ts(2001, 3, 1)))
    num = enrich(o.select("o_custkey"), w.select("c_custkey", "n_name"), "o_custkey", right_on="c_custkey",
                 how="inner").select("n_name", F.lit(1).alias("num"), F.lit(0).alias("den"))
    den = w.select("n_name", F.lit(0).alias("num"), F.lit(1).alias("den"))
    return ratio(num.unionByName(den), "n_name", F.col("num").cast("bigint"), F.col("den").cast("bigint"),
                 total_label="NETWORK TOTAL")


# ---------------------------------------------------------------- D11
_RUN = dt.date(2001, 6, 1)
_LB = _RUN - dt.timedelta(days=211)


def _fl_sql(where: str) -> str:
    return f"""r AS (SELECT o_custkey AS patient, o_orderdate AS result_date, o_orderkey AS result_id,
                  round(o_totalprice / 40000, 1) AS result FROM orders WHERE {where}),
o AS (SELECT *, row_number() OVER (PARTITION BY patient ORDER BY result_date, result_id) AS rf,
             row_number() OVER (PARTITION BY patient ORDER BY result_date DESC, result_id DESC) AS rl,
             count(*) OVER (PARTITION BY patient) AS n FROM r),
fl AS (SELECT f.patient, f.result AS first_value, l.result AS last_value, f.n AS n_results,
              date_diff('day', f.result_date, l.result_date) AS span_days, f.result - l.result AS drop_
       FROM o f JOIN o l ON f.patient = l.patient AND f.rf = 1 AND l.rl = 1)"""


_IMPROVED = """CASE WHEN n_results > 1 AND span_days >= 335 AND (
      (first_value > 10 AND round(drop_ * 100) >= 200) OR (first_value >= 8 AND first_value <= 10 AND round(drop_ * 100) >= 100)
      OR (first_value < 8 AND round(drop_ * 100) >= 50)) THEN 1 ELSE 0 END"""


@query("chronic_panel", f"""
WITH reg AS (SELECT a.*, n_name FROM ({AFFILIATES_SQL}) a JOIN nation ON c_nationkey = n_nationkey
             WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')),
lb AS (SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{_LB}' AND o_orderdate < TIMESTAMP '{_RUN}'),
flags AS (SELECT c_custkey, n_name, age,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM lb) THEN 1 ELSE 0 END AS covered,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM lb WHERE o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END AS exam_a,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM lb WHERE o_orderstatus = 'F') THEN 1 ELSE 0 END AS exam_b,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM lb WHERE o_totalprice > 300000) THEN 1 ELSE 0 END AS exam_c
  FROM reg),
{_fl_sql(f"o_orderdate < TIMESTAMP '{_RUN}'")},
comp AS (SELECT patient, CASE WHEN (age < 65 AND round(last_value * 100) <= 700) OR (age >= 65 AND round(last_value * 100) <= 800)
                  THEN 1 ELSE {_IMPROVED} END AS compensated FROM fl JOIN reg ON c_custkey = patient)
SELECT CASE WHEN grouping(n_name) = 1 THEN 'NETWORK TOTAL' ELSE n_name END AS n_name,
  CAST(count(*) AS BIGINT) AS n_registered, CAST(sum(covered) AS BIGINT) AS n_covered,
  CAST(sum(CASE WHEN exam_a = 1 AND exam_b = 1 AND exam_c = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_screened,
  CAST(count(comp.patient) AS BIGINT) AS n_with_result, CAST(coalesce(sum(compensated), 0) AS BIGINT) AS n_compensated
FROM flags LEFT JOIN comp ON patient = c_custkey GROUP BY GROUPING SETS ((n_name), ())
""")
def chronic_panel(t):
    """Register -> coverage in the strict 211-day lookback -> screening
    flags (all-of) -> last results and compensation -> per-site totals and
    the network row."""
    reg = _with_site(affiliates(t.customer), t).filter(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"))
    reg = reg.select("c_custkey", "n_name", "age")
    lb = t.orders.filter(in_range("o_orderdate", _LB, _RUN, lo_inclusive=False))
    reg = flags_in(reg, lb, "c_custkey", right_on="o_custkey", flags={
        "covered": F.lit(True), "exam_a": F.col("o_orderpriority") == "1-URGENT", "exam_b": F.col("o_orderstatus") == "F",
        "exam_c": F.col("o_totalprice") > 300000})
    res = t.orders.filter(F.col("o_orderdate") < F.lit(_ts(_RUN.year, _RUN.month, _RUN.day))).select(
        F.col("o_custkey").alias("patient"), F.col("o_orderdate").alias("result_date"),
        F.col("o_orderkey").alias("result_id"), F.round(F.col("o_totalprice") / 40000, 1).alias("result"))
    comp = compensation(res, reg.select(F.col("c_custkey").alias("patient"), "age")).select(
        "patient", "compensated")
    j = enrich(reg, comp, "c_custkey", right_on="patient").withColumn(
        "screened", all_of("exam_a", "exam_b", "exam_c")).withColumn("has_result", F.col("compensated").isNotNull())
    aggs = [F.count(F.lit(1)).alias("n_registered"), F.sum("covered").cast("bigint").alias("n_covered"),
            F.sum("screened").cast("bigint").alias("n_screened"),
            F.count_if("has_result").alias("n_with_result"),
            F.coalesce(F.sum("compensated"), F.lit(0)).cast("bigint").alias("n_compensated")]
    return grouped_with_total(j, ["n_name"], aggs, "NETWORK TOTAL")


# ---------------------------------------------------------------- D13
# Labels of unmatched rows.
_NO_TARIFF, _OTHER_SITE, _OTHER_DX = "SIN TARIFA", "OTRA SEDE", "OTRAS PATOLOGIAS"
_CONDITIONS = {"1-URGENT": "AGUDO", "2-HIGH": "AGUDO", "5-LOW": "CRONICO"}


@query("invoice_enrichment", f"""
WITH l0 AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber DESC, l_suppkey DESC, l_quantity DESC,
              l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS rn FROM lineitem),
l AS (SELECT *, CASE WHEN l_orderkey % 7 = 0 THEN -l_partkey ELSE l_partkey END AS code FROM l0 WHERE rn = 1),
al AS (SELECT l_orderkey, l_partkey, CAST(sum(CASE WHEN l_discount > 0.05 THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS allergen_total
       FROM lineitem GROUP BY 1, 2),
au AS (SELECT l_orderkey, l_partkey, l_suppkey, max(l_tax) AS authorized FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2, 3),
st AS (SELECT s_suppkey, s_nationkey, max(CASE WHEN s_acctbal > 5000 THEN 2 WHEN s_acctbal > 0 THEN 1 END) AS lvl FROM supplier GROUP BY 1, 2),
pop AS (SELECT c_nationkey, CAST(count(*) AS BIGINT) AS population FROM customer GROUP BY 1),
bud AS (SELECT c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(count(*) AS BIGINT) AS budget
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
  CASE WHEN l.l_suppkey IN (1, 2, 3) AND p_retailprice IS NULL THEN 0.0 ELSE p_retailprice END AS tariff,
  CASE WHEN l.l_suppkey IN (1, 2, 3) AND p_brand IS NULL THEN '{_NO_TARIFF}' ELSE p_brand END AS section,
  CAST(p_size AS BIGINT) AS cost, coalesce(p_type, '{_OTHER_DX}') AS diagnosis, o_orderpriority,
  coalesce(n_name, '{_OTHER_SITE}') AS n_name, population, bud.budget, al.allergen_total, au.authorized,
  CASE WHEN st.lvl = 2 THEN 'ACTIVO' WHEN st.lvl = 1 THEN 'INACTIVO' ELSE 'EXTERNO' END AS prof_status,
  s_nationkey = c.c_nationkey AS home_site,
  CASE WHEN c_acctbal > 5000 THEN 'SI' ELSE 'NO' END AS attended, CASE WHEN c_acctbal < 0 THEN 'ALTO' ELSE 'BAJO' END AS risk,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'AGUDO' WHEN '2-HIGH' THEN 'AGUDO' WHEN '5-LOW' THEN 'CRONICO' ELSE 'SIN CONDICION' END AS condition
FROM l JOIN orders ON l.l_orderkey = o_orderkey LEFT JOIN part ON l.code = p_partkey
LEFT JOIN al ON l.l_orderkey = al.l_orderkey AND l.l_partkey = al.l_partkey
LEFT JOIN au ON l.l_orderkey = au.l_orderkey AND l.l_partkey = au.l_partkey AND l.l_suppkey = au.l_suppkey
LEFT JOIN customer c ON o_custkey = c_custkey LEFT JOIN nation ON c.c_nationkey = n_nationkey
LEFT JOIN pop ON pop.c_nationkey = c.c_nationkey LEFT JOIN st ON l.l_suppkey = s_suppkey
LEFT JOIN bud ON bud.c_nationkey = c.c_nationkey AND bud.month = CAST(date_trunc('month', o_orderdate) AS DATE)
""")
def invoice_enrichment(t):
    """D13 in full: invoice lines, deduped first on (order, code) (W4), with
    order-and-code allergen totals, 3-key authorizations, tariff, section,
    cost and diagnosis from one catalog join (J3, J15, J17), encounter (J4),
    patient site, attended and risk from one affiliate join (J16, J17), site
    population, (site, month) budget (J2), professional state and home site
    (J18) and health condition (J14 label).

    What depends on an order's lines alone (the dedupe, both totals) is taken
    in windows over one shuffle by order and code; every other side has one
    row per key. The sides of 25 sites are small by nature; the (site, month)
    budget is left to the planner."""
    from pyspark.sql import Window
    w = Window.partitionBy("l_orderkey", "l_partkey")
    own = Window.partitionBy("l_orderkey", "l_partkey", "l_suppkey")
    last = [F.col(c).desc() for c in ("l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                      "l_returnflag", "l_linestatus", "l_shipdate")]
    li = t.lineitem.withColumns({
        "allergen_total": F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity").cast("bigint"))).over(w),
        "authorized": F.max(F.when(F.col("l_returnflag") == "A", F.col("l_tax"))).over(own),
        "rn": F.row_number().over(w.orderBy(*last))}).filter("rn = 1")
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "allergen_total", "authorized",
                   F.when(F.col("l_orderkey") % 7 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("code"))
    cat = t.part.select("p_partkey", F.col("p_retailprice").alias("tariff"), F.col("p_brand").alias("section"),
                        F.col("p_size").cast("bigint").alias("cost"), F.col("p_type").alias("diagnosis"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", F.trunc(F.to_date("o_orderdate"), "MM").alias("month"))
    c = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") > 5000, "SI").otherwise("NO").alias("attended"),
                          F.when(F.col("c_acctbal") < 0, "ALTO").otherwise("BAJO").alias("risk"))
    o = enrich(o, c, "o_custkey", right_on="c_custkey").withColumn("attended", F.coalesce("attended", F.lit("NO")))
    bud = o.filter("c_nationkey IS NOT NULL").groupBy(F.col("c_nationkey").alias("bs"), F.col("month").alias("bm")).agg(
        F.count(F.lit(1)).alias("budget"))
    o = enrich(o, bud, ["c_nationkey", "month"], right_on=["bs", "bm"])
    j = enrich(li, o, "l_orderkey", right_on="o_orderkey", how="inner")
    j = enrich(j, cat, "code", right_on="p_partkey")
    j = fill_for_codes(j, "l_suppkey", [1, 2, 3], {"tariff": 0.0, "section": _NO_TARIFF})
    sites = enrich(_sites(t), t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("population")),
                   "n_nationkey", right_on="k")
    j = enrich(j, broadcast_small(sites, rows_of=t.nation), "c_nationkey", right_on="n_nationkey", defaults={"n_name": _OTHER_SITE})
    prof = status_by_priority(t.supplier.select("s_suppkey", "s_nationkey"), t.supplier.select("s_suppkey", "s_acctbal"), "s_suppkey",
                              [StatusRule("ACTIVO", F.col("s_acctbal") > 5000), StatusRule("INACTIVO", F.col("s_acctbal") > 0)],
                              "EXTERNO", name="prof_status")
    j = enrich(j, prof, "l_suppkey", right_on="s_suppkey", defaults={"prof_status": "EXTERNO"})
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "tariff", "section", "cost",
                    F.coalesce("diagnosis", F.lit(_OTHER_DX)).alias("diagnosis"), "o_orderpriority", "n_name", "population",
                    "budget", "allergen_total", "authorized", "prof_status", (F.col("s_nationkey") == F.col("c_nationkey")).alias("home_site"),
                    "attended", "risk", label("o_orderpriority", _CONDITIONS, default="SIN CONDICION").alias("condition"))


# ---------------------------------------------------------------- D18
_REV_SQL = """SELECT r_name AS site, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
  CAST(round(sum(l_extendedprice)) AS BIGINT) AS v, CAST(round(sum(l_extendedprice * l_discount)) AS BIGINT) AS d
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3"""


@query("budget_compliance", f"""
WITH rev AS ({_REV_SQL}),
sheet AS (SELECT site, y, m, 'INGRESOS NETOS' AS item, replace(format('{{:,}}', v), ',', '.') AS txt FROM rev
          UNION ALL SELECT site, y, m, 'DESCUENTOS', replace(format('{{:,}}', d), ',', '.') FROM rev),
net AS (SELECT site, y, m, CAST(TRY_CAST(replace(txt, '.', '') AS DOUBLE) AS BIGINT) AS actual FROM sheet
        WHERE item = 'INGRESOS NETOS'),
cmp AS (SELECT a.site, a.y, a.m, a.actual, b.actual AS budget FROM net a JOIN net b
        ON a.site = b.site AND a.m = b.m AND a.y = b.y + 1),
tot AS (SELECT 'RED SIN ASIA' AS site, y, m, CAST(sum(actual) AS BIGINT) AS actual, CAST(sum(budget) AS BIGINT) AS budget
        FROM cmp WHERE site <> 'ASIA' GROUP BY y, m)
SELECT site, y, m, actual, budget, round(actual::DOUBLE / budget, 4) AS compliance FROM (
  SELECT * FROM cmp UNION ALL SELECT * FROM tot) z
""")
def budget_compliance(t):
    """Per-site revenue sheets (text with dot thousands) are unioned
    with an item tag, the net-income rows parsed, compared with the same
    month of the previous year (suffixed self join), and a network total
    excluding one site is appended."""
    li = enrich(t.lineitem.select("l_orderkey", "l_shipdate", "l_extendedprice", "l_discount"),
                t.orders.select("o_orderkey", "o_custkey"), "l_orderkey", right_on="o_orderkey", how="inner")
    li = enrich(li, t.customer.select("c_custkey", "c_nationkey"), "o_custkey", right_on="c_custkey", how="inner")
    li = enrich(li, t.nation.select("n_nationkey", "n_regionkey"), "c_nationkey", right_on="n_nationkey",
                how="inner", small=True)
    li = enrich(li, t.region.select("r_regionkey", F.col("r_name").alias("site")), "n_regionkey",
                right_on="r_regionkey", how="inner", small=True)
    rev = li.groupBy("site", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m")).agg(
        F.round(F.sum("l_extendedprice")).cast("bigint").alias("v"),
        F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount"))).cast("bigint").alias("d"))

    def txt(c):
        return F.replace(F.format_number(F.col(c), 0), F.lit(","), F.lit("."))
    sheet = union_tagged({"INGRESOS NETOS": rev.select("site", "y", "m", txt("v").alias("txt")),
                          "DESCUENTOS": rev.select("site", "y", "m", txt("d").alias("txt"))}, "item")
    net = sheet.filter(F.col("item") == "INGRESOS NETOS").select(
        "site", "y", "m", C.locale_number("txt", as_int=True).alias("v"))
    # A month is its own year's actual and the next year's budget; sites of the
    # network row are counted for it as well. The revenue is aggregated once.
    both = F.explode(F.array(F.struct(F.col("y").alias("y"), F.col("v").alias("actual"), F.lit(None).cast("bigint").alias("budget")),
                             F.struct((F.col("y") + 1).alias("y"), F.lit(None).cast("bigint").alias("actual"), F.col("v").alias("budget"))))
    cmp = net.select("site", "m", both.alias("x")).groupBy("site", F.col("x.y").alias("y"), "m").agg(
        F.max("x.actual").alias("actual"), F.max("x.budget").alias("budget")).filter("actual IS NOT NULL AND budget IS NOT NULL")
    rows = F.when(F.col("site") == "ASIA", F.array("site")).otherwise(F.array(F.col("site"), F.lit("RED SIN ASIA")))
    out = cmp.select(F.explode(rows).alias("site"), "y", "m", "actual", "budget").groupBy("site", "y", "m").agg(
        F.sum("actual").alias("actual"), F.sum("budget").alias("budget"))
    return out.withColumn("compliance", F.round(F.try_divide(F.col("actual").cast("double"), F.col("budget")), 4))


# ---------------------------------------------------------------- D19
@query("referral_panel", f"""
WITH a AS (SELECT x.*, n_name FROM ({AFFILIATES_SQL}) x JOIN nation ON c_nationkey = n_nationkey),
u AS (SELECT n_name, 1 AS is_ref, o_custkey AS pat, date_trunc('month', o_orderdate) AS mon,
             CASE WHEN sex = 'F' THEN o_custkey END AS woman, 0 AS pop
      FROM orders JOIN a ON o_custkey = c_custkey
      WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'
      UNION ALL SELECT n_name, 0, NULL, NULL, NULL, 1 FROM a)
SELECT CASE WHEN grouping(n_name) = 1 THEN 'NETWORK TOTAL' ELSE n_name END AS n_name,
  CAST(sum(is_ref) AS BIGINT) AS n_referrals, CAST(count(DISTINCT (pat, mon)) FILTER (WHERE pat IS NOT NULL) AS BIGINT) AS n_patient_months,
  CAST(count(DISTINCT woman) AS BIGINT) AS n_women, CAST(sum(pop) AS BIGINT) AS population
FROM u GROUP BY GROUPING SETS ((n_name), ())
""")
def referral_panel(t):
    """Referrals, distinct patient-months (A10), women referred and the
    population per site plus the network row, whose distinct counts come
    from the sites' bitmaps."""
    from carelake.operators.aggregate import distinct_with_total
    a = _with_site(affiliates(t.customer), t).select("c_custkey", "sex", "n_name")
    r = t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") &
                        in_range("o_orderdate", _ts(2000, 1, 1), _ts(2001, 1, 1)))
    r = enrich(r.select("o_custkey", "o_orderdate"), a, "o_custkey", right_on="c_custkey", how="inner").select(
        "n_name", F.lit(1).alias("is_ref"), F.col("o_custkey").alias("pat"),
        F.trunc(F.to_date("o_orderdate"), "MM").alias("mon"),
        F.when(F.col("sex") == "F", F.col("o_custkey")).alias("woman"), F.lit(0).alias("pop"))
    p = a.select("n_name", F.lit(0).alias("is_ref"), F.lit(None).cast("bigint").alias("pat"),
                 F.lit(None).cast("date").alias("mon"), F.lit(None).cast("bigint").alias("woman"), F.lit(1).alias("pop"))
    u = r.unionByName(p)
    # a patient-month as one number, so that a bitmap can hold it (24 * 12 months a century, 4096 leave room)
    u = u.withColumn("pat_mon", F.col("pat") * 4096 + F.months_between("mon", F.lit(dt.date(1970, 1, 1))).cast("bigint"))
    return distinct_with_total(u, "n_name", {"n_patient_months": "pat_mon", "n_women": "woman"},
                               {"n_referrals": "is_ref", "population": "pop"}, "NETWORK TOTAL")


@query("maternal_referrals", f"""
WITH a AS (SELECT x.*, n_name FROM ({AFFILIATES_SQL}) x JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT n_name, CAST(count(*) AS BIGINT) AS maternal FROM a WHERE sex = 'F' AND age BETWEEN 10 AND 49 GROUP BY 1),
r AS (SELECT n_name, CAST(count(*) AS BIGINT) AS n_referrals, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_women,
        CAST(sum(CASE WHEN s_nationkey = c_nationkey THEN 1 ELSE 0 END) AS BIGINT) AS n_home,
        CAST(sum(CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END) AS BIGINT) AS n_active
      FROM (SELECT o_custkey, o_orderpriority, 1 + o_custkey % top AS prof FROM orders, (SELECT max(s_suppkey) AS top FROM supplier) mx) o
      JOIN a ON o_custkey = c_custkey JOIN supplier ON s_suppkey = prof
      WHERE sex = 'F' AND age BETWEEN 10 AND 49 AND o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1),
j AS (SELECT m.n_name, maternal, coalesce(n_referrals, 0) AS n_referrals, coalesce(n_women, 0) AS n_women,
        coalesce(n_home, 0) AS n_home, coalesce(n_active, 0) AS n_active FROM m LEFT JOIN r ON m.n_name = r.n_name)
SELECT * FROM j UNION ALL SELECT 'NETWORK TOTAL', CAST(sum(maternal) AS BIGINT), CAST(sum(n_referrals) AS BIGINT), CAST(sum(n_women) AS BIGINT),
  CAST(sum(n_home) AS BIGINT), CAST(sum(n_active) AS BIGINT) FROM j
""")
def maternal_referrals(t):
    """Referrals of women aged 10-49 with the maternal population of each
    site and its total (A5), the professional's state and home site (J18)."""
    from carelake.operators.aggregate import with_total_row
    a = _with_site(affiliates(t.customer), t).filter((F.col("sex") == "F") & F.col("age").between(10, 49))
    a = a.select("c_custkey", "c_nationkey", "n_name")
    top = t.supplier.agg(F.max("s_suppkey").alias("top"))
    o = t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_custkey")
    o = broadcast_scalar(o, top).select("o_custkey", (F.col("o_custkey") % F.col("top") + 1).alias("prof"))
    o = enrich(o, a, "o_custkey", right_on="c_custkey", how="inner")
    prof = status_by_priority(t.supplier.select("s_suppkey", "s_nationkey"), t.supplier.select("s_suppkey", "s_acctbal"), "s_suppkey",
                              [StatusRule("ACTIVO", F.col("s_acctbal") > 5000)], "OTRO", name="state")
    o = enrich(o, prof, "prof", right_on="s_suppkey", how="inner")
    r = o.groupBy(F.col("n_name").alias("rn")).agg(
        F.count(F.lit(1)).alias("n_referrals"), F.count_distinct("o_custkey").alias("n_women"),
        F.count_if(F.col("s_nationkey") == F.col("c_nationkey")).alias("n_home"), F.count_if(F.col("state") == "ACTIVO").alias("n_active"))
    m = a.groupBy("n_name").agg(F.count(F.lit(1)).alias("maternal"))
    j = enrich(m, r, "n_name", right_on="rn", defaults={c: 0 for c in ("n_referrals", "n_women", "n_home", "n_active")})
    return with_total_row(j, ["n_name"], ["maternal", "n_referrals", "n_women", "n_home", "n_active"], "NETWORK TOTAL", "n_name")


@query("encounter_audit_load", f"""
WITH enc AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, {VISIT_SQL} AS visit_type FROM orders
  WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-03-01'),
d AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, day, visit_type ORDER BY o_orderkey) AS rn,
       day < DATE '2001-02-10' AS before FROM enc),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, day, visit_type ORDER BY o_orderkey) AS r2 FROM d WHERE before) x WHERE r2 = 1),
feb AS (SELECT * FROM d WHERE rn = 1 AND day >= DATE '2001-02-01'),
pop AS (SELECT c_nationkey, CAST(count(*) AS BIGINT) AS population FROM customer GROUP BY 1),
rows AS (SELECT o_orderkey, o_custkey, day, visit_type FROM first
  UNION ALL SELECT o_orderkey, o_custkey, day, visit_type FROM feb
  WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.o_custkey = feb.o_custkey AND f.day = feb.day AND f.visit_type = feb.visit_type))
SELECT o_orderkey, day, visit_type, population, DATE '2001-03-15' AS period FROM rows JOIN customer ON o_custkey = c_custkey
JOIN pop ON pop.c_nationkey = customer.c_nationkey
""")
def encounter_audit_load(t):
    """D7 as a load: February's encounters, deduped in the batch and against the
    recent target rows by (patient, day, type) (G6, G8), appended (K1); the
    population of the last month that has one is used for March (G10)."""
    from carelake.sinks.gates import fallback_period, new_rows
    from carelake.sinks.tables import append, overwrite
    from carelake.session import work_dir
    spark = t.orders.sparkSession
    path = work_dir(spark, "audit") + "/table"
    key = ["o_custkey", "day", "visit_type"]
    enc = t.orders.filter(in_range("o_orderdate", _ts(2001, 1, 1), _ts(2001, 3, 1))).select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), visit_type().alias("visit_type"))
    overwrite(dedupe(enc.filter(F.col("day") < F.lit(dt.date(2001, 2, 10))), key, order="o_orderkey"), path)
    feb = dedupe(enc.filter(F.col("day") >= F.lit(dt.date(2001, 2, 1))), key, order="o_orderkey")
    append(new_rows(feb, spark.read.parquet(path), key, since=dt.date(2001, 2, 1), since_col="day").checkpoint(eager=True), path)
    months = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("population"))
    months = months.withColumn("period", F.lit(dt.date(2001, 1, 15))).unionByName(months.selectExpr(
        "c_nationkey", "population * 0 AS population", "DATE '2000-12-15' AS period"))
    pop = fallback_period(months, "period", dt.date(2001, 3, 15))
    out = enrich(spark.read.parquet(path), t.customer.select("c_custkey", "c_nationkey"), "o_custkey", right_on="c_custkey", how="inner")
    return enrich(out, pop, "c_nationkey", how="inner").select("o_orderkey", "day", "visit_type", "population", "period")


@query("audit_form_discards", """
SELECT o_orderstatus AS form, CAST(count(*) FILTER (o_orderkey % 50 <> 0) AS BIGINT) AS kept,
       CAST(count(*) FILTER (o_orderkey % 50 = 0) AS BIGINT) AS removed FROM orders GROUP BY 1
""")
def audit_form_discards(t):
    """Rows kept and removed as blank per form."""
    k = F.col("o_orderkey")
    f = t.orders.select(F.col("o_orderstatus").alias("form"), F.when(k % 50 != 0, F.col("o_orderpriority")).alias("pregunta"),
                        F.when(k % 50 == 0, F.lit("  ")).otherwise("5").alias("calificacion"))
    return FL.blank_row_counts(f, ["pregunta", "calificacion"], by="form")


# ---------------------------------------------------------------- D6
@query("family_planning", f"""
WITH w AS (SELECT c_custkey, age FROM ({AFFILIATES_SQL}) a WHERE sex = 'F' AND age BETWEEN 14 AND 49),
f AS (SELECT c_custkey, age,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END AS f_urgent,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2000) THEN 1 ELSE 0 END AS f_2000,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 400000) THEN 1 ELSE 0 END AS f_open,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P') THEN 1 ELSE 0 END AS f_low
  FROM w)
SELECT f.*, lc.last_control FROM f
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_control FROM orders WHERE o_orderpriority = '3-MEDIUM' GROUP BY 1) lc
ON lc.o_custkey = f.c_custkey
WHERE NOT coalesce(age >= 18 AND f_urgent = 0 AND f_2000 = 0 AND f_open = 0 AND f_low = 0, FALSE)
""")
def family_planning(t):
    """Women 14-49, four risk flags (J8), last control date (J12), adults
    with no flag excluded (F16)."""
    w = affiliates(t.customer).filter((F.col("sex") == "F") & F.col("age").between(14, 49)).select("c_custkey", "age")
    o = t.orders
    w = flags_in(w, o, "c_custkey", right_on="o_custkey", flags={
        "f_urgent": F.col("o_orderpriority") == "1-URGENT", "f_2000": F.year("o_orderdate") == 2000,
        "f_open": (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 400000),
        "f_low": (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")},
        latest={"last_control": ("o_orderdate", F.col("o_orderpriority") == "3-MEDIUM")})
    return FL.wide_exclusion(w, ["f_urgent", "f_2000", "f_open", "f_low"], when=F.col("age") >= 18)


# ---------------------------------------------------------------- D14
@query("allergen_totals", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) + 14 AS period,
       regexp_replace(CAST(l_partkey AS VARCHAR) || '.0', '\\.0$', '') AS code,
       round(sum(l_extendedprice), 2) AS total
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01' AND l_shipdate < TIMESTAMP '2001-02-01' GROUP BY 1, 2
""")
def allergen_totals(t):
    """Codes cleaned of '.0', mid-month period key, order totals for the period."""
    li = t.lineitem.filter(in_range("l_shipdate", _ts(2001, 1, 1), _ts(2001, 2, 1)))
    li = li.select(mid_month("l_shipdate").alias("period"),
                   C.strip_dot_zero(F.concat(F.col("l_partkey").cast("string"), F.lit(".0"))).alias("code"),
                   "l_extendedprice")
    return li.groupBy("period", "code").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))


# ---------------------------------------------------------------- D15
@query("clinical_followup", """
WITH res AS (SELECT user_id, event_type, value FROM events WHERE event_type = 'purchase'
             UNION SELECT user_id, event_type, value FROM events WHERE event_type = 'view' AND value > 50),
contact AS (SELECT c_custkey, c_name FROM customer)
SELECT res.user_id, event_type, value, c_name FROM res JOIN contact ON res.user_id = contact.c_custkey
""")
def clinical_followup(t):
    """Single and panel results (distinct union) joined with patient contacts."""
    e = t.events
    res = union_distinct(e.filter(F.col("event_type") == "purchase").select("user_id", "event_type", "value"),
                         e.filter((F.col("event_type") == "view") & (F.col("value") > 50)).select(
                             "user_id", "event_type", "value"))
    contact = dedupe(t.customer.select("c_custkey", "c_name"))
    return enrich(res, contact, "user_id", right_on="c_custkey", how="inner")


# ---------------------------------------------------------------- D21
_DENTAL_RUN = dt.date(2001, 6, 1)
_DENTAL_LO = _DENTAL_RUN - dt.timedelta(days=152)


@query("dental_control", f"""
WITH ids AS (SELECT o_orderkey, o_orderdate,
   CASE WHEN o_orderkey % 17 = 0 THEN 'P1-x-000-' ELSE 'P1-x-' || CAST(o_custkey AS VARCHAR) || '-' END
   || strftime(o_orderdate, '%Y-%m-%d') AS id FROM orders
   WHERE o_orderdate >= TIMESTAMP '{_DENTAL_LO}' AND o_orderdate < TIMESTAMP '{_DENTAL_RUN}'),
p AS (SELECT string_split(id, '-')[3] AS patient,
             string_split(id, '-')[4] || '-' || string_split(id, '-')[5] || '-' || string_split(id, '-')[6] AS visit_day
      FROM ids),
v AS (SELECT patient, CAST(count(DISTINCT visit_day) AS BIGINT) AS visit_days FROM p
      WHERE patient IS NOT NULL AND trim(patient) NOT IN ('', '0', '00', '000', 'noencontrado') GROUP BY 1)
SELECT v.patient, v.visit_days, c.c_name FROM v LEFT JOIN customer c ON v.patient = CAST(c.c_custkey AS VARCHAR)
""")
def dental_control(t):
    """Composed visit ids split into patient and day (P13), placeholder
    ids dropped (F15), distinct visit days in the lookback (A10), names (J1)."""
    o = t.orders.filter(in_range("o_orderdate", _DENTAL_LO, _DENTAL_RUN))
    pid = F.when(F.col("o_orderkey") % 17 == 0, F.lit("P1-x-000-")).otherwise(
        F.concat(F.lit("P1-x-"), F.col("o_custkey").cast("string"), F.lit("-")))
    ids = o.select(F.concat(pid, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("id"))
    p = split_key(ids, "id", "-", {2: "patient", 3: "y", 4: "m", 5: "d"}).select(
        "patient", F.concat_ws("-", "y", "m", "d").alias("visit_day"))
    p = FL.drop_sentinels(p, "patient")
    v = p.groupBy("patient").agg(F.count_distinct("visit_day").alias("visit_days"))
    names = t.customer.select(F.col("c_custkey").cast("string").alias("ck"), "c_name")
    return enrich(v, names, "patient", right_on="ck")


# ---------------------------------------------------------------- D10
@query("diagnosis_enrichment", """
SELECT l_orderkey, l_linenumber, s_name AS professional, coalesce(p_type, 'OTRAS PATOLOGIAS') AS chapter,
       CASE WHEN s_nationkey IS NULL THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS prof_site
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN part p ON CASE WHEN l_orderkey % 9 = 0 THEN -l_partkey ELSE l_partkey END = p_partkey
WHERE l_shipdate >= TIMESTAMP '2001-02-01' AND l_shipdate < TIMESTAMP '2001-03-01'
""")
def diagnosis_enrichment(t):
    """month's encounters + professional (J3) + diagnosis catalog with
    a default chapter (J17) and null-literal cleanup (X10)."""
    from carelake.functions.dates import lagged_month
    lo, hi = lagged_month(dt.date(2001, 3, 10), 25)
    li = t.lineitem.filter(in_range("l_shipdate", lo, hi + dt.timedelta(days=1)))
    lost = F.when(F.col("l_orderkey") % 9 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    li = li.select("l_orderkey", "l_linenumber", "l_suppkey", lost.alias("l_partkey"))
    j = enrich(li, t.supplier.select("s_suppkey", F.col("s_name").alias("professional"), "s_nationkey"),
               "l_suppkey", right_on="s_suppkey")
    j = enrich(j, t.part.select("p_partkey", F.col("p_type").alias("chapter")),
               "l_partkey", right_on="p_partkey", defaults={"chapter": "OTRAS PATOLOGIAS"})
    return j.select("l_orderkey", "l_linenumber", "professional", "chapter",
                    C.null_literals(F.col("s_nationkey").cast("string"), "").alias("prof_site"))


# ---------------------------------------------------------------- D28
@query("message_matching", """
WITH inbox AS (SELECT conv_id, turn, role FROM conversations WHERE role = 'user'),
seen AS (SELECT conv_id, turn FROM conversations WHERE turn <= 1)
SELECT DISTINCT i.conv_id FROM inbox i
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.conv_id = i.conv_id AND s.turn = i.turn)
""")
def message_matching(t):
    """D28 (data part): unread messages by id anti-join, distinct threads."""
    c = t.conversations
    inbox = c.filter(F.col("role") == "user").select("conv_id", "turn")
    seen = c.filter(F.col("turn") <= 1).select("conv_id", "turn")
    from carelake.operators.lookup import anti
    return anti(inbox, seen, ["conv_id", "turn"]).select("conv_id").distinct()


# ---------------------------------------------------------------- W2 on results
@query("last_visit_per_patient", """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x
WHERE rn = 1
""")
def last_visit_per_patient(t):
    """The latest encounter row per patient (whole-row pick)."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return last_per(o, "o_custkey", ["o_orderdate", "o_orderkey"])


# ---------------------------------------------------------------- G13
@query("month_window_incremental", """
WITH batch AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-02-01' AND o_orderdate < TIMESTAMP '2001-03-01'),
log AS (SELECT o_orderdate AS fechaCargue, 'novedades' AS idBigquery FROM orders WHERE o_orderdate < TIMESTAMP '2001-03-01')
SELECT o_orderkey, o_custkey FROM batch
WHERE (SELECT count(*) FROM log WHERE idBigquery = 'novedades' AND fechaCargue >= TIMESTAMP '2001-03-01'
       AND fechaCargue < TIMESTAMP '2001-04-01') = 0
  AND NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderdate < TIMESTAMP '2001-02-15' AND t.o_orderkey = batch.o_orderkey)
""")
def month_window_incremental(t):
    """Previous month's novelties (F8 lag window), keyed dedupe (G5),
    loaded only when this month's gate is open (G2); the log holds loads of
    every earlier month."""
    return _novelties(t, dt.date(2001, 3, 10))


def _novelties(t, run):
    """The one-row gate is decided first: a closed one plans no extract at all."""
    from carelake.functions.dates import lagged_month
    from carelake.sinks.gates import gate, new_rows
    log = t.orders.filter(F.col("o_orderdate") < F.lit(_ts(2001, 3, 1))).select(
        F.col("o_orderdate").alias("fechaCargue"), F.lit("novedades").alias("idBigquery"))
    none = t.orders.sparkSession.createDataFrame([], t.orders.select("o_orderkey", "o_custkey").schema)
    if gate(log, "novedades", "monthly", run).first()["proceed"] != 1:
        return none
    lo, hi = lagged_month(run, 15)
    batch = t.orders.filter(in_range("o_orderdate", lo, hi + dt.timedelta(days=1))).select("o_orderkey", "o_custkey")
    return new_rows(batch, t.orders.filter(F.col("o_orderdate") < F.lit(_ts(2001, 2, 15))), "o_orderkey")


@query("month_window_closed", """
SELECT 'row' AS part, CAST(o_orderkey AS BIGINT) AS n FROM orders
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-02-01' AND o_orderdate < TIMESTAMP '2001-03-01')
UNION ALL SELECT 'loads of the month', CAST(count(*) AS BIGINT) FROM orders WHERE o_orderdate >= TIMESTAMP '2001-02-01' AND o_orderdate < TIMESTAMP '2001-03-01'
""")
def month_window_closed(t):
    """The log has a load of the run's month: nothing is extracted; the
    gate's own count of loads is the other row."""
    from carelake.sinks.gates import gate
    run = dt.date(2001, 2, 20)
    log = t.orders.filter(F.col("o_orderdate") < F.lit(_ts(2001, 3, 1))).select(
        F.col("o_orderdate").alias("fechaCargue"), F.lit("novedades").alias("idBigquery"))
    loads = gate(log, "novedades", "monthly", run).select(F.lit("loads of the month").alias("part"), F.col("totalCargues").cast("bigint").alias("n"))
    rows = _novelties(t, run).select(F.lit("row").alias("part"), F.col("o_orderkey").cast("bigint").alias("n"))
    return rows.unionByName(loads)


@query("sorted_report", """
SELECT n_name, CAST(count(*) AS BIGINT) AS n_customers, round(sum(c_acctbal), 2) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY balance DESC, n_name
""")
def sorted_report(t):
    """O1/O2: a report sorted on output (the only place a sort belongs)."""
    c = _with_site(t.customer, t)
    return c.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers"),
                                   F.round(F.sum("c_acctbal"), 2).alias("balance")).orderBy(F.desc("balance"), "n_name")


@query("tariff_correction_staged", """
WITH fix AS (SELECT l_orderkey, l_linenumber, l_partkey, max(l_extendedprice * 2) AS v FROM lineitem
             WHERE l_returnflag = 'R' GROUP BY 1, 2, 3)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CASE WHEN f.l_orderkey IS NOT NULL THEN f.v ELSE l.l_extendedprice END AS l_extendedprice
FROM lineitem l LEFT JOIN fix f ON l.l_orderkey = f.l_orderkey AND l.l_linenumber = f.l_linenumber AND l.l_partkey = f.l_partkey
""")
def tariff_correction_staged(t):
    """The correction list is staged as a temporary view of a name
    of its own, merged by its three keys (order, site order, code) into the
    invoice lines; the view is dropped once the merge is planned."""
    import uuid

    from carelake.sinks.tables import merge_update_df
    spark = t.lineitem.sparkSession
    view = f"stage_tariff_fix_{uuid.uuid4().hex[:12]}"
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    t.lineitem.filter(F.col("l_returnflag") == "R").groupBy(*keys).agg(
        F.max(F.col("l_extendedprice") * 2).alias("l_extendedprice")).createOrReplaceTempView(view)
    out = merge_update_df(t.lineitem.select(*keys, "l_extendedprice"), spark.table(view), keys, ["l_extendedprice"])
    spark.catalog.dropTempView(view)
    return out


@query("audit_forms", """
WITH f AS (SELECT 'consultas' AS form, CAST(o_orderkey AS VARCHAR) AS id,
             CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE o_orderpriority END AS pregunta,
             CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'n/a'
                  ELSE CAST(CAST(trunc(o_totalprice) AS BIGINT) % 100 AS VARCHAR) || ',5%' END AS calificacion
           FROM orders WHERE o_orderstatus = 'F'
           UNION ALL
           SELECT 'cirugia', CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), l_returnflag,
                  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '%'
           FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'R')
SELECT form, id, pregunta, TRY_CAST(replace(replace(calificacion, '%', ''), ',', '.') AS DOUBLE) / 100 AS calificacion
FROM f WHERE NOT ((pregunta IS NULL OR trim(pregunta) = '') AND (calificacion IS NULL OR trim(calificacion) = ''))
""")
def audit_forms(t):
    """Per-form extracts with their own headers are cleaned (P12),
    renamed with a checked map (P4), blank rows dropped (F12), percents
    parsed (X7), tagged and unioned (S11/U3)."""
    import warnings
    from carelake.functions.names import clean_headers, rename_with
    from carelake.operators.shape import rename_checked
    k = F.col("o_orderkey")
    a = t.orders.filter(F.col("o_orderstatus") == "F").select(
        k.cast("string").alias(" ID\n"),
        F.when(k % 50 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias('"Pregunta"'),
        F.when(k % 50 == 0, F.lit(None).cast("string")).when(k % 23 == 0, F.lit("n/a")).otherwise(
            F.concat((F.col("o_totalprice").cast("bigint") % 100).cast("string"), F.lit(",5%"))).alias("Calificación "))
    b = t.lineitem.filter((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "R")).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("ID"),
        F.col("l_returnflag").alias("Pregunta"),
        F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit("%")).alias("Calificación"))
    mapping = {"ID": "id", "Pregunta": "pregunta", "Calificación": "calificacion", "Observaciones": "obs"}
    parts = {}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for name, df in (("consultas", a), ("cirugia", b)):
            df, _missing = rename_checked(rename_with(df, clean_headers), mapping)
            df = FL.drop_blank_rows(df, ["pregunta", "calificacion"])
            parts[name] = df.withColumn("calificacion", C.percent("calificacion", "null"))
    return union_tagged(parts, "form").select("form", "id", "pregunta", "calificacion")
