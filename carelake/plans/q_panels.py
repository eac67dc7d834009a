"""Registered panels and loads: chronic-disease outputs (D11), dental
capitation detail (D20), authorization, collection and workforce loads
(D23, D25, D26). Each load goes landed file -> typed -> gated -> written ->
read back."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions import coerce as C
from carelake.functions.dates import fortnight, in_days, in_range, last_24h, mid_month
from carelake.functions.labels import bins
from carelake.operators.aggregate import conditional_sums, grouped_with_total, ratio
from carelake.operators.lookup import enrich, flags_in
from carelake.operators.sequence import dedupe
from carelake.operators.setops import union_tagged
from carelake.operators.shape import TableSpec, apply_spec, cast_all_but
from carelake.plans.chronic import compensation
from carelake.plans.registry import ORACLES, query
from carelake.plans.standins import AFFILIATES_SQL, affiliates
from carelake.session import work_dir
from carelake.sinks import gates as G
from carelake.sinks import tables as K
from carelake.sources import readers as R

TOTAL = "NETWORK TOTAL"
_RUN = dt.date(2001, 6, 1)
_LB = _RUN - dt.timedelta(days=211)

# ---------------------------------------------------------------- D11: registers
_HT_SQL = f"""SELECT a.*, n_name FROM ({AFFILIATES_SQL}) a JOIN nation ON c_nationkey = n_nationkey
  WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')"""
_LB_SQL = f"(SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{_LB}' AND o_orderdate < TIMESTAMP '{_RUN}')"


def _register(t):
    a = enrich(affiliates(t.customer), t.nation.select("n_nationkey", "n_name"), "c_nationkey", right_on="n_nationkey",
               how="inner", small=True)
    return a.filter(F.col("c_mktsegment").isin("BUILDING", "FURNITURE")).select("c_custkey", "c_name", "n_name", "age", "sex")


def _hypertension(t):
    """The register with coverage and nurse and doctor visits of the lookback, one aggregate of the encounters."""
    lb = t.orders.filter(in_range("o_orderdate", _LB, _RUN, lo_inclusive=False))
    nurse = F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")
    return flags_in(_register(t), lb, "c_custkey", right_on="o_custkey", flags={"covered": F.lit(True)},
                    counts={"n_nurse": nurse, "n_doctor": ~nurse}, latest={"last_visit": ("o_orderdate", None)})


@query("hypertension_register", f"""
WITH v AS (SELECT o_custkey, CAST(count(*) FILTER (o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')) AS BIGINT) AS n_nurse,
  CAST(count(*) FILTER (o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')) AS BIGINT) AS n_doctor, max(o_orderdate) AS last_visit
  FROM {_LB_SQL} lb GROUP BY 1)
SELECT c_custkey, c_name, n_name, age, sex, CASE WHEN o_custkey IS NULL THEN 0 ELSE 1 END AS covered,
  coalesce(n_nurse, 0) AS n_nurse, coalesce(n_doctor, 0) AS n_doctor, last_visit
FROM ({_HT_SQL}) r LEFT JOIN v ON o_custkey = c_custkey
""")
def hypertension_register(t):
    """D11 output: hypertension register with contacts, coverage in the strict
    211-day lookback, nurse and doctor visit counts (J11), last visit (J12)."""
    return _hypertension(t)


@query("hypertension_coverage", f"""
SELECT CASE WHEN grouping(n_name) = 1 THEN '{TOTAL}' ELSE n_name END AS n_name,
  CAST(sum(CASE WHEN c_custkey IN (SELECT o_custkey FROM {_LB_SQL} lb) THEN 1 ELSE 0 END) AS BIGINT) AS numerator,
  CAST(count(*) AS BIGINT) AS denominator,
  round(sum(CASE WHEN c_custkey IN (SELECT o_custkey FROM {_LB_SQL} lb) THEN 1 ELSE 0 END)::DOUBLE / count(*), 4) AS coverage
FROM ({_HT_SQL}) r GROUP BY GROUPING SETS ((n_name), ())
""")
def hypertension_coverage(t):
    """D11 output: covered over registered per site and network."""
    return _coverage(_hypertension(t))


def _coverage(reg):
    return ratio(reg, "n_name", F.col("covered").cast("bigint"), F.lit(1).cast("bigint"), "coverage", total_label=TOTAL)


@query("chronic_events", f"""
WITH e AS (SELECT r.n_name, CAST(l_quantity AS BIGINT) AS days, l_returnflag,
   r.c_custkey IN (SELECT o_custkey FROM {_LB_SQL} lb) AS covered
   FROM lineitem JOIN orders o ON l_orderkey = o.o_orderkey JOIN ({_HT_SQL}) r ON o.o_custkey = r.c_custkey WHERE l_returnflag IN ('R', 'A')),
g AS (SELECT n_name, {', '.join(f"CAST(coalesce(sum(CASE WHEN l_returnflag = '{f}' AND {c} THEN {m} END), 0) AS BIGINT) AS {k}_{n}_{x}"
                               for k, m in (('events', '1'), ('days', 'days')) for n, f in (('hospital', 'R'), ('urgent', 'A'))
                               for x, c in (('covered', 'covered'), ('uncovered', 'NOT covered')))}
  FROM e GROUP BY 1)
SELECT * FROM g UNION ALL SELECT '{TOTAL}', {', '.join(f'CAST(sum({k}_{n}_{x}) AS BIGINT)' for k in ('events', 'days') for n in ('hospital', 'urgent') for x in ('covered', 'uncovered'))} FROM g
""")
def chronic_events(t):
    """D11 output: hospital and urgent events and days of registered patients,
    split by coverage (A6), per site and network (A5)."""
    return _events(t, _hypertension(t))


def _events(t, reg):
    from carelake.operators.aggregate import with_total_row
    reg = reg.select("c_custkey", "n_name", "covered")
    o = enrich(t.orders.select("o_orderkey", "o_custkey"), reg, "o_custkey", right_on="c_custkey", how="inner")
    li = t.lineitem.filter(F.col("l_returnflag").isin("R", "A")).select("l_orderkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("days"))
    e = enrich(li, o.select("o_orderkey", "n_name", "covered"), "l_orderkey", right_on="o_orderkey", how="inner")
    preds = {f"{n}_{x}": (F.col("l_returnflag") == f) & (F.col("covered") == v)
             for n, f in (("hospital", "R"), ("urgent", "A")) for x, v in (("covered", 1), ("uncovered", 0))}
    g = conditional_sums(e, "n_name", {"events": F.lit(1).cast("bigint"), "days": F.col("days")}, preds)
    return with_total_row(g, ["n_name"], [c for c in g.columns if c != "n_name"], TOTAL, "n_name")


_FL_SQL = """r AS (SELECT o_custkey AS patient, o_orderdate AS result_date, o_orderkey AS result_id, round(o_totalprice / 40000, 1) AS result FROM orders),
o AS (SELECT *, row_number() OVER (PARTITION BY patient ORDER BY result_date, result_id) AS rf,
             row_number() OVER (PARTITION BY patient ORDER BY result_date DESC, result_id DESC) AS rl, count(*) OVER (PARTITION BY patient) AS n FROM r),
fl AS (SELECT f.patient, f.result AS first_value, l.result AS last_value, f.n AS n_results,
              date_diff('day', f.result_date, l.result_date) AS span_days, f.result - l.result AS drop_
       FROM o f JOIN o l ON f.patient = l.patient AND f.rf = 1 AND l.rl = 1),
comp AS (SELECT patient, CASE WHEN (age < 65 AND round(last_value * 100) <= 700) OR (age >= 65 AND round(last_value * 100) <= 800) THEN 1
   WHEN n_results > 1 AND span_days >= 335 AND ((first_value > 10 AND round(drop_ * 100) >= 200) OR
      (first_value >= 8 AND first_value <= 10 AND round(drop_ * 100) >= 100) OR (first_value < 8 AND round(drop_ * 100) >= 50)) THEN 1 ELSE 0 END AS compensated
   FROM fl JOIN reg ON patient = c_custkey)"""


@query("professional_followup", f"""
WITH reg AS ({_HT_SQL}), {_FL_SQL},
p AS (SELECT DISTINCT l_suppkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
g AS (SELECT s_name AS professional, CAST(count(*) AS BIGINT) AS n_patients, CAST(sum(compensated) AS BIGINT) AS n_compensated
      FROM p JOIN comp ON o_custkey = patient JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
t AS (SELECT * FROM g UNION ALL SELECT '{TOTAL}', CAST(coalesce(sum(n_patients), 0) AS BIGINT), CAST(coalesce(sum(n_compensated), 0) AS BIGINT) FROM g)
SELECT professional, n_patients, n_compensated, round(n_compensated::DOUBLE / n_patients, 4) AS share FROM t
""")
def professional_followup(t):
    """D11 output: per professional the registered patients seen and how many
    of them are compensated, with the total row."""
    from carelake.operators.aggregate import with_total_row
    res = t.orders.select(F.col("o_custkey").alias("patient"), F.col("o_orderdate").alias("result_date"),
                          F.col("o_orderkey").alias("result_id"), F.round(F.col("o_totalprice") / 40000, 1).alias("result"))
    comp = compensation(res, _register(t).select(F.col("c_custkey").alias("patient"), "age")).select("patient", "compensated")
    seen = enrich(t.lineitem.select("l_orderkey", "l_suppkey"), t.orders.select("o_orderkey", "o_custkey"), "l_orderkey",
                  right_on="o_orderkey", how="inner").select("l_suppkey", "o_custkey").distinct()
    j = enrich(seen, comp, "o_custkey", right_on="patient", how="inner")
    j = enrich(j, t.supplier.select("s_suppkey", F.col("s_name").alias("professional")), "l_suppkey", right_on="s_suppkey", how="inner")
    g = j.groupBy("professional").agg(F.count(F.lit(1)).alias("n_patients"), F.sum("compensated").cast("bigint").alias("n_compensated"))
    g = with_total_row(g, ["professional"], ["n_patients", "n_compensated"], TOTAL, "professional").fillna(0, ["n_patients", "n_compensated"])
    return g.withColumn("share", F.round(F.try_divide(F.col("n_compensated").cast("double"), F.col("n_patients")), 4))


# The panel's seven published tables, each with its key and the measures that are read back.
_PUBLISHED = {
    "chronic_panel": ("n_name", ("n_registered", "n_covered", "n_screened", "n_with_result", "n_compensated")),
    "compensation_status": ("patient", ("age", "n_results", "compensated")),
    "hypertension_register": ("c_custkey", ("age", "covered", "n_nurse", "n_doctor")),
    "hypertension_coverage": ("n_name", ("numerator", "denominator")),
    "chronic_events": ("n_name", tuple(f"{k}_{n}_{x}" for k in ("events", "days") for n in ("hospital", "urgent") for x in ("covered", "uncovered"))),
    "professional_followup": ("professional", ("n_patients", "n_compensated")),
    "site_register": ("n_name", ("n",)),
}
_SITES_SQL = f"SELECT n_name, CAST(count(*) AS BIGINT) AS n FROM ({_HT_SQL}) r GROUP BY 1"


def _published_sql() -> str:
    parts = []
    for name, (key, measures) in _PUBLISHED.items():
        sql = ORACLES.get(name, _SITES_SQL)
        total = " + ".join(f"coalesce({m}, 0) * {i}" for i, m in enumerate(measures, 1))
        parts.append(f"SELECT '{name}' AS item, CAST({key} AS VARCHAR) AS key, CAST({total} AS BIGINT) AS n FROM ({sql}) x")
        parts.append(f"SELECT 'loaded {name}', NULL, CAST(count(*) AS BIGINT) FROM ({sql}) x")
    return " UNION ALL ".join(parts)


@query("chronic_publish", _published_sql())
def chronic_publish(t):
    """D11 publish: the panel's seven outputs through the gated publisher, twice
    in the month (the second run finds every gate closed); each table read back
    by key with a weighted sum of its measures, and the first run's summary (K17).
    The register with its contacts is made once for the outputs that need it."""
    from carelake.plans.q_domain import chronic_panel
    from carelake.plans.q_sequences import compensation_status
    spark = t.customer.sparkSession
    base = work_dir(spark, "chronic")
    reg = _hypertension(t).checkpoint(eager=True)
    outputs = {
        "chronic_panel": chronic_panel(t), "compensation_status": compensation_status(t), "hypertension_register": reg,
        "hypertension_coverage": _coverage(reg), "chronic_events": _events(t, reg), "professional_followup": professional_followup(t),
        "site_register": reg.groupBy("n_name").agg(F.count(F.lit(1)).alias("n")),
    }
    specs = [K.PublishSpec(n, outputs[n].withColumn("period", F.lit("200106")), period_col="period") for n in _PUBLISHED]
    done = K.publish_all(specs, f"{base}/out", f"{base}/log", _RUN)
    K.publish_all(specs, f"{base}/out", f"{base}/log", _RUN + dt.timedelta(days=9))
    out = done.select(F.concat(F.lit("loaded "), "table").alias("item"), F.lit(None).cast("string").alias("key"), F.col("rows").alias("n"))
    for n, (key, measures) in _PUBLISHED.items():
        total = reduce(lambda a, b: a + b, [F.coalesce(F.col(m).cast("bigint"), F.lit(0)) * i for i, m in enumerate(measures, 1)])
        out = out.unionByName(spark.read.parquet(f"{base}/out/{n}").select(F.lit(n).alias("item"), F.col(key).cast("string").alias("key"), total.alias("n")))
    return out


# ---------------------------------------------------------------- D20
@query("dental_capitation", f"""
WITH d AS (SELECT * FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, 1 + o_custkey % (SELECT max(s_suppkey) FROM supplier) AS prof,
      CAST(date_trunc('month', o_orderdate) AS DATE) + 14 AS period,
      CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 90 AS INTEGER) END AS minutes,
      row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn FROM orders) x WHERE rn = 1),
h AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) + 14 AS period, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS hours
      FROM lineitem GROUP BY 1, 2),
roll AS (SELECT c_custkey, c_name, age, CASE WHEN c_custkey % 6 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS site FROM ({AFFILIATES_SQL}) a),
pop AS (SELECT coalesce(site, CAST(CAST(regexp_extract(c_name, '[0-9]+') AS BIGINT) % 25 AS VARCHAR)) AS site, CAST(count(*) AS BIGINT) AS population
        FROM roll GROUP BY 1)
SELECT o_orderkey, d.day, d.prof, d.period, minutes, h.hours, j.site, pop.population,
  CASE WHEN age >= 0 AND age <= 5 THEN '0-5' WHEN age > 5 AND age <= 17 THEN '6-17' WHEN age > 17 THEN '18+' END AS age_bin
FROM d LEFT JOIN h ON d.prof = h.l_suppkey AND d.period = h.period
LEFT JOIN (SELECT *, coalesce(site, CAST(CAST(regexp_extract(c_name, '[0-9]+') AS BIGINT) % 25 AS VARCHAR)) AS s2 FROM roll) r ON d.o_custkey = r.c_custkey
LEFT JOIN (SELECT c_custkey AS k, coalesce(site, CAST(CAST(regexp_extract(c_name, '[0-9]+') AS BIGINT) % 25 AS VARCHAR)) AS site FROM roll) j ON j.k = d.o_custkey
LEFT JOIN pop ON pop.site = j.site
""")
def dental_capitation(t):
    """Visit detail on a mid-month key, deduped per patient and day (W5);
    minutes from '0 days HH:MM:SS' text (X22), clinic hours by professional and
    period (J2), roll deduped by patient; the site code from the digits of
    the name where the roll has none (X23); population by site; age bins."""
    top = t.supplier.agg(F.max("s_suppkey").alias("top"))
    m = F.when(F.col("o_orderkey") % 5 != 0, F.format_string("0 days %02d:%02d:00", (F.col("o_orderkey") % 90 / 60).cast("int"),
                                                          (F.col("o_orderkey") % 90 % 60).cast("int"))).otherwise("no aplica")
    o = t.orders.crossJoin(F.broadcast(top)).select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), (F.col("o_custkey") % F.col("top") + 1).alias("prof"),
        mid_month("o_orderdate").alias("period"), m.alias("took"))
    d = dedupe(o, ["o_custkey", "day"], keep="first", order="o_orderkey")
    hh, mm = F.regexp_extract("took", r"(\d\d):(\d\d):", 1), F.regexp_extract("took", r"(\d\d):(\d\d):", 2)
    d = d.withColumn("minutes", F.when(hh != "", hh.cast("int") * 60 + mm.cast("int"))).drop("took")
    h = t.lineitem.groupBy(F.col("l_suppkey").alias("hp"), mid_month("l_shipdate").alias("hm")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("hours"))
    roll = affiliates(t.customer).select("c_custkey", bins("age", [0, 5, 17, float("inf")], ["0-5", "6-17", "18+"]).alias("age_bin"),
        F.coalesce(F.when(F.col("c_custkey") % 6 != 0, F.col("c_nationkey").cast("string")),
                   (F.regexp_extract("c_name", "[0-9]+", 0).cast("bigint") % 25).cast("string")).alias("site"))
    roll = dedupe(roll, "c_custkey", keep="first", order="site")
    pop = roll.groupBy(F.col("site").alias("ps")).agg(F.count(F.lit(1)).alias("population"))
    roll = enrich(roll, pop, "site", right_on="ps")
    j = enrich(enrich(d, h, ["prof", "period"], right_on=["hp", "hm"]), roll, "o_custkey", right_on="c_custkey")
    return j.select("o_orderkey", "day", "prof", "period", "minutes", "hours", "site", "population", "age_bin")


# ---------------------------------------------------------------- D25
_INVOICE = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("line", T.IntegerType()),
                         T.StructField("shipped", T.DateType()), T.StructField("price", T.DoubleType()),
                         T.StructField("period", T.StringType())])


@query("invoice_monthly_strict", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS INTEGER) AS line, CAST(l_shipdate AS DATE) AS shipped,
  CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_extendedprice END AS price, strftime(l_shipdate, '%Y%m') AS period FROM lineitem
WHERE strftime(l_shipdate, '%Y%m') = '200006'
UNION ALL
SELECT l_orderkey, CAST(l_linenumber AS INTEGER), CAST(l_shipdate AS DATE), l_extendedprice, strftime(l_shipdate, '%Y%m') FROM lineitem
WHERE strftime(l_shipdate, '%Y%m') <> '200006'
""")
def invoice_monthly_strict(t):
    """The month's invoice file, all text, is written with strict types
    (K11) in place of that period's partition (K6); other periods stay. Bad
    prices become NULL instead of ending the load."""
    spark = t.lineitem.sparkSession
    base = work_dir(spark, "invoice")
    li = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.to_date("l_shipdate").alias("shipped"),
                           F.col("l_extendedprice").alias("price"), F.date_format("l_shipdate", "yyyyMM").alias("period"))
    K.overwrite(li, f"{base}/table", partition_by="period")
    month = li.filter(F.col("shipped").between(F.lit(dt.date(2000, 6, 1)), F.lit(dt.date(2000, 6, 30))))
    bad = F.when(F.col("order_id") % 10 == 0, "s/d").otherwise(F.col("price").cast("string"))
    cast_all_but(month.withColumn("price", bad)).write.option("header", "true").csv(f"{base}/landing")
    raw = R.scan_csv(spark, f"{base}/landing", names=[f.name for f in _INVOICE], header=True)
    K.replace_period(apply_spec(raw, TableSpec(_INVOICE)), f"{base}/table", "period", "200006")
    return spark.read.schema(_INVOICE).parquet(f"{base}/table")


@query("invoice_fortnight", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE (o_orderdate >= TIMESTAMP '2001-02-16' AND o_orderdate < TIMESTAMP '2001-03-16')
""")
def invoice_fortnight(t):
    """Fortnight loads (F9): the run of the 1st takes 16..end of the month
    before, the run of the 16th takes 1..15, a run on another day takes
    nothing; a repeated run finds its rows there (G5)."""
    spark = t.orders.sparkSession
    path = work_dir(spark, "fortnight") + "/table"
    o = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    spark.createDataFrame([], o.schema).write.parquet(path)
    for run in (dt.date(2001, 3, 1), dt.date(2001, 3, 9), dt.date(2001, 3, 16), dt.date(2001, 3, 16)):
        days = fortnight(run)
        if days is None:
            continue
        batch = o.filter(in_days("o_orderdate", *days))
        known = spark.read.parquet(path).filter(in_days("o_orderdate", *days))
        K.append(G.new_rows(batch, known, "o_orderkey").checkpoint(eager=True), path)
    return spark.read.parquet(path)


@query("daily_collections_probe", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '2001-01-10' AND l_shipdate < TIMESTAMP '2001-01-13'
""")
def daily_collections_probe(t):
    """Daily loads guarded by a range probe of the target (G4): a day that
    is there is not loaded again."""
    spark = t.lineitem.sparkSession
    path = work_dir(spark, "collections") + "/table"
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate")
    spark.createDataFrame([], li.schema).write.parquet(path)
    for d in (10, 11, 11, 12, 10):
        lo = dt.datetime(2001, 1, d)
        there = G.range_probe(spark.read.parquet(path), "l_shipdate", lo, lo + dt.timedelta(hours=23, minutes=59)).first()[0]
        if not there:
            K.append(li.filter(in_range("l_shipdate", lo, lo + dt.timedelta(days=1))), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- D23
@query("authorizations_24h", """
SELECT event_id, user_id, ts, value, 'new' AS state FROM events WHERE ts >= TIMESTAMP '2024-01-20 06:00:00' AND ts < TIMESTAMP '2024-01-21 06:00:00'
UNION ALL
SELECT event_id, user_id, ts, value, 'old' FROM events WHERE ts < TIMESTAMP '2024-01-20 06:00:00'
""")
def authorizations_24h(t):
    """The last 24 hours are extracted again and replace what the table
    holds of them (K5); run twice, it holds the same."""
    spark = t.events.sparkSession
    path = work_dir(spark, "auth24") + "/table"
    e = t.events.select("event_id", "user_id", "ts", "value")
    now = dt.datetime(2024, 1, 21, 6)
    lo, hi = last_24h(now)
    K.overwrite(e.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 21))).withColumn("state", F.lit("old")), path)
    new = e.filter((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi))).withColumn("state", F.lit("new"))
    for _ in range(2):
        K.refresh_window(spark, path, new, "ts", lo)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- D26
@query("workforce_roster", """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS site, CASE WHEN s_suppkey % 2 = 0 THEN 'medicos' ELSE 'enfermeria' END AS sheet,
  CASE WHEN s_suppkey IN (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01') THEN 'SI' ELSE 'NO' END AS activo
FROM supplier
""")
def workforce_roster(t):
    """Role roster of two sheets (S11), all text (P17), marked with who is
    active by text id (G7 keys), truncated and reloaded (K2), read back."""
    from carelake.operators.lookup import match_marker
    spark = t.supplier.sparkSession
    path = work_dir(spark, "roster") + "/table"
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("site"))
    roster = union_tagged({"medicos": s.filter(F.col("id") % 2 == 0), "enfermeria": s.filter(F.col("id") % 2 != 0)}, "sheet")
    active = t.lineitem.filter(F.col("l_shipdate") >= F.lit(dt.datetime(2001, 1, 1))).select(F.col("l_suppkey").cast("string").alias("k"))
    roster = match_marker(cast_all_but(roster), active, "id", "activo", right_on="k")
    for _ in range(2):
        K.overwrite(roster, path)
    return spark.read.parquet(path)


@query("workforce_leave", """
SELECT event_id AS leave_id, CAST(ts AS DATE) AS starts,
  CASE event_id % 4 WHEN 0 THEN 0.0 WHEN 1 THEN 0.0 ELSE round(value, 2) END AS cost, CAST(event_id % 30 AS BIGINT) AS days
FROM events WHERE ts < TIMESTAMP '2024-01-21'
""")
def workforce_leave(t):
    """Leave records with cost as text ('1200.00', 'NaN', blank) coerced
    (X3, X10), dates parsed (X1), only new ids appended (G5) up to the run
    date, behind a weekly gate that the second run of the week finds closed."""
    spark = t.events.sparkSession
    base = work_dir(spark, "leave")
    k = F.col("event_id")
    cost = F.when(k % 4 == 0, "NaN").when(k % 4 == 1, "").otherwise(F.format_string("%.2f", F.round("value", 2)))
    (t.events.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 21)))
     .select(k.cast("string").alias("leave_id"), F.date_format("ts", "dd/MM/yyyy").alias("starts"), cost.alias("cost"),
             (k % 30).cast("string").alias("days")).write.option("sep", ";").csv(f"{base}/landing"))
    raw = R.scan_csv(spark, f"{base}/landing", names=["leave_id", "starts", "cost", "days"], sep=";")
    typed = raw.select(C.coerce_int("leave_id").alias("leave_id"), C.coerce_date("starts", "dd/MM/yyyy").alias("starts"),
                       C.coerce_float("cost").alias("cost"), C.coerce_int("days").alias("days"))
    K.overwrite(typed.filter(F.col("starts") < F.lit(dt.date(2024, 1, 10))), f"{base}/table")
    for run in (dt.date(2024, 1, 15), dt.date(2024, 1, 17)):
        if G.gate(K.read_log(spark, f"{base}/log"), "leave", "weekly", run).first()["proceed"] == 1:
            fresh = G.new_rows(typed, spark.read.parquet(f"{base}/table"), "leave_id").checkpoint(eager=True)
            K.log_load(spark, f"{base}/log", K.append(fresh, f"{base}/table"), "leave", dt.datetime.combine(run, dt.time(6)))
    return spark.read.parquet(f"{base}/table")
