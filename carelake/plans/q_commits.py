"""Registered queries of loads that must survive reruns: committed loads, partition merges, bucketed targets, as-of lookups."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from carelake.operators.lookup import as_of
from carelake.plans.registry import query
from carelake.session import work_dir
from carelake.sinks import gates as G
from carelake.sinks import tables as K


def _month(col: str):
    return F.date_format(col, "yyyy-MM")


@query("publish_null_period", """
WITH p AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y%m') END AS period, o_orderpriority AS item,
                  CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2)
SELECT 'panel' AS part, period, item, n FROM p
UNION ALL SELECT 'run 1', NULL, 'panel', CAST(count(*) AS BIGINT) FROM p WHERE coalesce(period <= '200106', true)
UNION ALL SELECT 'run 2', NULL, 'panel', CAST(count(*) AS BIGINT) FROM p WHERE period = '200107'
UNION ALL SELECT 'run 3', NULL, 'panel', CAST(count(*) AS BIGINT) FROM p WHERE period > '200107'
""")
def publish_null_period(t):
    """Every month brings all periods up to its own and the rows without
    a period; each period, the NULL one included, is published once."""
    spark = t.orders.sparkSession
    base = work_dir(spark, "publish-null")
    p = t.orders.groupBy(F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyyMM")).alias("period"),
                         F.col("o_orderpriority").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    out = None
    for name, day, most in (("run 1", dt.date(2001, 6, 3), "200106"), ("run 2", dt.date(2001, 7, 3), "200107"), ("run 3", dt.date(2001, 8, 3), "999999")):
        batch = p.filter(F.col("period").isNull() | (F.col("period") <= most))
        s = K.publish_all([K.PublishSpec("panel", batch, period_col="period")], f"{base}/out", f"{base}/log", day)
        s = s.select(F.lit(name).alias("part"), F.lit(None).cast("string").alias("period"), F.col("table").alias("item"), F.col("rows").alias("n"))
        out = s if out is None else out.unionByName(s)
    target = spark.read.schema("item string, n bigint, period string").parquet(f"{base}/out/panel")
    return out.unionByName(target.select(F.lit("panel").alias("part"), "period", "item", "n"))


_FIX_SQL = """SELECT l_orderkey, l_linenumber, max(l_extendedprice * 2) AS v FROM lineitem
  WHERE l_returnflag = 'R' AND strftime(l_shipdate, '%Y-%m') IN ('2001-02', '2001-05') GROUP BY 1, 2"""


@query("merge_partitions_write", f"""
WITH fix AS ({_FIX_SQL}),
m AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, l.l_orderkey, l.l_linenumber,
             CASE WHEN f.l_orderkey IS NOT NULL THEN f.v ELSE l_extendedprice END AS price, f.l_orderkey IS NOT NULL AS hit
      FROM lineitem l LEFT JOIN fix f ON l.l_orderkey = f.l_orderkey AND l.l_linenumber = f.l_linenumber)
SELECT month, CAST(count(*) AS BIGINT) AS n, round(sum(price), 2) AS total, NOT bool_or(hit) AS kept_files FROM m GROUP BY 1
""")
def merge_partitions_write(t):
    """K8/D17 on a table partitioned by month: a correction of two months'
    lines rewrites the partitions it touches; the others keep their files."""
    spark = t.lineitem.sparkSession
    path = work_dir(spark, "merge-parts") + "/table"
    keys = ["l_orderkey", "l_linenumber"]
    lines = t.lineitem.select(*keys, "l_extendedprice", _month("l_shipdate").alias("month"))
    K.overwrite(lines, path, partition_by="month")
    fix = t.lineitem.filter((F.col("l_returnflag") == "R") & _month("l_shipdate").isin("2001-02", "2001-05")).groupBy(*keys).agg(
        F.max(F.col("l_extendedprice") * 2).alias("l_extendedprice"))

    def files():
        return spark.read.schema(lines.schema).parquet(path).select("month", F.col("_metadata.file_path").alias("f")).distinct().groupBy(
            "month").agg(F.array_sort(F.collect_list("f")).alias("files"))  # a partition's files

    before = files().checkpoint(eager=True)
    K.merge_partitions(spark, path, fix, keys, ["l_extendedprice"], "month")
    same = files().join(before.withColumnRenamed("files", "had"), "month").select("month", (F.col("files") == F.col("had")).alias("kept_files"))
    out = spark.read.schema(lines.schema).parquet(path).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return out.join(same, "month").select("month", "n", "total", "kept_files")


@query("load_after_crash", """
WITH a AS (SELECT CASE WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN '2000' ELSE '2001' END AS load_id, count(*) AS n FROM orders GROUP BY 1)
SELECT 'before the rerun' AS part, load_id, CAST(n AS BIGINT) AS n FROM a WHERE load_id = '2000'
UNION ALL SELECT 'after the rerun', load_id, CAST(n AS BIGINT) FROM a
UNION ALL SELECT 'log', load_id, CAST(n AS BIGINT) FROM a
""")
def load_after_crash(t):
    """K1/K12 as one commit: a load stops between its rows and its log row;
    readers don't see it until its rerun, which leaves one copy of each row."""
    spark = t.orders.sparkSession
    base = work_dir(spark, "commit")
    at, schema = dt.datetime(2001, 7, 1), "o_orderkey bigint, o_custkey bigint"
    o = t.orders.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderdate")
    first = o.filter(F.col("o_orderdate") < F.lit(dt.datetime(2001, 1, 1))).drop("o_orderdate")
    second = o.filter(F.col("o_orderdate") >= F.lit(dt.datetime(2001, 1, 1))).drop("o_orderdate")
    K.load_once(first, f"{base}/t", f"{base}/log", "2000", "encounters", at)
    K.write_load(second.filter(F.col("o_orderkey") % 2 == 0), f"{base}/t", "2001")  # stops here

    def seen(part):
        return K.committed(spark, f"{base}/t", f"{base}/log", "encounters", schema).groupBy("load_id").agg(
            F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "load_id", "n")

    early = seen("before the rerun").checkpoint(eager=True)
    for _ in range(2):  # a rerun of what is committed changes nothing either
        K.load_once(second, f"{base}/t", f"{base}/log", "2001", "encounters", at)
    log = K.read_log(spark, f"{base}/log").select(F.lit("log").alias("part"), F.col("id").alias("load_id"), F.col("totalRegistros").alias("n"))
    return early.unionByName(seen("after the rerun")).unionByName(log)


@query("keyed_load_bucketed", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 2 = 1
""")
def keyed_load_bucketed(t):
    """G5 against a target ten times the batch: the target lies in buckets of
    its key, so the anti join shuffles the batch and reads the target as it is."""
    spark = t.orders.sparkSession
    name = f"target_{uuid.uuid4().hex[:12]}"
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    o = t.orders.select(*cols)
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = K.save_bucketed(o.filter(~((F.col("o_orderkey") % 11 == 0) & (F.col("o_orderkey") % 2 == 1))), name,
                             work_dir(spark, "bucketed") + "/t", "o_orderkey", min(shuffles, 64))
    new = G.new_rows(o.filter(F.col("o_orderkey") % 11 == 0), target.hint("merge"), "o_orderkey")
    new.schema  # planned against the table's files, which outlive its name
    spark.sql(f"DROP TABLE {name}")
    return new


_POP_SQL = """SELECT c_nationkey AS site, make_date(2000, 1 + k * (1 + c_nationkey % 3), 15) AS period,
  CAST(count(*) + k AS BIGINT) AS population FROM customer, range(0, 4) r(k)
  WHERE c_nationkey % 5 <> 0 GROUP BY 1, 2, k"""


@query("population_as_of", f"""
WITH pop AS ({_POP_SQL}),
v AS (SELECT o_orderkey, c_nationkey AS site, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS day
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '2001-01-01')
SELECT o_orderkey, v.site, day, period, population FROM v ASOF LEFT JOIN pop ON v.site = pop.site AND v.day >= pop.period
""")
def population_as_of(t):
    """G10/D7/D20 per site: each visit gets the latest population of its site
    at or before its day; sites publish at gaps of one to three months, some
    never do, and some visits have no day."""
    sites = t.customer.groupBy(F.col("c_nationkey").alias("site")).agg(F.count(F.lit(1)).alias("n")).filter("site % 5 <> 0")
    k = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k")
    pop = sites.select("site", "n", k).select(
        "site", F.make_date(F.lit(2000), (1 + F.col("k") * (1 + F.col("site") % 3)).cast("int"), F.lit(15)).alias("period"),
        (F.col("n") + F.col("k")).alias("population"))
    v = t.orders.filter(F.col("o_orderdate") < F.lit(dt.datetime(2001, 1, 1))).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("c_nationkey").alias("site"), F.when(F.col("o_orderkey") % 13 != 0, F.to_date("o_orderdate")).alias("day"))
    pop = pop.withColumn("at", F.col("period"))
    return as_of(v, pop, "site", "day", "at", ["period", "population"])


# ---------------------------------------------------------------- D20
_DENTAL_SQL = f"""
WITH pop AS ({_POP_SQL}),
v AS (SELECT * FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('month', o_orderdate) AS DATE) + 14 AS period,
        c_nationkey AS site, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '2000-05-01' AND o_orderdate < TIMESTAMP '2000-08-01') x WHERE rn = 1)
SELECT v.o_orderkey, v.o_custkey, v.day, strftime(v.period, '%Y%m') AS month, v.site, pop.population
FROM v ASOF LEFT JOIN pop ON v.site = pop.site AND v.period >= pop.period"""


@query("dental_capitation_load", _DENTAL_SQL + """
UNION ALL SELECT NULL, NULL, NULL, 'loads', NULL, 3
""")
def dental_capitation_load(t):
    """D20 as a load: each month's visits with the population of their period
    and site (the latest published at or before it), one row per patient and
    day (W5), behind a monthly gate (G2), in place of the month's rows (K6);
    a rerun in the month finds the gate closed. Read back with the log's count."""
    from carelake.functions.dates import in_range, mid_month
    from carelake.operators.sequence import dedupe
    spark = t.orders.sparkSession
    base = work_dir(spark, "dental-load")
    sites = t.customer.groupBy(F.col("c_nationkey").alias("site")).agg(F.count(F.lit(1)).alias("n")).filter("site % 5 <> 0")
    pop = sites.select("site", "n", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k")).select(
        "site", F.make_date(F.lit(2000), (1 + F.col("k") * (1 + F.col("site") % 3)).cast("int"), F.lit(15)).alias("at"),
        (F.col("n") + F.col("k")).alias("population"))
    for run in (dt.date(2000, 6, 3), dt.date(2000, 7, 3), dt.date(2000, 7, 9), dt.date(2000, 8, 3)):
        if G.gate(K.read_log(spark, f"{base}/log"), "dental", "monthly", run).first()["proceed"] != 1:
            continue
        lo = (run.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
        v = t.orders.filter(in_range("o_orderdate", lo, run.replace(day=1))).join(
            t.customer.select("c_custkey", F.col("c_nationkey").alias("site")), F.col("o_custkey") == F.col("c_custkey"))
        v = v.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), mid_month("o_orderdate").alias("period"), "site")
        out = as_of(v, pop, "site", "period", "at", ["population"])
        out = dedupe(out, ["o_custkey", "day"], keep="first", order="o_orderkey").withColumn("month", F.date_format("period", "yyyyMM")).drop("period")
        n = K.replace_period(out, f"{base}/table", "month", f"{lo:%Y%m}")
        K.log_load(spark, f"{base}/log", n, "dental", dt.datetime.combine(run, dt.time(6)))
    cols = ["o_orderkey", "o_custkey", "day", "month", "site", "population"]
    kinds = {"o_orderkey": "bigint", "o_custkey": "bigint", "day": "date", "month": "string", "site": t.customer.schema["c_nationkey"].dataType.simpleString(),
             "population": "bigint"}
    table = spark.read.schema(", ".join(f"{c} {k}" for c, k in kinds.items())).parquet(f"{base}/table").select(*cols)
    loads = K.read_log(spark, f"{base}/log").agg(F.count(F.lit(1)).alias("population")).withColumn("month", F.lit("loads"))
    return table.unionByName(loads, allowMissingColumns=True)


# ---------------------------------------------------------------- D7
@query("encounter_audit_publish", """
WITH e AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, c_nationkey AS site FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-04-01'),
n AS (SELECT c_nationkey AS site, CAST(count(*) AS BIGINT) AS population FROM customer GROUP BY 1)
SELECT 'row' AS part, o_orderkey, day, e.site, CASE WHEN day >= DATE '2001-02-01' OR e.site % 2 = 0 THEN n.population ELSE 0 END AS population FROM e JOIN n ON n.site = e.site
UNION ALL SELECT 'run 1', CAST(count(*) AS BIGINT), NULL, NULL, 1 FROM e WHERE day < DATE '2001-02-11'
UNION ALL SELECT 'run 2', CAST(count(*) AS BIGINT), NULL, NULL, 1 FROM e WHERE day >= DATE '2001-02-11'
UNION ALL SELECT 'run 3', 0, NULL, NULL, -1
""")
def encounter_audit_publish(t):
    """Encounters after the target's high watermark (G9) are published
    (K15), a run that finds none stops (G12); rows that were loaded with
    population 0 since February are repaired from the roll where it differs
    (K9), rewriting the months they are in. Table and run summaries read back."""
    from carelake.functions.dates import in_range
    spark = t.orders.sparkSession
    base = work_dir(spark, "audit-publish")
    kind = t.customer.schema["c_nationkey"].dataType.simpleString()
    schema = f"o_orderkey bigint, day date, site {kind}, population bigint, month string"
    e = t.orders.filter(in_range("o_orderdate", dt.date(2001, 1, 1), dt.date(2001, 4, 1))).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("bigint"), F.to_date("o_orderdate").alias("day"), F.col("c_nationkey").alias("site"))
    n = t.customer.groupBy(F.col("c_nationkey").alias("site")).agg(F.count(F.lit(1)).alias("population"))
    e = e.join(n, "site").withColumn("population", F.when(F.col("site") % 2 == 0, F.col("population")).otherwise(F.lit(0).cast("bigint")))
    e = e.select("o_orderkey", "day", "site", "population", F.date_format("day", "yyyyMM").alias("month"))
    spark.createDataFrame([], schema).write.partitionBy("month").parquet(f"{base}/out/audit")
    out = None
    for name, run, seen in (("run 1", dt.date(2001, 2, 11), dt.date(2001, 2, 11)), ("run 2", dt.date(2001, 4, 1), dt.date(2001, 4, 1)),
                            ("run 3", dt.date(2001, 5, 1), dt.date(2001, 4, 1))):
        target = spark.read.schema(schema).parquet(f"{base}/out/audit") if K.path_exists(spark, f"{base}/out/audit") else spark.createDataFrame([], schema)
        batch = G.rows_after(e.filter(F.col("day") < F.lit(seen)), "day", target)
        s = K.publish_all([K.PublishSpec("audit", batch.select("o_orderkey", "day", "site", "population", "month"))], f"{base}/out", f"{base}/log", run)
        s = s.select(F.lit(name).alias("part"), F.col("rows").alias("o_orderkey"), F.col("loaded").cast("bigint").alias("population"))
        out = s if out is None else out.unionByName(s)
    loaded = spark.read.schema(schema).parquet(f"{base}/out/audit")
    # the published rows as a table by month, so that the repair rewrites the months it touches
    K.overwrite(loaded, f"{base}/table", partition_by="month")
    wrong = loaded.filter((F.col("population") == 0) & (F.col("day") >= F.lit(dt.date(2001, 2, 1)))).select("o_orderkey", "site", "month")
    K.merge_partitions(spark, f"{base}/table", wrong.join(n, "site").select("o_orderkey", "month", "population"), ["o_orderkey", "month"], "population", "month",
                       only_changed=True)
    table = spark.read.schema(schema).parquet(f"{base}/table").select(F.lit("row").alias("part"), "o_orderkey", "day", "site", "population")
    return table.unionByName(out, allowMissingColumns=True)


# ---------------------------------------------------------------- D9
@query("pregnancy_tests", """
WITH w AS (SELECT c_custkey, c_nationkey AS site FROM customer WHERE c_custkey % 2 = 1),
r AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events JOIN w ON user_id = c_custkey WHERE value > 50 AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01')
SELECT r.user_id, r.day, w.site, DATE '2024-01-15' AS fecha_capita,
       CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = r.user_id AND o_orderpriority = '3-MEDIUM') THEN 'SI' ELSE 'NO' END AS controlada
FROM r JOIN w ON r.user_id = w.c_custkey WHERE rn = 1
""")
def pregnancy_tests(t):
    """D9 extract: the month's positive pregnancy tests, the first of each
    woman, with the capitation period and whether she has a prenatal control (J16)."""
    from carelake.functions.dates import in_range
    from carelake.operators.lookup import enrich, match_marker
    from carelake.operators.sequence import first_per
    women = t.customer.filter(F.col("c_custkey") % 2 == 1).select("c_custkey", F.col("c_nationkey").alias("site"))
    tests = t.events.filter(in_range("ts", dt.date(2024, 1, 1), dt.date(2024, 2, 1)) & (F.col("value") > 50))
    tests = enrich(tests.select("user_id", "ts", "event_id"), women, "user_id", right_on="c_custkey", how="inner")
    first = first_per(tests, "user_id", ["ts", "event_id"]).withColumn("fecha_capita", F.lit(dt.date(2024, 1, 15)))
    controls = t.orders.filter(F.col("o_orderpriority") == "3-MEDIUM").select("o_custkey")
    return match_marker(first, controls, "user_id", "controlada", right_on="o_custkey").select(
        "user_id", F.to_date("ts").alias("day"), "site", "fecha_capita", "controlada")
