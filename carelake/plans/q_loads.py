"""Registered incremental-load, mutation and set-operation queries
(G1-G11, K5-K9, K1+K12 round trip, U1-U5, P3-P5, S11, S12)."""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.sql import functions as F

from carelake.operators.lookup import enrich
from carelake.operators.setops import id_difference, union_distinct, union_ragged, union_tagged
from carelake.operators.shape import add_missing, cast_all_but, rename_positional
from carelake.plans.registry import query
from carelake.session import work_dir
from carelake.sinks import gates as G
from carelake.sinks import tables as K


def _ts(y, m, d):
    return dt.datetime(y, m, d)


@query("new_rows_by_key", """
WITH batch AS (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
               UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01')
SELECT * FROM batch WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderdate < TIMESTAMP '2001-03-01'
                                      AND t.o_orderkey = batch.o_orderkey)
""")
def new_rows_by_key(t):
    """Batch rows whose key is not in the target; in-batch duplicates kept."""
    o = t.orders.select("o_orderkey", "o_orderdate")
    batch = o.filter(F.col("o_orderdate") >= F.lit(_ts(2001, 1, 1))).unionByName(
        o.filter(F.col("o_orderdate") >= F.lit(_ts(2001, 7, 1))))
    target = o.filter(F.col("o_orderdate") < F.lit(_ts(2001, 3, 1)))
    return G.new_rows(batch, target, "o_orderkey")


@query("new_rows_recent", """
SELECT o_orderkey, o_orderdate FROM orders b WHERE o_orderdate >= TIMESTAMP '2000-12-01'
AND NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderdate < TIMESTAMP '2001-03-01'
                AND t.o_orderdate >= TIMESTAMP '2001-02-01' AND t.o_orderkey = b.o_orderkey)
""")
def new_rows_recent(t):
    """Dedupe only against the target's last month."""
    o = t.orders.select("o_orderkey", "o_orderdate")
    batch = o.filter(F.col("o_orderdate") >= F.lit(_ts(2000, 12, 1)))
    target = o.filter(F.col("o_orderdate") < F.lit(_ts(2001, 3, 1)))
    return G.new_rows(batch, target, "o_orderkey", since=_ts(2001, 2, 1), since_col="o_orderdate")


@query("new_rows_composite", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders b
WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderstatus = 'F' AND t.o_custkey = b.o_custkey
                  AND CAST(t.o_orderdate AS DATE) = CAST(b.o_orderdate AS DATE) AND t.o_orderpriority = b.o_orderpriority)
""")
def new_rows_composite(t):
    """Composite key (patient, day, code) joined as a column tuple."""
    o = t.orders.withColumn("day", F.to_date("o_orderdate"))
    target = o.filter(F.col("o_orderstatus") == "F")
    keys = ["o_custkey", "day", "o_orderpriority"]
    return G.new_rows(o, target, keys).select("o_orderkey", "o_custkey", "o_orderpriority")


@query("new_ids_as_text", """
SELECT o_orderkey FROM orders WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events)
""")
def new_ids_as_text(t):
    """Ids compared as text on both sides."""
    known = t.events.select(F.col("user_id").cast("string").alias("id"))
    return G.new_ids(t.orders.select("o_orderkey", "o_custkey"), known, "o_custkey", ids_key="id").select("o_orderkey")


_SRC_SQL = """SELECT l_partkey, CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE max(l_extendedprice / l_quantity) END AS p_retailprice
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01' GROUP BY l_partkey"""


@query("merge_update", f"""
SELECT p_partkey, p_brand, coalesce(CASE WHEN s.l_partkey IS NOT NULL THEN 1 END, 0) AS matched,
       CASE WHEN s.l_partkey IS NOT NULL THEN s.p_retailprice ELSE t.p_retailprice END AS p_retailprice
FROM part t LEFT JOIN ({_SRC_SQL}) s ON t.p_partkey = s.l_partkey
""")
def merge_update(t):
    """K8: update matched keys from the source (a matched NULL overwrites)."""
    li = t.lineitem.filter(F.col("l_shipdate") >= F.lit(_ts(2001, 1, 1)))
    src = li.groupBy("l_partkey").agg(F.max(F.try_divide("l_extendedprice", "l_quantity")).alias("v")).select(
        F.col("l_partkey").alias("p_partkey"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("v")).alias("p_retailprice"))
    target = t.part.select("p_partkey", "p_brand", "p_retailprice")
    marked = target.join(src.select("p_partkey").withColumn("matched", F.lit(1)), "p_partkey", "left").fillna(
        0, ["matched"])
    return K.merge_update_df(marked, src, "p_partkey", ["p_retailprice"])


_POP_SQL = """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, c_nationkey AS site,
  CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS month_total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""


@query("update_from_window", f"""
WITH t AS ({_POP_SQL}),
s AS (SELECT month, site, CAST(sum(n) OVER (PARTITION BY month) AS BIGINT) AS month_total FROM t)
SELECT t.month, t.site, t.n,
  CASE WHEN t.month >= DATE '2000-01-01' AND t.month_total <> s.month_total THEN s.month_total
       ELSE t.month_total END AS month_total
FROM t LEFT JOIN s ON t.month = s.month AND t.site = s.site
""")
def update_from_window(t):
    """K9: set the network total of each (month, site) row from a windowed
    total where it differs, only from a date floor on."""
    from carelake.operators.sequence import partition_total
    o = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    pop = o.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month"), F.col("c_nationkey").alias("site")).agg(
        F.count(F.lit(1)).alias("n"))
    target = pop.withColumn("month_total", F.col("n"))
    src = partition_total(pop, "month", "n", "month_total")
    return K.update_from_df(target, src, ["month", "site"], ["month_total"], floor_col="month",
                            floor=dt.date(2000, 1, 1))


@query("refresh_window", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2001-03-01'
UNION ALL
SELECT o_orderkey, o_orderdate, round(o_totalprice * 2, 2) FROM orders WHERE o_orderdate >= TIMESTAMP '2001-03-01'
""")
def refresh_window(t):
    """K5: delete rows from the window start, append the reloaded window."""
    o = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    target = o.filter(F.col("o_orderdate") < F.lit(_ts(2001, 6, 1)))
    new = o.filter(F.col("o_orderdate") >= F.lit(_ts(2001, 3, 1))).withColumn(
        "o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    return K.refresh_window_df(target, new, "o_orderdate", _ts(2001, 3, 1))


_LATE_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate, o_totalprice FROM orders"""


@query("refresh_window_late_rows", f"""
WITH o AS ({_LATE_SQL}),
keep AS (SELECT * FROM o WHERE o_orderkey % 3 <> 0 AND NOT coalesce(o_orderdate >= TIMESTAMP '2001-03-01', FALSE)),
new AS (SELECT o_orderkey, o_orderdate, round(o_totalprice * 2, 2) AS o_totalprice FROM o
        WHERE o_orderdate IS NULL OR o_orderdate >= TIMESTAMP '2001-02-01')
SELECT * FROM keep UNION ALL SELECT * FROM new WHERE o_orderdate >= TIMESTAMP '2001-03-01'
UNION ALL SELECT * FROM new WHERE NOT coalesce(o_orderdate >= TIMESTAMP '2001-03-01', FALSE)
  AND o_orderkey NOT IN (SELECT o_orderkey FROM keep)
""")
def refresh_window_late_rows(t):
    """K5: the batch also holds undated rows and rows from before the window;
    those the target lacks are added by key, and a second run adds none."""
    day = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate")).alias("o_orderdate")
    o = t.orders.select("o_orderkey", day, "o_totalprice")
    lo = _ts(2001, 3, 1)
    target = o.filter(F.col("o_orderkey") % 3 != 0)
    new = o.filter(F.col("o_orderdate").isNull() | (F.col("o_orderdate") >= F.lit(_ts(2001, 2, 1)))).withColumn(
        "o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    once = K.refresh_window_df(target, new, "o_orderdate", lo, key="o_orderkey")
    return K.refresh_window_df(once, new, "o_orderdate", lo, key="o_orderkey")


@query("refresh_partitions", """
SELECT o_orderkey, o_totalprice * 2 AS v, CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-03-01' AND o_orderdate < TIMESTAMP '2001-05-01'
UNION ALL
SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders
WHERE o_orderdate < TIMESTAMP '2001-03-01' OR o_orderdate >= TIMESTAMP '2001-06-01'
""")
def refresh_partitions(t):
    """K5 by partition: only the months of the window are rewritten; a month that
    the new extract no longer has is emptied."""
    spark = t.orders.sparkSession
    path = work_dir(spark, "refresh-partitions") + "/table"
    o = t.orders.select("o_orderkey", F.col("o_totalprice").alias("v"), F.trunc(F.to_date("o_orderdate"), "MM").alias("day"))
    K.overwrite(o, path, partition_by="day")
    lo, hi = dt.date(2001, 3, 1), dt.date(2001, 6, 1)
    new = o.filter((F.col("day") >= F.lit(lo)) & (F.col("day") < F.lit(dt.date(2001, 5, 1)))).withColumn("v", F.col("v") * 2)
    K.refresh_partitions(new, path, "day", lo, hi)
    return spark.read.parquet(path).select("o_orderkey", "v", "day")


@query("reload_partitioned", """
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def reload_partitioned(t):
    """K2: a partitioned reload whose data no longer has one partition: that
    partition is gone from the table as well."""
    spark = t.orders.sparkSession
    path = work_dir(spark, "reload") + "/table"
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    K.overwrite(o, path, partition_by="o_orderpriority")
    K.overwrite(o.filter(F.col("o_orderpriority") != "5-LOW"), path, partition_by="o_orderpriority")
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("typed_write_bad_text", """
SELECT o_orderkey + 9007199254740993 AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey AS BIGINT) END AS n,
       CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS DATE) AS day,
       (SELECT CAST(count(*) FILTER (o_orderkey % 7 = 0) AS BIGINT) FROM orders) AS bad_n,
       (SELECT CAST(count(*) FILTER (o_orderkey % 5 = 0) AS BIGINT) FROM orders) AS bad_day
FROM orders
""")
def typed_write_bad_text(t):
    """Text columns written with the target's types: bad cells are NULL
    and counted, ids above 2**53 keep every digit."""
    from pyspark.sql import types as T
    spark = t.orders.sparkSession
    path = work_dir(spark, "typed") + "/table"
    raw = t.orders.select(
        F.col("o_orderkey").cast("decimal(38,0)").__add__(F.lit(9007199254740993).cast("decimal(38,0)")).cast("string").alias("id"),
        F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_orderkey").cast("string")).alias("n"),
        F.when(F.col("o_orderkey") % 5 == 0, "99/99").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("day", T.DateType())])
    _, bad = K.write_with_schema(raw, schema, path)
    return spark.read.parquet(path).withColumns({"bad_n": F.lit(bad["n"]).cast("bigint"),
                                                 "bad_day": F.lit(bad["day"]).cast("bigint")})


@query("publish_panel", """
WITH p AS (SELECT strftime(o_orderdate, '%Y%m') AS period, o_orderpriority AS item, CAST(count(*) AS BIGINT) AS n
           FROM orders GROUP BY 1, 2),
t AS (SELECT 'panel' AS part, period, item, n FROM p)
SELECT * FROM t
UNION ALL SELECT 'log', '2001-06', 'panel', CAST(count(*) AS BIGINT) FROM p WHERE period <= '200106'
UNION ALL SELECT 'log', '2001-07', 'panel', CAST(count(*) AS BIGINT) FROM p WHERE period > '200106'
UNION ALL SELECT 'run 1', NULL, 'panel', CAST(count(*) AS BIGINT) FROM p WHERE period <= '200106'
UNION ALL SELECT 'run 1 empty', NULL, 'none', 0
UNION ALL SELECT 'run 2 closed', NULL, 'panel', 0
UNION ALL SELECT 'run 3', NULL, 'panel', CAST(count(*) AS BIGINT) FROM p WHERE period > '200106'
UNION ALL SELECT 'export', NULL, 'panel', CAST(count(*) AS BIGINT) FROM p
UNION ALL SELECT 'export empty', NULL, 'panel', 0
""")
def publish_panel(t):
    """Three runs of a publisher. June publishes half of the
    periods and stops on an empty output; a second June run finds the gate
    closed; July brings all periods again and only the new ones are added.
    Returns target, log and summaries read back, and the CSV exports' counts."""
    spark = t.orders.sparkSession
    base = work_dir(spark, "publish")
    p = t.orders.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("period"), F.col("o_orderpriority").alias("item")).agg(
        F.count(F.lit(1)).alias("n"))
    june = p.filter(F.col("period") <= "200106")
    none = p.filter(F.col("period").isNull())
    runs = []
    for name, day, specs in (("run 1", dt.date(2001, 6, 3), [K.PublishSpec("panel", june, period_col="period"),
                                                             K.PublishSpec("none", none, mode="overwrite")]),
                             ("run 2", dt.date(2001, 6, 20), [K.PublishSpec("panel", june, period_col="period")]),
                             ("run 3", dt.date(2001, 7, 3), [K.PublishSpec("panel", p, period_col="period")])):
        s = K.publish_all(specs, f"{base}/out", f"{base}/log", day)
        state = F.when(F.col("loaded") == 0, " closed").when(F.col("loaded") < 0, " empty").otherwise("")
        runs.append(s.select(F.concat(F.lit(name), state).alias("part"), F.lit(None).cast("string").alias("period"),
                             F.col("table").alias("item"), F.col("rows").alias("n")))
    target = spark.read.schema("item string, n bigint, period string").parquet(f"{base}/out/panel")
    log = K.read_log(spark, f"{base}/log")
    out = target.select(F.lit("panel").alias("part"), "period", "item", "n").unionByName(
        log.select(F.lit("log").alias("part"), F.date_format("fechaCargue", "yyyy-MM").alias("period"),
                   F.col("idBigquery").alias("item"), F.col("totalRegistros").alias("n")))
    for r in runs:
        out = out.unionByName(r)
    K.export_csv(target, f"{base}/csv")
    exported = spark.read.option("sep", ";").option("header", "true").csv(f"{base}/csv")
    empty = K.export_csv(target.filter("false"), f"{base}/csv2")
    out = out.unionByName(exported.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("export").alias("part"), F.lit(None).cast("string").alias("period"), F.lit("panel").alias("item"), "n"))
    return out.unionByName(spark.createDataFrame([("export empty", None, "panel", empty)],
                                                 "part string, period string, item string, n bigint"))


@query("replace_period", """
SELECT l_orderkey, l_linenumber, period, l_quantity FROM (
  SELECT *, strftime(l_shipdate, '%Y%m') AS period FROM lineitem) x WHERE period <> '200006'
UNION ALL
SELECT l_orderkey, l_linenumber, period, l_quantity + 1 FROM (
  SELECT *, strftime(l_shipdate, '%Y%m') AS period FROM lineitem) x WHERE period = '200006' AND l_returnflag = 'N'
""")
def replace_period(t):
    """K6: every row of period 200006 replaced by the new extract of it."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
                           F.date_format("l_shipdate", "yyyyMM").alias("period"))
    new = li.filter((F.col("l_returnflag") == "N") & (F.col("period") == "200006")).withColumn(
        "l_quantity", F.col("l_quantity") + 1)
    return K.replace_period_df(li.drop("l_returnflag"), new.drop("l_returnflag"), "period", "200006")


_LOG_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS fechaCargue, CAST(1 AS BIGINT) AS totalRegistros,
  'tabla_' || o_orderpriority AS idBigquery FROM orders"""


def _log(t):
    return t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderdate").alias("fechaCargue"),
                           F.lit(1).cast("bigint").alias("totalRegistros"),
                           F.concat(F.lit("tabla_"), F.col("o_orderpriority")).alias("idBigquery"))


_GATE_ON = dt.date(2001, 3, 4)    # a Sunday


def _gate_sql(name, lo, hi):
    return (f"(SELECT CAST(count(*) AS BIGINT) FROM ({_LOG_SQL}) l WHERE idBigquery = 'tabla_1-URGENT' AND "
            f"fechaCargue >= TIMESTAMP '{lo}' AND fechaCargue < TIMESTAMP '{hi}') AS {name}")


@query("load_gate", "SELECT " + ", ".join(
    _gate_sql(f"n_{g}{'_legacy' if lg else ''}", *G.load_window(g, _GATE_ON, lg))
    for g, lg in (("daily", False), ("monthly", False), ("weekly", False), ("weekly", True))))
def load_gate(t):
    """Loads already logged today / this month / this week (half-open
    7 days, and the legacy window that leaves out the Sunday)."""
    return G.gates(_log(t), "tabla_1-URGENT", _GATE_ON, {
        f"n_{g}{'_legacy' if lg else ''}": (g, lg)
        for g, lg in (("daily", False), ("monthly", False), ("weekly", False), ("weekly", True))})


@query("range_empty", """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM (SELECT 1 FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '2001-07-01'
        AND TIMESTAMP '2001-07-31' LIMIT 1)) AS has_rows_jul,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT 1 FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '2001-09-01'
        AND TIMESTAMP '2001-09-30' LIMIT 1)) AS has_rows_sep
""")
def range_empty(t):
    """Does the target already hold rows in a date range (0/1)."""
    a = G.range_probe(t.orders, "o_orderdate", _ts(2001, 7, 1), _ts(2001, 7, 31)).withColumnRenamed(
        "has_rows", "has_rows_jul")
    b = G.range_probe(t.orders, "o_orderdate", _ts(2001, 9, 1), _ts(2001, 9, 30)).withColumnRenamed(
        "has_rows", "has_rows_sep")
    return a.crossJoin(b)


@query("high_watermark", """
WITH w AS (SELECT max(o_orderdate) AS watermark FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')
SELECT w.watermark, CAST(count(o.o_orderkey) AS BIGINT) AS n_after FROM w LEFT JOIN orders o ON o.o_orderdate > w.watermark
GROUP BY w.watermark
""")
def high_watermark(t):
    """The target's max date, then a scan of only the rows after it."""
    target = t.orders.filter(F.col("o_orderdate") < F.lit(_ts(2001, 1, 1)))
    after = G.rows_after(t.orders, "o_orderdate", target)
    return after.agg(F.count("o_orderkey").alias("n_after")).join(  # one row each
        G.watermark_of(target, "o_orderdate"), how="cross").select("watermark", "n_after")


@query("fallback_period", """
WITH pop AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderpriority,
                    CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2)
SELECT DATE '2001-09-15' AS period, o_orderpriority, n FROM pop
WHERE period = (SELECT max(period) FROM pop WHERE period <= DATE '2001-09-15')
""")
def fallback_period(t):
    """This month has no population: reuse the latest earlier period."""
    pop = t.orders.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("period"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"))
    return G.fallback_period(pop, "period", dt.date(2001, 9, 15))


@query("new_vs_previous", """
WITH cur AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'),
prev AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-07-01' AND o_orderdate < TIMESTAMP '2001-01-01')
SELECT cur.o_custkey, CASE WHEN prev.o_custkey IS NULL THEN 'SI' ELSE 'NO' END AS nuevo
FROM cur LEFT JOIN prev ON cur.o_custkey = prev.o_custkey
""")
def new_vs_previous(t):
    """New (SI) vs already on the previous roster (NO)."""
    o = t.orders.select("o_custkey", "o_orderdate")
    cur = o.filter(F.col("o_orderdate") >= F.lit(_ts(2001, 1, 1))).select("o_custkey").distinct()
    prev = o.filter((F.col("o_orderdate") >= F.lit(_ts(2000, 7, 1))) & (F.col("o_orderdate") < F.lit(_ts(2001, 1, 1))))
    return G.mark_new_vs_previous(cur, prev, "o_custkey")


@query("keyed_load_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
""")
def keyed_load_roundtrip(t):
    """L1 end to end: seed a target table, then load a batch through the
    keyed dedupe (G5), append (K1) and log (K12); return the table read back.

    The batch overlaps the seeded target (from 2000 on), so only its new
    keys are appended; the final table holds every encounter exactly once.
    """
    spark = t.orders.sparkSession
    base = work_dir(spark, "keyed-load")
    path, log_path = f"{base}/table", f"{base}/log"
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    K.overwrite(o.filter(F.col("o_orderdate") < F.lit(_ts(2001, 1, 1))), path)
    batch = o.filter(F.col("o_orderdate") >= F.lit(_ts(2000, 1, 1)))
    target = spark.read.parquet(path)
    fresh = G.new_rows(batch, target, "o_orderkey").checkpoint(eager=True)
    n = K.append(fresh, path)
    K.log_load(spark, log_path, n, "encounters", _ts(2001, 1, 2))
    return spark.read.parquet(path)


@query("union_distinct", """
SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'
UNION
SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def union_distinct_q(t):
    """Distinct union of two result shapes."""
    o = t.orders
    a = o.filter((F.col("o_orderdate") >= F.lit(_ts(2000, 1, 1))) & (F.col("o_orderdate") < F.lit(_ts(2001, 1, 1))))
    b = o.filter(F.col("o_orderpriority") == "1-URGENT")
    return union_distinct(a.select("o_custkey", "o_orderstatus"), b.select("o_custkey", "o_orderstatus"))


@query("union_ragged", """
SELECT o_orderkey, o_totalprice, NULL::DOUBLE AS l_quantity FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL
SELECT l_orderkey AS o_orderkey, NULL::DOUBLE AS o_totalprice, l_quantity FROM lineitem WHERE l_returnflag = 'R'
""")
def union_ragged_q(t):
    """Union of differing schemas; absent columns NULL."""
    a = t.orders.filter(F.col("o_orderpriority") == "5-LOW").select("o_orderkey", "o_totalprice")
    b = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    return union_ragged(a, b)


@query("id_difference", """
SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'
EXCEPT
SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
""")
def id_difference_q(t):
    """U4: ids in the first set and not the second."""
    o = t.orders
    return id_difference(o.filter(F.col("o_orderdate") < F.lit(_ts(2001, 1, 1))),
                         o.filter(F.col("o_orderdate") >= F.lit(_ts(2001, 1, 1))), "o_custkey")


@query("schema_drift_union", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS site, 0.0 AS balance, 0 AS flag, 'customer' AS part FROM customer
UNION ALL
SELECT s_suppkey AS id, s_name AS name, 0 AS site, s_acctbal AS balance, 0 AS flag, 'supplier' AS part FROM supplier
""")
def schema_drift_union(t):
    """Positional renames (count mismatch tolerated), ragged
    union with a provenance tag, absent columns created as 0."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        a = rename_positional(t.customer.select("c_custkey", "c_name", "c_nationkey"), ["id", "name", "site", "extra"])
        b = rename_positional(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), ["id", "name", "balance"])
    u = union_tagged({"customer": a, "supplier": b}, "part")
    u = u.withColumns({"site": F.coalesce(F.col("site"), F.lit(0)),
                       "balance": F.coalesce(F.col("balance"), F.lit(0.0))})
    return add_missing(u, ["flag"], 0).select("id", "name", "site", "balance", "flag", "part")


_STAR = {  # table -> columns, key, what an earlier load held
    "dim_site": ("nation", ["n_nationkey", "n_name"], ["n_nationkey"], "n_regionkey < 2"),
    "dim_professional": ("supplier", ["s_suppkey", "s_name"], ["s_suppkey"], "s_nationkey < 10"),
    "dim_exam": ("part", ["p_partkey", "p_type"], ["p_partkey"], "p_size < 20"),
}


@query("imaging_star_load", """
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, p_type AS exam, s_name AS professional, n_name AS site
FROM lineitem l JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""")
def imaging_star_load(t):
    """Three dimensions and a fact, each loaded through its own keyed
    dedupe (G5) and append (K1) into tables seeded with an earlier load;
    returns the star read back, the fact with all three dimensions."""
    spark = t.orders.sparkSession
    base = work_dir(spark, "star")

    def load(name, src, keys, seed):
        path = f"{base}/{name}"
        K.overwrite(src.filter(seed), path)
        K.append(G.new_rows(src, spark.read.parquet(path), keys).checkpoint(eager=True), path)
        return spark.read.parquet(path)

    dim = {n: load(n, getattr(t, table).select(*cols, *(["n_regionkey"] if table == "nation" else []),
                                               *(["s_nationkey"] if table == "supplier" else []),
                                               *(["p_size"] if table == "part" else [])), keys, seed)
           for n, (table, cols, keys, seed) in _STAR.items()}
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    # (order, line) repeats in the line table: the key of a fact row is the row itself
    fact = load("fact_study", li, li.columns, "l_shipdate < TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    j = enrich(fact, dim["dim_exam"].select("p_partkey", F.col("p_type").alias("exam")), "l_partkey", right_on="p_partkey", how="inner")
    j = enrich(j, dim["dim_professional"].select("s_suppkey", "s_nationkey", F.col("s_name").alias("professional")), "l_suppkey",
               right_on="s_suppkey", how="inner")
    j = enrich(j, dim["dim_site"].select("n_nationkey", F.col("n_name").alias("site")), "s_nationkey", right_on="n_nationkey", how="inner")
    return j.select("l_orderkey", "l_linenumber", "l_extendedprice", "exam", "professional", "site")


@query("roll_history", """
SELECT CAST(c_custkey AS VARCHAR) AS identificacion, c_name AS nombre, CAST(c_nationkey AS VARCHAR) AS sede,
       '0' AS sw_cronicos, CAST(c_acctbal AS VARCHAR) AS saldo, '202101' AS periodo FROM customer WHERE c_nationkey < 10
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
       CAST(c_custkey % 2 AS VARCHAR), '0', '202102' FROM customer WHERE c_nationkey >= 10
""")
def roll_history(t):
    """Monthly roll snapshots whose columns drift (renamed, added,
    missing) are renamed by map (P2), completed with 0 (P5), cast to text
    (P17) and unioned with their period."""
    from carelake.operators.shape import rename
    c = t.customer
    jan = c.filter(F.col("c_nationkey") < 10).select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    feb = c.filter(F.col("c_nationkey") >= 10).select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("NOMBRE"), F.col("c_nationkey").alias("SEDE"),
        (F.col("c_custkey") % 2).alias("SW_CRONICOS"))
    mapping = {"c_custkey": "identificacion", "c_name": "nombre", "c_nationkey": "sede", "c_acctbal": "saldo",
               "ID": "identificacion", "NOMBRE": "nombre", "SEDE": "sede", "SW_CRONICOS": "sw_cronicos"}
    cols = ["identificacion", "nombre", "sede", "sw_cronicos", "saldo"]
    parts = []
    for period, df in (("202101", jan), ("202102", feb)):
        df = add_missing(rename(df, mapping), cols, 0).select(*cols)
        parts.append(cast_all_but(df).withColumn("periodo", F.lit(period)))
    return parts[0].unionByName(parts[1])


@query("weekly_refresh_load", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2001-03-05'
UNION ALL
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-03-05' AND o_orderdate < TIMESTAMP '2001-03-08'
""")
def weekly_refresh_load(t):
    """D23/D24/D25 shape: the current week (Monday..run day, F7) is re-extracted
    and replaces what an earlier run loaded for it (K5), idempotently."""
    from carelake.functions.dates import current_week, in_days
    run = dt.date(2001, 3, 7)
    lo, hi = current_week(run)
    o = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    loaded = o.filter(F.col("o_orderdate") < F.lit(_ts(2001, 3, 8)))
    stale = loaded.withColumn("o_totalprice", F.when(in_days("o_orderdate", lo, hi), F.col("o_totalprice") * 0.5)
                              .otherwise(F.col("o_totalprice")))
    fresh = o.filter(in_days("o_orderdate", lo, hi))
    once = K.refresh_window_df(stale, fresh, "o_orderdate", _ts(lo.year, lo.month, lo.day))
    return K.refresh_window_df(once, fresh, "o_orderdate", _ts(lo.year, lo.month, lo.day))
