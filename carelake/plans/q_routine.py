"""Registered routine loads whose shapes the other modules don't have: the surgery
day file, collections of the current week, active staff, and three of the
simple loads (D24-D27). Each goes landed file -> typed -> gated -> written ->
read back, and runs more than once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from carelake.functions import coerce as C
from carelake.functions.dates import current_week, in_days, in_range, prev_iso_week, prev_month
from carelake.functions.names import camel
from carelake.operators.shape import cast_groups
from carelake.plans.registry import query
from carelake.session import work_dir
from carelake.sinks import gates as G
from carelake.sinks import tables as K
from carelake.sources import readers as R


def _open(spark, base: str, table: str, grain: str, day: dt.date) -> bool:
    return G.gate(K.read_log(spark, f"{base}/log"), table, grain, day).first()["proceed"] == 1


def _log(spark, base: str, n: int, table: str, day: dt.date) -> None:
    K.log_load(spark, f"{base}/log", n, table, dt.datetime.combine(day, dt.time(6)))


# ---------------------------------------------------------------- D24
# The view's columns by type; a day's file may lack some of them.
_TEXT, _WHOLE, _AMOUNT, _DAYS = ("mode",), ("order_id", "line", "minutes"), ("cost", "copay"), ("day",)


@query("surgery_daily_view", """
SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_linenumber AS BIGINT) AS line, l_linestatus AS mode, CAST(l_shipdate AS DATE) AS day,
  CASE WHEN l_linenumber = 2 THEN 0.0 ELSE round(l_extendedprice, 2) END AS cost,
  CASE WHEN CAST(l_shipdate AS DATE) = DATE '2001-04-03' THEN NULL ELSE round(l_discount, 2) END AS copay,
  CASE WHEN CAST(l_shipdate AS DATE) = DATE '2001-04-03' THEN CAST(l_quantity AS BIGINT) END AS minutes
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-04-02' AND l_shipdate < TIMESTAMP '2001-04-05'
""")
def surgery_daily_view(t):
    """D24 daily view: each day's file has the columns that the view had on that
    day; those that are there are typed by list (P16), others are NULL in the
    table; a daily gate (G1) stops the day's second run; a day without rows
    loads and logs nothing."""
    spark = t.lineitem.sparkSession
    base = work_dir(spark, "surgery-view")
    day = F.to_date("l_shipdate")
    li = t.lineitem.filter(in_range("l_shipdate", dt.date(2001, 4, 2), dt.date(2001, 4, 5))).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_linestatus").alias("mode"),
        F.when(F.col("l_linenumber") == 2, "s/d").otherwise(F.format_string("%.2f", F.round("l_extendedprice", 2))).alias("cost"),
        F.format_string("%.2f", F.round("l_discount", 2)).alias("copay"), F.col("l_quantity").cast("bigint").alias("minutes"), day.alias("day"))
    usual = ["order_id", "line", "mode", "cost", "copay", "day"]
    files = {dt.date(2001, 4, 2): usual, dt.date(2001, 4, 3): ["minutes", "day", "line", "order_id", "mode", "cost"], dt.date(2001, 4, 4): usual}
    for d, cols in files.items():
        li.filter(in_days("day", d, d)).select(*cols).write.option("header", "true").csv(f"{base}/landing-{d}")
    kind = "order_id bigint, line bigint, mode string, day date, cost double, copay double, minutes bigint"
    for d in (*files, dt.date(2001, 4, 3), dt.date(2001, 4, 5)):
        found = R.existing_paths(spark, [f"{base}/landing-{d}"])
        if not found or not _open(spark, base, "surgeryView", "daily", d):
            continue
        raw = R.scan_csv(spark, found, header=True)
        typed = cast_groups(raw, strings=[c for c in _TEXT if c in raw.columns], ints=[c for c in _WHOLE if c in raw.columns],
                            floats=[c for c in _AMOUNT if c in raw.columns], dates=[c for c in _DAYS if c in raw.columns])
        n = K.append(typed, f"{base}/table")
        if n:
            _log(spark, base, n, "surgeryView", d)
    return spark.read.schema(kind).parquet(f"{base}/table")


# ---------------------------------------------------------------- D25
@query("collections_current_week", """
SELECT CAST(o_orderkey AS BIGINT) AS "reciboCaja", CAST(o_orderdate AS DATE) AS "fechaPago", round(o_totalprice, 2) AS "valorPagado",
  CASE WHEN o_orderdate >= TIMESTAMP '2001-05-07' THEN 'new' ELSE 'old' END AS estado
FROM orders WHERE o_orderdate >= TIMESTAMP '2001-05-01' AND o_orderdate < TIMESTAMP '2001-05-12'
  AND NOT (o_orderdate >= TIMESTAMP '2001-05-07' AND o_orderkey % 9 = 0)
""")
def collections_current_week(t):
    """D25 weekly: the table's rows from Monday of the run's week on (F7) are
    deleted and the week so far is extracted again (K5), headers in camel case
    (P9), dates and amounts typed. Runs of Wednesday and Friday: rows that
    the source has corrected or withdrawn meanwhile are so in the table too."""
    spark = t.orders.sparkSession
    base = work_dir(spark, "collections-week")
    o = t.orders.filter(in_range("o_orderdate", dt.date(2001, 5, 1), dt.date(2001, 5, 12)))
    amount = F.round("o_totalprice", 2)
    headers = ["RECIBO_CAJA", "FECHA_PAGO", "VALOR_PAGADO", "ESTADO"]
    names = [camel(h, "lower_all") for h in headers]

    def extract(rows, state, value):
        return rows.select(F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "dd/MM/yyyy"), F.format_string("%.2f", value), F.lit(state)).toDF(*headers)

    def typed(path):
        raw = R.scan_csv(spark, path, header=True, sep=";").toDF(*names)
        return raw.select(C.coerce_int("reciboCaja").alias("reciboCaja"), C.coerce_date("fechaPago", "dd/MM/yyyy").alias("fechaPago"),
                          C.coerce_float("valorPagado").alias("valorPagado"), "estado")

    before, week = F.col("o_orderdate") < F.lit(dt.datetime(2001, 5, 7)), F.col("o_orderdate") >= F.lit(dt.datetime(2001, 5, 7))
    extract(o.filter(before), "old", amount).write.option("header", "true").option("sep", ";").csv(f"{base}/old")
    K.overwrite(typed(f"{base}/old"), f"{base}/table")
    for run in (dt.date(2001, 5, 9), dt.date(2001, 5, 11)):
        lo, hi = current_week(run)
        last = run.day == 11  # by then some receipts are withdrawn and the amounts are right
        rows = o.filter(week & in_days("o_orderdate", lo, hi) & ((F.col("o_orderkey") % 9 != 0) | F.lit(not last)))
        extract(rows, "new", amount if last else -amount).write.option("header", "true").option("sep", ";").csv(f"{base}/landing-{run}")
        K.refresh_window(spark, f"{base}/table", typed(f"{base}/landing-{run}"), "fechaPago", lo)
    return spark.read.parquet(f"{base}/table")


# ---------------------------------------------------------------- D26
@query("workforce_active", """
SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE CAST(s_suppkey % 4 AS BIGINT) END AS children,
  CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE CAST(trunc(s_acctbal) AS BIGINT) + 1 END AS salary,
  CASE WHEN s_suppkey % 7 <> 0 THEN DATE '2010-01-01' + CAST(s_suppkey % 3000 AS INTEGER) END AS hired,
  CASE WHEN s_suppkey % 3 = 0 THEN DATE '2020-01-01' + CAST(s_suppkey % 300 AS INTEGER) END AS contract_ends
FROM supplier WHERE s_suppkey % 11 <> 0
""")
def workforce_active(t):
    """D26 active staff: the whole list replaces the table (K2) once a week
    (G3): blank children and missing salaries are 0, dates that don't parse
    are NULL. The first week's list is replaced by the second's, in which some
    have left and all earn more; a run later in that week changes nothing."""
    spark = t.supplier.sparkSession
    base = work_dir(spark, "active")
    k = F.col("s_suppkey")
    for d, more in ((dt.date(2001, 6, 6), 0), (dt.date(2001, 6, 13), 1), (dt.date(2001, 6, 15), 2)):
        staff = t.supplier.filter((k % 11 != 0) | F.lit(more == 0)).select(
            k.cast("string").alias("id"), "s_name", F.when(k % 4 == 0, "").otherwise((k % 4).cast("string")).alias("children"),
            F.when(k % 5 != 0, F.format_string("%.2f", F.signum("s_acctbal") * F.floor(F.abs("s_acctbal")) + more)).alias("salary"),
            F.when(k % 7 == 0, "0000-00-00").otherwise(F.date_add(F.lit(dt.date(2010, 1, 1)), (k % 3000).cast("int")).cast("string")).alias("hired"),
            F.when(k % 3 == 0, F.date_add(F.lit(dt.date(2020, 1, 1)), (k % 300).cast("int")).cast("string")).otherwise("indefinido").alias("ends"))
        staff.write.option("sep", ";").csv(f"{base}/landing-{d}")
        if _open(spark, base, "active", "weekly", d):
            raw = R.scan_csv(spark, f"{base}/landing-{d}", names=["id", "name", "children", "salary", "hired", "contract_ends"], sep=";")
            _log(spark, base, K.overwrite(cast_groups(raw, ints=("id", "children", "salary"), dates=("hired", "contract_ends")), f"{base}/table"), "active", d)
    return spark.read.parquet(f"{base}/table")


# ---------------------------------------------------------------- D27
@query("risk_full_refresh", """
SELECT CAST(c_custkey AS BIGINT) AS id, c_mktsegment AS risk, DATE '2001-06-08' AS updated FROM customer WHERE c_custkey % 13 <> 0
""")
def risk_full_refresh(t):
    """D27 risk: every run replaces the table by the whole extract, whatever
    columns it has, marked with the run's date; an empty extract leaves the
    table as it is (the reference's intent: nothing to load)."""
    spark = t.customer.sparkSession
    path = work_dir(spark, "risk") + "/table"
    c = t.customer.select(F.col("c_custkey").cast("bigint").alias("id"), F.col("c_mktsegment").alias("risk"))
    extracts = {dt.date(2001, 6, 7): c.withColumn("score", F.lit(1)), dt.date(2001, 6, 8): c.filter("id % 13 <> 0"), dt.date(2001, 6, 9): c.filter("id < 0")}
    for run, rows in extracts.items():
        if not rows.isEmpty():
            K.overwrite(rows.withColumn("updated", F.lit(run)), path)
    return spark.read.parquet(path)


@query("disability_previous_month", """
SELECT CAST(event_id AS BIGINT) AS "numeroIncapacidad", CAST(ts AS DATE) AS "fechaIngresoSistemaId", CAST(event_id % 30 AS BIGINT) AS "diasIncapacidad"
FROM events WHERE ts < TIMESTAMP '2024-02-01'
""")
def disability_previous_month(t):
    """D27 disability: the month before the run (F10; in January the December
    before) is appended unless the table has a row of it (G4 probe), headers in
    camel case (P9). Runs of January, February and, again, February."""
    spark = t.events.sparkSession
    base = work_dir(spark, "disability")
    e = t.events.select(F.col("event_id").cast("bigint").alias("NUMERO_INCAPACIDAD"), F.to_date("ts").alias("FECHA_INGRESO_SISTEMA_ID"),
                        (F.col("event_id") % 30).cast("bigint").alias("DIAS_INCAPACIDAD"))
    e = e.toDF(*[camel(c, "lower_all") for c in e.columns])
    spark.createDataFrame([], e.schema).write.parquet(f"{base}/table")
    for run in (dt.date(2024, 1, 10), dt.date(2024, 2, 10), dt.date(2024, 2, 20)):
        lo, hi = prev_month(run)
        if not G.range_probe(spark.read.parquet(f"{base}/table"), "fechaIngresoSistemaId", lo, hi).first()[0]:
            K.append(e.filter(F.col("fechaIngresoSistemaId").between(F.lit(lo), F.lit(hi))), f"{base}/table")
    return spark.read.parquet(f"{base}/table")


@query("lab_week_export", """
SELECT event_id, CAST(user_id AS BIGINT) AS user_id, CAST(ts AS TIMESTAMP) AS ts, '2024-01-07_2024-01-14' AS week
FROM events WHERE ts >= TIMESTAMP '2024-01-07' AND ts < TIMESTAMP '2024-01-15'
""")
def lab_week_export(t):
    """D27 weekly lab extract: the rows of last Sunday and the seven days before
    it (F10), without their time zone (X34), go to a file named by both days
    (K14); a week without rows writes none; the newest file is read back (S13)."""
    spark = t.events.sparkSession
    base = work_dir(spark, "lab-week")
    lab = t.events.select("event_id", F.col("user_id").cast("bigint").alias("user_id"), F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC").alias("ts"))
    written = []
    for run in (dt.date(2024, 1, 17), dt.date(2034, 1, 18)):
        lo, hi = prev_iso_week(run)
        week = lab.filter(in_days("ts", lo, hi)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        if K.export_csv(week, f"{base}/estadisticas {lo}_{hi}"):
            written.append(f"{lo}_{hi}")
    back = R.scan_csv(spark, f"{base}/estadisticas {written[-1]}", names=["event_id", "user_id", "ts"], sep=";", header=True)
    return back.select(F.col("event_id").try_cast("bigint").alias("event_id"), C.coerce_int("user_id").alias("user_id"),
                       F.col("ts").try_cast("timestamp_ntz").alias("ts"), F.lit(written[-1]).alias("week"))
