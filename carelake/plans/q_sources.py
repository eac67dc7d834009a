"""Registered source queries.

Each query lands driver-table data as the file shapes the sources read
(headerless ';' roll files with footer lines, sheet envelopes, monthly
extracts with lock files) in the shared work folder, reads them back with
the readers, and returns the table; the oracle is the same data in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.dates import in_range, period_path
from carelake.plans.registry import query
from carelake.session import work_dir
from carelake.sources import readers as R

ROLL_NAMES = ["id", "name", "site", "balance", "segment"]


@query("roll_files_footer", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS site,
       c_acctbal AS balance, c_mktsegment AS segment, CAST(c_nationkey % 5 AS VARCHAR) AS branch
FROM customer
""")
def roll_files_footer(t):
    """Five branch files (headerless ';', ISO-8859-1, two
    footer lines each) read in one scan with an imposed header; footers
    dropped by predicate; branch from the file path."""
    spark = t.customer.sparkSession
    base = work_dir(spark, "roll-files")
    parts = max(4, -(-t.customer.count() // 5_000_000))  # files of a branch: about a million lines each at most
    c = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").cast("string").alias("site"), F.col("c_acctbal").cast("string").alias("balance"),
                          F.col("c_mktsegment").alias("segment"), (F.col("c_nationkey") % 5).alias("branch"),
                          F.pmod(F.xxhash64("c_custkey"), F.lit(parts)).alias("part"), F.lit(0).alias("footer"))
    feet = c.groupBy("branch", "part").agg(F.count(F.lit(1)).cast("string").alias("name")).select(
        F.lit("TOTAL").alias("id"), "name", *[F.lit(None).cast("string").alias(x) for x in ("site", "balance", "segment")],
        "branch", "part", F.lit(1).alias("footer"))
    feet = feet.unionByName(feet.select(F.lit("Generado").alias("id"), *[F.lit(None).cast("string").alias(x) for x in
                                                                           ("name", "site", "balance", "segment")],
                                        "branch", "part", F.lit(2).alias("footer")))
    # At least four files per branch, footer lines last in each.
    (c.unionByName(feet).repartition("branch", "part").sortWithinPartitions("branch", "part", "footer", "id").drop("footer")
     .write.partitionBy("branch", "part").option("sep", ";").option("encoding", "ISO-8859-1").csv(f"{base}/roll"))
    paths = [f"{base}/roll/branch={b}/part={p}" for b in range(5) for p in range(parts)] + [f"{base}/roll/branch=missing"]
    df = R.scan_union(spark, paths, names=ROLL_NAMES, sep=";", encoding="ISO-8859-1",
                      dtypes={"balance": T.DoubleType()})
    df = R.drop_footer_rows(df, "id")
    return df.withColumn("branch", F.regexp_extract("source_file", r"branch=([0-9]+)", 1)).drop("source_file")


@query("sheet_envelope", """
SELECT CAST(n_nationkey AS VARCHAR) AS codigo, n_name AS nombre, r_name AS sheet
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def sheet_envelope(t):
    """One sheet per network region in the {columns, rows}
    envelope (bounded by the site list), read back as strings, tagged."""
    spark = t.nation.sparkSession
    base = work_dir(spark, "sheets")
    n = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    env = n.groupBy(F.col("r_name").alias("sheet")).agg(
        F.collect_list(F.array(F.col("n_nationkey").cast("string"), F.col("n_name"))).alias("rows")).withColumn(
        "columns", F.array(F.lit("codigo"), F.lit("nombre")))
    env.write.json(f"{base}/env")
    return R.scan_sheet(spark, f"{base}/env")


@query("sheet_headers_differ", """
SELECT CAST(n_nationkey AS VARCHAR) AS codigo, CASE WHEN n_regionkey <> 2 THEN n_name END AS nombre,
       CASE WHEN n_regionkey = 1 THEN 'x' END AS nota, CAST(n_regionkey AS VARCHAR) AS sheet
FROM nation
""")
def sheet_headers_differ(t):
    """Sheets whose headers differ in order and in columns; each value goes
    by its own sheet's header."""
    spark = t.nation.sparkSession
    base = work_dir(spark, "sheets-differ")
    code, name, r = F.col("n_nationkey").cast("string"), F.col("n_name"), F.col("n_regionkey")
    row = F.when(r == 1, F.array(F.lit("x"), name, code)).when(r == 2, F.array(code)).otherwise(F.array(code, name))
    head = F.when(r == 1, F.array(F.lit("nota"), F.lit("nombre"), F.lit("codigo"))).when(r == 2, F.array(F.lit("codigo"))).otherwise(
        F.array(F.lit("codigo"), F.lit("nombre")))
    t.nation.groupBy(r.cast("string").alias("sheet"), head.alias("columns")).agg(F.collect_list(row).alias("rows")).write.json(f"{base}/env")
    return R.scan_sheet(spark, f"{base}/env").select("codigo", "nombre", "nota", "sheet")


@query("header_names", """
SELECT CAST(c_custkey AS VARCHAR) AS "primerApellido", c_name AS "segundoNombre", '2001-03-15' AS "fechaCapita",
       CAST(c_nationkey AS VARCHAR) AS sede_atencion, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey END AS numero
FROM customer
""")
def header_names(t):
    """A file with its own header is read by it; names
    to camel and snake case, a literal and a derived column put in place,
    surplus columns dropped, digits-only text to integers."""
    from carelake.functions.coerce import int_if_digits
    from carelake.functions.names import camel, rename_with, snake
    from carelake.operators.shape import drop_cols, insert_at, select_required, with_literal
    spark = t.customer.sparkSession
    path = work_dir(spark, "headers") + "/file"
    k = F.col("c_custkey")
    t.customer.select(k.cast("string").alias("primer_apellido"), F.col("c_name").alias("segundo_nombre"),
                      F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit("x"))).otherwise(k.cast("string")).alias("Número-Raw"),
                      F.col("c_nationkey").cast("string").alias("SEDE  ATENCION"), F.lit("-").alias("sobra")).write.option(
        "header", "true").option("sep", ";").csv(path)
    df = spark.read.option("header", "true").option("sep", ";").csv(path)
    names = {c: (snake(c) if c.isupper() or "-" in c else camel(c)) for c in df.columns}
    df = drop_cols(rename_with(df, names.get), ["sobra", "no_such_column"])
    df = with_literal(df, "fecha_capita", "2001-03-15")
    df = insert_at(df, 1, "numero", int_if_digits("númeroraw")).withColumnRenamed("fecha_capita", camel("fecha_capita"))
    return select_required(df, ["primerApellido", "segundoNombre", "fechaCapita", "sede_atencion", "numero", "absent"], present_only=True)


@query("safe_header_spend", """
SELECT CAST(l_suppkey AS BIGINT) AS proveedor, CAST(count(*) FILTER (l_linenumber = 1) AS BIGINT) AS "aguja18gX1",
       CAST(count(*) FILTER (l_linenumber = 2) AS BIGINT) AS "aguja18gX1_2", CAST(count(*) FILTER (l_linenumber = 3) AS BIGINT) AS "c_2Crema",
       CAST(count(*) FILTER (l_linenumber >= 4) AS BIGINT) AS col, CAST(trunc(round(sum(l_extendedprice))) AS BIGINT) AS "valorTotal"
FROM lineitem GROUP BY 1
""")
def safe_header_spend(t):
    """Wide supply sheet whose headers repeat, start with digits or have no
    letters (P10), amounts as text with dot thousands (X5)."""
    from carelake.functions.coerce import locale_number
    from carelake.functions.names import camel_safe
    from carelake.operators.aggregate import conditional_sums
    n = F.col("l_linenumber")
    wide = conditional_sums(t.lineitem, "l_suppkey", {"n": F.lit(1)}, {"1": n == 1, "2": n == 2, "3": n == 3, "4": n >= 4})
    total = t.lineitem.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice")).alias("v"))
    sheet = wide.join(total, "l_suppkey").select(
        "l_suppkey", "n_1", "n_2", "n_3", "n_4", F.replace(F.format_number("v", 0), F.lit(","), F.lit(".")).alias("v"))
    out = sheet.toDF(*camel_safe(["Proveedor", "AGUJA 18G X 1", "AGUJA 18G X 1", "2% CREMA", "--", "VALOR TOTAL"]))
    return out.withColumn("valorTotal", locale_number("valorTotal", as_int=True))


@query("latest_extract", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '2001-06-01' AND o_orderdate < TIMESTAMP '2001-07-01'
""")
def latest_extract(t):
    """Monthly extracts named by period; lock files ignored; the
    newest period is read."""
    spark = t.orders.sparkSession
    base = work_dir(spark, "extracts")
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    for m in (4, 5, 6):
        run = dt.date(2001, m, 1)
        name = period_path("facturas_{yyyymm}", run)
        part = o.filter(in_range("o_orderdate", run, dt.date(2001, m + 1, 1))).drop("o_orderdate")
        part.write.parquet(f"{base}/{name}")
    o.limit(0).drop("o_orderdate").write.parquet(f"{base}/~$facturas_209912")
    # another prefix sorts behind, but its period is older
    o.limit(0).drop("o_orderdate").write.parquet(f"{base}/zz_facturas_200012")
    path = R.latest_file(spark, base, "*facturas_*")
    return spark.read.parquet(path)


@query("affiliate_roll_load", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_nationkey AS site,
       CAST(DATE '1990-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS DATE) AS birth_date,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
            THEN 1 ELSE 0 END AS sw_insulina,
       DATE '2001-03-15' AS fecha_capita, CAST(2 AS BIGINT) AS n_loads, (SELECT CAST(count(*) AS BIGINT) FROM customer) AS last_rows
FROM customer
""")
def affiliate_roll_load(t):
    """Headerless ';' roll file with an imposed header and one typed
    column (S5), dates parsed from text (X1), insulin mark from a semi-join
    flag (J8), monthly gate (G2) and a dual write (K4); returns the warehouse
    copy as far as the operational one has it, with the log read back. A second
    run in the month finds the gate closed."""
    import datetime as dt
    from carelake.functions.coerce import coerce_date
    from carelake.operators.lookup import flag_in, semi
    from carelake.operators.shape import broadcast_scalar
    from carelake.sinks.gates import gate
    from carelake.sinks.tables import append, dual_write, log_load, overwrite, read_log
    spark = t.customer.sparkSession
    base = work_dir(spark, "roll-load")
    born = F.date_add(F.lit(dt.date(1990, 1, 1)), (F.col("c_custkey") % 9000).cast("int"))
    raw = t.customer.select(F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"),
                            F.date_format(born, "dd/MM/yyyy"))
    raw.write.option("sep", ";").csv(f"{base}/landing")
    roll = R.scan_csv(spark, f"{base}/landing", names=["id", "name", "site", "birth_date"], sep=";",
                      dtypes={"site": T.IntegerType()})
    roll = roll.withColumn("birth_date", coerce_date("birth_date", "dd/MM/yyyy"))
    ins = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    roll = flag_in(roll, ins.select(F.col("o_custkey").cast("string").alias("k")), "id", "sw_insulina", right_on="k")
    roll = roll.withColumn("fecha_capita", F.lit(dt.date(2001, 3, 15)))
    # an earlier month's load is in the log: this month's gate is open
    log_load(spark, f"{base}/log", 1, "capita", dt.datetime(2001, 2, 15, 6))
    log = read_log(spark, f"{base}/log")
    if gate(log, "capita", "monthly", dt.date(2001, 3, 15)).first()["proceed"] == 1:
        n, _ = dual_write(roll, lambda d: overwrite(d, f"{base}/operational"), lambda d: append(d, f"{base}/warehouse"))
        log_load(spark, f"{base}/log", n, "capita", dt.datetime(2001, 3, 15, 6))
    if gate(read_log(spark, f"{base}/log"), "capita", "monthly", dt.date(2001, 3, 20)).first()["proceed"] == 1:
        append(roll, f"{base}/warehouse")  # the gate is closed now: never reached
    same = semi(spark.read.parquet(f"{base}/warehouse"), spark.read.parquet(f"{base}/operational"), ["id", "name", "site", "birth_date"])
    loads = read_log(spark, f"{base}/log").agg(F.count(F.lit(1)).alias("n_loads"), F.max("totalRegistros").alias("last_rows"))
    return broadcast_scalar(same, loads)
