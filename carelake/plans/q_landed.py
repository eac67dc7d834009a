"""Registered queries over landed files and sheets: positions, drifting schemas, the form catalogue, and the loads of
D23-D28 that differ in shape (landed -> typed -> gated -> written -> read back)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions import coerce as C
from carelake.functions.dates import in_days, in_range, prev_week
from carelake.operators import filters as FL
from carelake.operators import forms as FO
from carelake.operators.aggregate import distinct_with_total
from carelake.operators.lookup import anti, match_phrases
from carelake.operators.shape import cast_groups, datetime_text
from carelake.plans.registry import query
from carelake.session import work_dir
from carelake.sinks import gates as G
from carelake.sinks import tables as K
from carelake.sources import readers as R


# ---------------------------------------------------------------- S7, F13 by position
@query("roll_lines_by_position", """
WITH f AS (SELECT c_nationkey AS branch, c_custkey AS id, c_name AS name,
                  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS line_no,
                  count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
SELECT CAST(id AS VARCHAR) AS id, name, CAST(line_no AS BIGINT) AS line_no, CAST(n + 5 AS BIGINT) AS n_lines FROM f
""")
def roll_lines_by_position(t):
    """Branch files whose two last lines look like any other, and that
    end before them with a blank line and notes: the data is what stands
    before the first blank line, after the last two lines are dropped, by line
    number alone."""
    spark = t.customer.sparkSession
    path = work_dir(spark, "positions") + "/rolls"
    c = t.customer.select(F.col("c_nationkey").alias("branch"), F.col("c_custkey").cast("bigint").alias("at"),
                          F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name").alias("value"))
    top = 1 << 60
    ends = c.select("branch").distinct().select("branch", F.explode(F.array(*[
        F.struct(F.lit(top + i).alias("at"), F.lit(v).alias("value")) for i, v in enumerate(["", "1;a note", "2;a note", "98;total", "99;total"])])).alias("x"))
    rows = c.unionByName(ends.select("branch", "x.at", "x.value")).repartition("branch").sortWithinPartitions("branch", "at")
    rows.select("branch", "value").write.partitionBy("branch").text(path)
    lines = R.drop_last_lines(R.scan_lines(spark, path), 2)
    lines = FL.truncate_at_blank(lines, ["value"], order="line_no", by="source_file")
    return R.parse_lines(lines, ["id", "name"], sep=";").select("id", "name", "line_no", "n_lines")


# ---------------------------------------------------------------- A10
@query("distinct_totals_bitmap", """
SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'TOTAL' ELSE o_orderpriority END AS o_orderpriority,
       CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT o_custkey) AS BIGINT) AS patients,
       CAST(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS BIGINT) AS closed
FROM orders GROUP BY GROUPING SETS ((o_orderpriority), ())
""")
def distinct_totals_bitmap(t):
    """A10/A5: distinct patients and closed encounters per priority and over
    the network, the total from the priorities' bitmaps."""
    o = t.orders.select("o_orderpriority", F.lit(1).alias("one"), F.col("o_custkey").cast("bigint").alias("pat"),
                        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("bigint")).alias("enc"))
    return distinct_with_total(o, "o_orderpriority", {"patients": "pat", "closed": "enc"}, {"n": "one"}, "TOTAL")


# ---------------------------------------------------------------- D5, S9
@query("roll_schema_drift", """
SELECT month, id, CAST(age AS DOUBLE) AS age, site, score, loaded FROM (
SELECT 'm1' AS month, CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey % 90 AS DECIMAL(38,9)) AS age, CAST(c_nationkey AS VARCHAR) AS site,
       CAST(NULL AS DOUBLE) AS score, CAST(DATE '2001-01-15' AS TIMESTAMP) AS loaded FROM customer
UNION ALL SELECT 'm2', CAST(c_custkey AS VARCHAR), CAST(c_custkey AS BIGINT) * 100000000, 'S' || c_nationkey, CAST(c_custkey % 7 AS DOUBLE), DATE '2001-02-15' FROM customer
UNION ALL SELECT 'm3', lpad(CAST(c_custkey AS VARCHAR), 9, '0'), CAST(CAST(c_custkey AS DECIMAL(18,2)) * 0.25 AS DECIMAL(38,9)), NULL, c_acctbal, TIMESTAMP '2001-03-15 06:30:00' FROM customer
UNION ALL SELECT 'm4', CAST(c_custkey AS VARCHAR), NULL, CAST(c_nationkey AS VARCHAR), NULL, DATE '2001-04-15' FROM customer) x
""")
def roll_schema_drift(t):
    """Four landed monthly rolls whose columns come in other orders,
    spellings and types; one schema is read from them (int < long < decimal,
    date < timestamp, else text), the id column is text by override, and
    absent columns are NULL."""
    spark = t.customer.sparkSession
    base = work_dir(spark, "drift")
    k, site = F.col("c_custkey"), F.col("c_nationkey")
    months = [
        t.customer.select(k.cast("int").alias("id"), (k % 90).cast("int").alias("age"), site.cast("int").alias("site"), F.lit(dt.date(2001, 1, 15)).alias("loaded")),
        t.customer.select((k % 7).cast("int").alias("score"), k.cast("bigint").alias("ID "), (k.cast("bigint") * 100_000_000).alias("Age"),
                          F.concat(F.lit("S"), site.cast("string")).alias("site"), F.lit(dt.date(2001, 2, 15)).alias("loaded")),
        t.customer.select(F.lpad(k.cast("string"), 9, "0").alias("id"), (k.cast("decimal(12,2)") / 4).cast("decimal(12,4)").alias("age"),
                          F.col("c_acctbal").alias("score"), F.lit(dt.datetime(2001, 3, 15, 6, 30)).cast("timestamp_ntz").alias("loaded")),
        t.customer.select(k.cast("string").alias("id"), site.cast("string").alias("site"), F.lit(dt.date(2001, 4, 15)).alias("loaded")),
    ]
    paths = [f"{base}/m{i + 1}" for i in range(len(months))]
    for df, p in zip(months, paths):
        df.write.parquet(p)
    out = R.scan_drifting(spark, paths, {"id": T.StringType()})
    return out.select(F.col("source_file").alias("month"), "id", F.col("age").cast("double").alias("age"), "site", "score", "loaded")


# ---------------------------------------------------------------- D22
#: The sixteen forms: name, headers of (id, question, percent, date, count, yes/no; "" where the form has none), and whether the count is required.
_FORMS = [
    ("aiepi", "ID", "Pregunta", "Calificación", "Fecha", "", "Cumple", False),
    ("cirugia", "id", "PREGUNTA", "calificacion %", "", "Cantidad", "", True),
    ("pgp", "Id", "Pregunta\n", "Calificación", "fecha auditoria", "Cantidad", "Cumple", False),
    ("rcv", "ID ", "Item", "Calificación", "Fecha", "", "", False),
    ("cpr", "ID", "Pregunta", "", "Fecha", "Controles", "Cumple", True),
    ("rias", "ID", '"Pregunta"', "Calificación", "Fecha", "Cantidad", "Cumple", False),
    ("modelo reumatologia", "ID", "Pregunta", "Calificación", "", "", "Cumple", False),
    ("planificacion", "ID", "Pregunta", "", "Fecha", "", "Cumple", False),
    ("procedimientos menores", "ID", "Procedimiento", "Calificación", "Fecha", "Cantidad", "", False),
    ("consultas especialistas", "ID", "Pregunta", "Calificación", "Fecha", "", "", False),
    ("conceptos clinicos especialistas", "ID", "Concepto", "Calificación", "", "", "", False),
    ("conceptos clinicos ips basicas", "ID", "Concepto", "Calificación", "Fecha", "", "", False),
    ("especialidades basicas", "ID", "Pregunta", "Calificación", "Fecha", "Cantidad", "Cumple", True),
    ("externos", "ID", "Pregunta", "", "", "Cantidad", "Cumple", False),
    ("recobro pgp", "ID", "Pregunta", "", "Fecha", "Cantidad", "", True),
    ("plan contingencia", "ID", "Pregunta", "Calificación", "Fecha", "", "Cumple", False),
]


def _spec(name, row_id, question, pct, date, count, yes, required) -> FO.FormSpec:
    fields = {"pregunta": (question, "text"), "calificacion": (pct, "percent"), "fecha": (date, "date"), "cantidad": (count, "whole"), "cumple": (yes, "yes_no")}
    fields = {k: v for k, v in fields.items() if v[0]}
    return FO.FormSpec(name, row_id, fields, tuple(f for f in ("pregunta", "calificacion") if f in fields), ("cantidad",) if required else ())


_FORMS_SQL = f"""WITH spec(k, form, p, d, c, y, req) AS (VALUES {", ".join(
    f"({i}, '{f[0]}', {bool(f[3])}, {bool(f[4])}, {bool(f[5])}, {bool(f[6])}, {f[7]})" for i, f in enumerate(_FORMS))}),
s AS (SELECT form, o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS row_id, req, c,
  CASE WHEN o_orderkey % 50 = 0 THEN ' ' ELSE o_orderpriority END AS q,
  CASE WHEN p THEN CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'n/a'
       ELSE CAST(CAST(trunc(o_totalprice) AS BIGINT) % 100 AS VARCHAR) || ',5%' END END AS pct,
  CASE WHEN d THEN CASE WHEN o_orderkey % 29 = 0 THEN 's/f' WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%d/%m/%Y') END END AS date,
  CASE WHEN c THEN CASE WHEN o_orderkey % 31 = 0 THEN '12 a' WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END END AS count,
  CASE WHEN y THEN CASE WHEN o_orderkey % 37 = 0 THEN 'tal vez' WHEN o_orderkey % 5 = 0 THEN 'si ' ELSE 'NO' END END AS yes,
  CAST(o_orderdate AS DATE) AS day, o_custkey
  FROM orders JOIN spec ON k = o_orderkey % 16 WHERE NOT o_orderkey % 50 = 0)"""


@query("audit_forms_catalogue", f"""{_FORMS_SQL}
SELECT 'row' AS part, form, row_id, q AS pregunta, CASE WHEN pct <> 'n/a' THEN CAST(replace(replace(pct, '%', ''), ',', '.') AS DOUBLE) / 100 END AS calificacion,
  CASE WHEN date <> 's/f' THEN day END AS fecha, CAST(CASE WHEN count NOT IN ('', '12 a') THEN o_custkey END AS BIGINT) AS cantidad,
  CASE yes WHEN 'NO' THEN 0 WHEN 'si ' THEN 1 END AS cumple, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS raw, CAST(NULL AS VARCHAR) AS reason FROM s
UNION ALL SELECT 'finding', form, row_id, NULL, NULL, NULL, NULL, NULL, 'calificacion', pct, 'not a percent' FROM s WHERE pct = 'n/a'
UNION ALL SELECT 'finding', form, row_id, NULL, NULL, NULL, NULL, NULL, 'fecha', date, 'not a date' FROM s WHERE date = 's/f'
UNION ALL SELECT 'finding', form, row_id, NULL, NULL, NULL, NULL, NULL, 'cantidad', count, CASE count WHEN '' THEN 'missing' ELSE 'not a whole' END
  FROM s WHERE count = '12 a' OR (count = '' AND req)
UNION ALL SELECT 'finding', form, row_id, NULL, NULL, NULL, NULL, NULL, 'cumple', yes, 'not a yes_no' FROM s WHERE yes = 'tal vez'
""")
def audit_forms_catalogue(t):
    """The sixteen audit forms through one engine and a catalogue of
    specifications; rows and quarantine (form, row, field, raw cell, reason) come
    from one written table."""
    spark = t.orders.sparkSession
    path = work_dir(spark, "forms") + "/table"
    k = F.col("o_orderkey")
    raw = {
        1: k.cast("string"), 2: F.when(k % 50 == 0, " ").otherwise(F.col("o_orderpriority")),
        3: F.when(k % 50 == 0, F.lit(None)).when(k % 23 == 0, "n/a").otherwise(F.concat((F.col("o_totalprice").cast("bigint") % 100).cast("string"), F.lit(",5%"))),
        4: F.when(k % 29 == 0, "s/f").when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")),
        5: F.when(k % 31 == 0, "12 a").when(k % 3 == 0, "").otherwise(F.col("o_custkey").cast("string")),
        6: F.when(k % 37 == 0, "tal vez").when(k % 5 == 0, "si ").otherwise("NO"),
    }
    sheets = {f[0]: t.orders.filter(k % 16 == i).select(*[raw[j].alias(f[j]) for j in range(1, 7) if f[j]]) for i, f in enumerate(_FORMS)}
    K.overwrite(FO.read_forms(sheets, [_spec(*f) for f in _FORMS]), path)
    forms = spark.read.parquet(path)
    rows = FO.clean_rows(forms).withColumn("part", F.lit("row"))
    out = rows.unionByName(FO.quarantine_rows(forms).withColumn("part", F.lit("finding")), allowMissingColumns=True)
    return out.select("part", "form", "row_id", "pregunta", "calificacion", "fecha", "cantidad", "cumple", "field", "raw", "reason")


# ---------------------------------------------------------------- D28
_PLAIN = "' ' || trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"


@query("subject_matching", f"""
WITH c AS (SELECT conv_id, turn, role, {_PLAIN.format('text')} AS t FROM conversations),
s AS (SELECT min(conv_id) AS subject_id, subject FROM (SELECT conv_id, array_to_string(list_slice(string_split(trim(t), ' '), 1, 1 + conv_id % 2), ' ') AS subject
      FROM c WHERE turn = 0 AND trim(t) <> '') x GROUP BY subject),
m AS (SELECT subject_id, subject, c.conv_id, c.turn FROM c JOIN s ON contains(c.t, ' ' || s.subject || ' ') WHERE c.role = 'user' AND c.turn > 0)
SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m d WHERE d.turn <= 2 AND d.subject_id % 4 = 0 AND d.subject_id = m.subject_id)
""")
def subject_matching(t):
    """The subjects (the first word or two of each thread) against the text of all later
    user messages, every match recorded, less the subjects that were detected
    earlier (J7)."""
    c = t.conversations
    from carelake.operators.lookup import plain_words
    first = F.concat_ws(" ", F.slice(F.split(F.trim(plain_words("text")), " "), F.lit(1), (1 + F.col("conv_id") % 2).cast("int")))
    subjects = c.filter("turn = 0").select("conv_id", first.alias("subject")).filter("subject <> ''").groupBy("subject").agg(F.min("conv_id").alias("subject_id"))
    inbox = c.filter("role = 'user' and turn > 0").select("conv_id", "turn", "text")
    found = match_phrases(inbox, subjects, "text", "subject").select("subject_id", "subject", "conv_id", "turn")
    done = found.filter("turn <= 2 and subject_id % 4 = 0").select("subject_id").distinct()
    return anti(found, done, "subject_id")


# ---------------------------------------------------------------- D24
_LINE = ["order_id", "line", "supplier", "cost", "day"]


def _typed_lines(raw):
    return raw.select(C.coerce_int("order_id").alias("order_id"), C.coerce_int("line").alias("line"), C.coerce_int("supplier").alias("supplier"),
                      C.locale_number("cost").alias("cost"), C.coerce_date("day", "dd/MM/yyyy").alias("day"))


def _text_lines(li):
    """Invoice lines as a landed file has them: all text, costs like 1.234,50."""
    amount = F.translate(F.format_number(F.round("l_extendedprice", 2), 2), ",.", ".,")
    return li.select(F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").cast("string").alias("line"),
                     F.col("l_suppkey").cast("string").alias("supplier"), amount.alias("cost"), F.date_format("l_shipdate", "dd/MM/yyyy").alias("day"))


_LINE_SQL = """SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_linenumber AS BIGINT) AS line, CAST(l_suppkey AS BIGINT) AS supplier,
  round(l_extendedprice, 2) AS cost, CAST(l_shipdate AS DATE) AS day FROM lineitem"""


@query("surgery_cost_weekly", f"""
SELECT *, CAST(1 AS BIGINT) AS n_loads FROM ({_LINE_SQL}) x WHERE day >= DATE '2001-02-01' AND day <= DATE '2001-03-11'
""")
def surgery_cost_weekly(t):
    """D24 weekly refresh: the file of the previous week (F6) replaces that
    week's rows of the table (K5), typed from text (X5), behind a weekly gate
    (G3) that the second run of the week finds closed; read back with its log."""
    spark = t.lineitem.sparkSession
    base = work_dir(spark, "surgery-week")
    li = t.lineitem.filter(in_range("l_shipdate", dt.date(2001, 2, 1), dt.date(2001, 3, 12)))
    run = dt.date(2001, 3, 14)
    lo, hi = prev_week(run)
    old = _typed_lines(_text_lines(li)).withColumn("cost", F.when(F.col("day") >= F.lit(lo), -F.col("cost")).otherwise(F.col("cost")))
    K.overwrite(old.filter(F.col("line") < 6), f"{base}/table")  # last week came incomplete and wrong
    K.append(old.filter((F.col("line") >= 6) & (F.col("day") < F.lit(lo))), f"{base}/table")
    _text_lines(li.filter(in_days("l_shipdate", lo, hi))).write.option("sep", ";").csv(f"{base}/landing")
    for day in (run, run + dt.timedelta(days=1)):
        if G.gate(K.read_log(spark, f"{base}/log"), "surgery", "weekly", day).first()["proceed"] == 1:
            week = _typed_lines(R.scan_csv(spark, f"{base}/landing", names=_LINE, sep=";"))
            K.refresh_window(spark, f"{base}/table", week, "day", lo)
            K.log_load(spark, f"{base}/log", week.count(), "surgery", dt.datetime.combine(day, dt.time(6)))
    loads = K.read_log(spark, f"{base}/log").agg(F.count(F.lit(1)).alias("n_loads"))
    return spark.read.parquet(f"{base}/table").crossJoin(F.broadcast(loads))


@query("surgery_consumption_sheet", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS consumo, CAST(l_suppkey AS VARCHAR) AS proveedor,
       CAST(l_quantity AS BIGINT) AS cantidad, CAST(l_extendedprice AS DOUBLE) AS valor, CAST(l_shipdate AS DATE) AS fecha
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-10' AND l_shipdate < TIMESTAMP '2001-07-01' AND l_orderkey % 13 <> 0
""")
def surgery_consumption_sheet(t):
    """D24 consumption sheet: two sheets in the envelope form (S4) with cast
    groups (P16) and a floor on the parsed date that also drops bad dates
    (F19); new consumptions by text id are appended (G7), twice; read back."""
    spark = t.lineitem.sparkSession
    base = work_dir(spark, "consumption")
    li = t.lineitem.filter(in_range("l_shipdate", dt.date(2001, 6, 1), dt.date(2001, 7, 1)))
    day = F.when(F.col("l_orderkey") % 13 == 0, "pendiente").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy"))
    cells = F.array(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")), F.col("l_suppkey").cast("string"),
                    F.col("l_quantity").cast("bigint").cast("string"), F.col("l_extendedprice").cast("string"), day)
    (li.groupBy(F.col("l_linestatus").alias("sheet"), F.pmod(F.xxhash64("l_orderkey"), F.lit(16)).alias("part")).agg(F.collect_list(cells).alias("rows"))
     .select("sheet", "rows", F.array(*map(F.lit, ("consumo", "proveedor", "cantidad", "valor", "fecha"))).alias("columns")).write.json(f"{base}/sheet"))
    raw = cast_groups(R.scan_sheet(spark, f"{base}/sheet", tag=None), strings=("consumo", "proveedor"), ints=("cantidad",), floats=("valor",))
    typed = FL.since_coerced(raw, C.coerce_date("fecha", "dd/MM/yyyy"), dt.date(2001, 6, 10)).withColumn("fecha", C.coerce_date("fecha", "dd/MM/yyyy"))
    spark.createDataFrame([], typed.schema).write.parquet(f"{base}/table")
    for _ in range(2):
        target = spark.read.parquet(f"{base}/table")
        K.append(G.new_ids(typed, target, "consumo").checkpoint(eager=True), f"{base}/table")
    return spark.read.parquet(f"{base}/table")


@query("supply_spend_landed", """
SELECT CAST(l_suppkey AS BIGINT) AS proveedor, CAST(count(*) FILTER (l_linenumber = 1) AS BIGINT) AS "aguja18gX1",
       CAST(count(*) FILTER (l_linenumber = 2) AS BIGINT) AS "aguja18gX1_2", CAST(count(*) FILTER (l_linenumber = 3) AS BIGINT) AS "c_2Crema",
       CAST(count(*) FILTER (l_linenumber >= 4) AS BIGINT) AS col, CAST(trunc(round(sum(l_extendedprice))) AS BIGINT) AS "valorTotal"
FROM lineitem GROUP BY 1
""")
def supply_spend_landed(t):
    """D24 supply spend: the wide file with repeated and unusable headers lands
    as text; its header line names the columns safely (P10), amounts have dot
    thousands (X5); a monthly gate (G2), then truncate and reload (K2); read back."""
    from carelake.functions.names import camel_safe
    from carelake.operators.aggregate import conditional_sums
    spark = t.lineitem.sparkSession
    base = work_dir(spark, "spend")
    n = F.col("l_linenumber")
    wide = conditional_sums(t.lineitem, "l_suppkey", {"n": F.lit(1)}, {"1": n == 1, "2": n == 2, "3": n == 3, "4": n >= 4})
    total = t.lineitem.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice")).alias("v"))
    headers = ["Proveedor", "AGUJA 18G X 1", "AGUJA 18G X 1", "2% CREMA", "--", "VALOR TOTAL"]
    sheet = wide.join(total, "l_suppkey").select("l_suppkey", "n_1", "n_2", "n_3", "n_4", F.replace(F.format_number("v", 0), F.lit(","), F.lit(".")).alias("v"))
    sheet.select(F.concat_ws("|", *[F.col(c).cast("string") for c in sheet.columns])).write.text(f"{base}/landing")
    spark.createDataFrame([("|".join(headers),)], "value string").coalesce(1).write.text(f"{base}/header")
    names = camel_safe(spark.read.text(f"{base}/header").first()[0].split("|"))  # one line
    raw = R.scan_csv(spark, f"{base}/landing", names=names, sep="|")
    typed = raw.select(*[(C.locale_number if c == "valorTotal" else C.coerce_int)(c, **({"as_int": True} if c == "valorTotal" else {})).alias(c) for c in names])
    for day in (dt.date(2001, 6, 5), dt.date(2001, 6, 6)):
        if G.gate(K.read_log(spark, f"{base}/log"), "spend", "monthly", day).first()["proceed"] == 1:
            n_rows = K.overwrite(typed if day.day == 5 else typed.limit(0), f"{base}/table")
            K.log_load(spark, f"{base}/log", n_rows, "spend", dt.datetime.combine(day, dt.time(6)))
    return spark.read.parquet(f"{base}/table")


# ---------------------------------------------------------------- D23
@query("authorizations_previous_week", """
SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, round(value, 2) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'
""")
def authorizations_previous_week(t):
    """D23 previous-week append: each Monday's file holds the week before and,
    again, the day before that; weeks are loaded as commits of their own (K1,
    K12), new ids only (G5), behind a daily gate; the last file comes twice."""
    spark = t.events.sparkSession
    base = work_dir(spark, "auth-week")
    schema = "event_id bigint, user_id bigint, ts timestamp_ntz, value double"
    for day in (dt.date(2024, 1, 15), dt.date(2024, 1, 22), dt.date(2024, 1, 22)):
        if G.gate(K.read_log(spark, f"{base}/log"), "authorizations", "daily", day).first()["proceed"] != 1:
            continue
        lo, hi = prev_week(day)
        first = lo if day.day == 15 else lo - dt.timedelta(days=1)
        (t.events.filter(in_days("ts", first, hi)).select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                                                          F.format_string("%.2f", F.round("value", 2)).alias("value")).write.csv(f"{base}/landing-{day}"))
        raw = R.scan_csv(spark, f"{base}/landing-{day}", names=["event_id", "user_id", "ts", "value"])
        typed = raw.select(C.coerce_int("event_id").alias("event_id"), C.coerce_int("user_id").alias("user_id"),
                           F.col("ts").try_cast("timestamp_ntz").alias("ts"), C.coerce_float("value").alias("value"))
        known = K.committed(spark, f"{base}/table", f"{base}/log", "authorizations", schema)
        K.load_once(G.new_rows(typed, known, "event_id").checkpoint(eager=True), f"{base}/table", f"{base}/log", str(day), "authorizations",
                    dt.datetime.combine(day, dt.time(7)))
    return K.committed(spark, f"{base}/table", f"{base}/log", "authorizations", schema).drop("load_id")


# ---------------------------------------------------------------- D25
@query("inventory_and_payments", """
SELECT 'inventory' AS part, CAST(p_partkey AS BIGINT) AS id, CAST(p_size * 10 AS DOUBLE) AS amount FROM part
UNION ALL
SELECT 'payment', CAST(o_orderkey AS BIGINT), round(o_totalprice, 2) FROM orders WHERE o_orderdate >= TIMESTAMP '2001-05-01' AND o_orderdate < TIMESTAMP '2001-05-08'
""")
def inventory_and_payments(t):
    """D25 inventory: the whole stock file with two closing lines (S7 by
    position) is reloaded every time (K2). D25 payments: each day's file is
    appended unless the target has the day (G4); both read back."""
    spark = t.part.sparkSession
    base = work_dir(spark, "inventory")
    stock = t.part.select(F.lit(0).alias("last"), F.concat_ws(";", F.col("p_partkey").cast("string"), F.concat((F.col("p_size") * 10).cast("string"), F.lit(",0"))).alias("value"))
    closing = spark.createDataFrame([(1, "1;2,0"), (2, "3;4,0")], "last int, value string")
    stock.unionByName(closing).repartitionByRange(1, "last").sortWithinPartitions("last").select("value").write.text(f"{base}/stock")  # one file as it lands
    for _ in range(2):
        lines = R.parse_lines(R.drop_last_lines(R.scan_lines(spark, f"{base}/stock"), 2), ["id", "amount"], sep=";")
        K.overwrite(lines.select(C.coerce_int("id").alias("id"), C.locale_number("amount").alias("amount")), f"{base}/inventory")
    pay = t.orders.filter(in_range("o_orderdate", dt.date(2001, 5, 1), dt.date(2001, 5, 8)))
    pay.select(F.col("o_orderkey").cast("string").alias("id"), F.format_string("%.2f", F.round("o_totalprice", 2)).alias("amount"),
               F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).write.partitionBy("day").csv(f"{base}/payments-landing")
    kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType()), T.StructField("day", T.DateType())])
    spark.createDataFrame([], kind).write.parquet(f"{base}/payments")
    for d in (1, 2, 3, 2, 4, 5, 6, 7, 7):
        day = dt.date(2001, 5, d)
        there = G.range_probe(spark.read.schema(kind).parquet(f"{base}/payments"), "day", day, day).first()[0]
        for path in R.existing_paths(spark, [f"{base}/payments-landing/day={day}"]):
            if not there:
                raw = R.scan_csv(spark, path, names=["id", "amount"])
                K.append(raw.select(C.coerce_int("id").alias("id"), C.coerce_float("amount").alias("amount"), F.lit(day).alias("day")), f"{base}/payments")
    return spark.read.parquet(f"{base}/inventory").select(F.lit("inventory").alias("part"), "id", "amount").unionByName(
        spark.read.parquet(f"{base}/payments").select(F.lit("payment").alias("part"), "id", "amount"))


# ---------------------------------------------------------------- D26, K7, K13, K16, S3, S15
@query("workforce_cost_and_history", """
WITH m AS (SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, 7 + k AS month, round(s_acctbal + k, 2) AS cost FROM supplier, range(0, 3) r(k) WHERE (s_suppkey + k) % 5 <> 0)
SELECT m.id, name, month, cost, CASE WHEN EXISTS (SELECT 1 FROM m p WHERE p.id = m.id AND p.month = m.month - 1) THEN 'NO' ELSE 'SI' END AS nuevo,
       strftime(make_date(2001, CAST(month AS INTEGER), 1), '%d/%m/%Y') AS desde
FROM m
""")
def workforce_cost_and_history(t):
    """D26 cost and history: each month's roster is saved as a month state file
    (K13) that the next month compares with (G11); the month's cost replaces
    its period (K6, rerun included); the history is read through SQL (S3) from
    a catalog table (K16) beside a literal month list (S15), dates as text (K7)."""
    import uuid
    from carelake.operators.lookup import enrich
    spark = t.supplier.sparkSession
    base = work_dir(spark, "workforce-cost")
    name = f"workforce_{uuid.uuid4().hex[:12]}"
    months = R.inline_table(spark, [(7, dt.date(2001, 7, 1)), (8, dt.date(2001, 8, 1)), (9, dt.date(2001, 9, 1))], "month int, desde date")
    for k, month in enumerate((7, 8, 9)):
        now = t.supplier.filter((F.col("s_suppkey") + k) % 5 != 0).select(F.col("s_suppkey").cast("string").alias("id"), "s_name", F.round(F.col("s_acctbal") + k, 2).alias("cost"))
        for _ in range(2):
            K.snapshot_csv(now, f"{base}/state", f"2001{month:02d}")
            past = R.existing_paths(spark, [f"{base}/state/period=2001{month - 1:02d}"])
            before = R.scan_csv(spark, past, schema=now.schema, sep=";", header=True) if past else now.limit(0)
            marked = G.mark_new_vs_previous(now, before, "id").withColumn("month", F.lit(month))
            K.replace_period(marked, f"{base}/history", "month", month)
    K.create_table(spark, name, T.StructType.fromDDL("id string, s_name string, cost double, nuevo string, month int"), f"{base}/history")
    hist = R.scan_sql(spark, f"SELECT CAST(id AS BIGINT) AS id, s_name AS name, month, cost, nuevo FROM parquet.`{base}/history`")
    K.drop_table(spark, name)
    K.drop_table(spark, name)
    return datetime_text(enrich(hist, months, "month", how="inner"), "dd/MM/yyyy").select(
        "id", "name", F.col("month").cast("bigint"), "cost", "nuevo", "desde")
