"""Files by position, drifting schemas, forms with quarantine, phrases and bitmaps on literal rows."""

import random
import warnings

import pytest
from pyspark.sql import types as T

from carelake.operators import forms as FO
from carelake.operators.aggregate import distinct_with_total
from carelake.operators.filters import truncate_at_blank
from carelake.operators.lookup import match_phrases
from carelake.operators.shape import datetime_text, reconciled, widest
from carelake.sources import readers as R


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("split", ["128m", "200b"])
def test_line_numbers_in_split_files(spark, tmp_path, split):
    """Lines keep their place whatever the splits; footers and what follows a blank line go by position."""
    r, want = random.Random(1), set()
    for f in range(3):
        body = [f"{f};{i};{'x' * r.randint(0, 60)}" for i in range(80 + f)]
        (tmp_path / f"f{f}.txt").write_text("\n".join([*body, "", "9;9;note", "1;1;total", "2;2;total"]) + "\n")
        want |= {(str(f), str(i), i + 1) for i in range(len(body))}
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "one.txt").write_text("7;7;only line")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = R.scan_lines(spark, str(tmp_path))
        assert split == "128m" or lines.rdd.getNumPartitions() > 5
        assert lines.count() == 80 + 81 + 82 + 12 + 1
        data = truncate_at_blank(R.drop_last_lines(lines, 2), ["value"], order="line_no", by="source_file")
        got = {(x.a, x.b, x.line_no) for x in R.parse_lines(data, ["a", "b", "c"], sep=";").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def test_widest_and_reconciled():
    i, n, d, s, t = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType()
    dec = T.DecimalType(38, 9)
    assert [widest(k) for k in ([i, n], [i, T.DecimalType(10, 2)], [n, T.DecimalType(12, 9)], [i, d], [n, d], [t, T.TimestampNTZType()], [t, i],
                                [T.NullType(), i], [], [T.DecimalType(38, 20), i], [T.FloatType(), T.ShortType()])] == [
        n, dec, dec, d, s, T.TimestampNTZType(), s, i, s, s, d]
    a = T.StructType([T.StructField("Id ", i), T.StructField("v", i)])
    b = T.StructType([T.StructField("V", n), T.StructField("id", s), T.StructField("w", t)])
    assert reconciled([a, b]) == T.StructType([T.StructField("Id", s), T.StructField("v", n), T.StructField("w", t)])
    assert reconciled([a, a], {"ID": s})["Id"].dataType == s


def test_scan_drifting(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "id int, v int").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(2 ** 40, "007")], "V bigint, ID string").write.parquet(f"{tmp_path}/b")
    spark.createDataFrame([], "extra date").write.parquet(f"{tmp_path}/c")
    got = R.scan_drifting(spark, [f"{tmp_path}/{x}" for x in "abc"])
    assert dict(got.dtypes) == {"id": "string", "v": "bigint", "extra": "date", "source_file": "string"}
    assert rows(got.select("id", "v")) == [("007", 2 ** 40), ("1", 2)]


def test_forms_quarantine(spark):
    spec = FO.FormSpec("f", "ID", {"q": ("Pregunta", "text"), "p": ("Nota %", "percent"), "n": ("Total", "whole"), "d": ("Fecha", "date"), "b": ("Cumple", "yes_no")},
                       ("q", "p"), ("n",))
    other = FO.FormSpec("g", "id", {"q": ("Item", "text"), "x": ("Valor", "number")}, ("q",), ("x",))
    sheet = spark.createDataFrame([("1", " a ", "85,5%", "12", "02/03/2024", "si"), ("2", None, "n/a", "1.5", "x", "quizás"), ("3", "", " ", "7", "", "no"),
                                   ("4", "b", None, None, None, None), (None, "c", "5", "0", "2024-01-31", "X")],
                                  ' ID string, pregunta string, `"nota %"` string, `TOTAL ` string, fecha string, CUMPLE string')
    lack = spark.createDataFrame([("9", "z")], "ID string, item string")
    forms = FO.read_forms({"f": sheet, "g": lack}, [spec, other])
    got = {(r.form, r.row_id): r for r in FO.clean_rows(forms).collect()}
    assert len(got) == 5 and ("f", "3") not in got  # a row without content is no row
    assert (got["f", "1"].q, got["f", "1"].p, got["f", "1"].n, str(got["f", "1"].d), got["f", "1"].b) == ("a", 0.855, 12, "2024-03-02", 1)
    assert [getattr(got["f", "2"], c) for c in "qpndb"] == [None] * 5 and str(got["f", None].d) == "2024-01-31"
    assert rows(FO.quarantine_rows(forms)) == sorted([
        ("f", "2", "p", "n/a", "not a percent"), ("f", "2", "n", "1.5", "not a whole"), ("f", "2", "d", "x", "not a date"), ("f", "2", "b", "quizás", "not a yes_no"),
        ("f", "4", "n", None, "missing"), ("g", "9", "x", None, "no such column")], key=str)
    assert FO.read_forms({"f": sheet.limit(0)}, [spec, other]).count() == 0


def test_match_phrases(spark):
    msgs = [(1, "The quick, brown FOX."), (2, "quick brown"), (3, "the foxes"), (4, None), (5, ""), (6, "fox"), (7, "brown fox brown fox"), (8, "É-mail étage")]
    phrases = [(1, "quick brown"), (2, "Fox"), (3, "brown fox"), (4, "the quick brown fox"), (5, None), (6, " - "), (7, "mail étage"), (8, "quick fox"), (9, "fox")]
    m = spark.createDataFrame(msgs, "id int, text string")
    p = spark.createDataFrame(phrases, "pid int, phrase string")

    def plain(x):
        import re
        return " " + re.sub(r"[\W_]+", " ", (x or "").lower()).strip() + " "
    want = sorted((i, k) for i, t in msgs for k, s in phrases if t is not None and plain(s).strip() and plain(s) in plain(t))
    assert rows(match_phrases(m, p, "text", "phrase").select("id", "pid")) == want


def test_distinct_with_total(spark):
    r = random.Random(4)
    data = [(r.choice(["a", "b", None]), r.choice([None, -5, -1, 0, 1, 32767, 32768, 2 ** 40, r.randint(0, 9)]), 1) for _ in range(300)]
    got = {x.k: x for x in distinct_with_total(spark.createDataFrame(data, "k string, id long, one int"), "k", {"ids": "id"}, {"n": "one"}, "ALL").collect()}
    for k in ("a", "b", None, "ALL"):
        mine = [(i, o) for x, i, o in data if k == "ALL" or x == k]
        assert (got[k].ids, got[k].n) == (len({i for i, _ in mine if i is not None}), len(mine))
    plan = distinct_with_total(spark.createDataFrame(data, "k string, id long, one int"), "k", {"ids": "id"}, {"n": "one"}, "ALL")
    assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()


def test_datetime_text(spark):
    df = spark.sql("SELECT 1 AS a, DATE '2024-02-03' AS d, TIMESTAMP_NTZ '2024-02-03 04:05:06' AS t, CAST(NULL AS DATE) AS e")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert rows(datetime_text(df, "dd/MM/yyyy HH:mm")) == [(1, "03/02/2024 00:00", "03/02/2024 04:05", None)]
