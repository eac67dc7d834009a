"""Operators on the literal fixtures (NULL keys, duplicates, empty input)."""

import datetime as dt
import warnings

import pytest
from pyspark.sql import functions as F

from carelake.operators import filters as FL
from carelake.operators.aggregate import Cohort, cohort, cohort_counts, grouped_with_total
from carelake.operators.lookup import StatusRule, anti, enrich, status_by_priority
from carelake.operators.sequence import dedupe, first_last
from carelake.operators.shape import add_missing, rename_positional
from carelake.operators.setops import union_ragged
from carelake.plans.chronic import improved, last_result_ok
from carelake.sinks import gates as G
from carelake.sinks import tables as K


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


def _key(t):
    return tuple((False, v) if v is not None else (True, 0) for v in t)


def test_null_key_joins(spark):
    left = spark.createDataFrame([(None, 1), ("k", 2)], "k string, a int")
    right = spark.createDataFrame([(None, 9), ("k", 8)], "k string, b int")
    assert rows(enrich(left, right, "k"), "a", "b") == [(1, None), (2, 8)]
    assert rows(anti(left, right, "k"), "a") == [(1,)]
    assert rows(enrich(left, right, "k", null_safe=True), "a", "b") == [(1, 9), (2, 8)]


def test_new_rows_empty_and_duplicates(spark):
    empty = spark.createDataFrame([], "k int, v string")
    target = spark.createDataFrame([(5, "z")], "k int, v string")
    assert G.new_rows(empty, target, "k").count() == 0
    batch = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert rows(G.new_rows(batch, spark.createDataFrame([], "k int, v string"), "k"), "k", "v") == [(1, "a"), (1, "b")]
    # idempotent: running the dedupe against its own output adds nothing
    assert G.new_rows(batch, batch, "k").count() == 0


def test_status_priority_fixture(spark):
    facts = spark.createDataFrame([(1, "1"), (1, "2"), (2, "2"), (3, None), (5, "4")], "id int, st string")
    ids = spark.createDataFrame([(i,) for i in range(1, 6)], "id int")
    rules = [StatusRule("ACTIVO", F.col("st") == "1"),
             StatusRule("INACTIVO", F.col("st").isin("2", "3") | F.col("st").isNull())]
    got = dict(rows(status_by_priority(ids, facts, "id", rules, "EXTERNO"), "id", "status"))
    assert got == {1: "ACTIVO", 2: "INACTIVO", 3: "INACTIVO", 4: "EXTERNO", 5: "EXTERNO"}


def test_grand_total_with_null_site(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "site string, v int")
    g = grouped_with_total(df, ["site"], [F.sum("v").alias("v")], "TOTAL")
    assert rows(g, "site", "v") == sorted([("a", 5), ("b", 2), (None, 3), ("TOTAL", 10)], key=_key)


def test_cohort_partition_sums(spark):
    df = spark.createDataFrame([("s", a, x) for a in range(0, 90, 3) for x in "FM"], "site string, age int, sex string")
    cs = [Cohort("all"), Cohort("f", sex="F"), Cohort("m", sex="M"), cohort("lt", 18), cohort("ge", 18)]
    r = cohort_counts(df, "site", cs).first()
    assert r["all"] == r["f"] + r["m"] == r["n_lt_18"] + r["n_ge_18"]


def test_first_last_rule_fixture(spark):
    d0 = dt.datetime(2020, 1, 1)
    cases = [(1, 11.0, 8.9, 335), (2, 11.0, 9.1, 335), (3, 9.0, 8.0, 335), (4, 7.9, 7.4, 335), (5, 11.0, 5.0, 334)]
    data = []
    for p, f, last, span in cases:
        data += [(p, d0, 1, f), (p, d0 + dt.timedelta(days=span), 2, last)]
    df = spark.createDataFrame(data, "p int, d timestamp_ntz, id int, v double")
    fl = first_last(df, "p", "d", "v", tiebreak="id").withColumn("ok", improved())
    assert [r["ok"] for r in fl.orderBy("p").collect()] == [1, 0, 1, 1, 0]


def test_last_result_rule_fixture(spark):
    df = spark.createDataFrame([(64, 7.0), (64, 7.1), (65, 8.0), (65, 8.1)], "age int, v double")
    got = [r[0] for r in df.select(F.when(last_result_ok(F.col("age"), F.col("v")), 1).otherwise(0)).collect()]
    assert got == [1, 0, 1, 0]


def test_dedupe_requires_order_for_subset(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1)], "k int, v string, o int")
    assert rows(dedupe(df, ["k"], keep="first", order="o"), "k", "v") == [(1, "b")]
    assert rows(dedupe(df, ["k"], keep="last", order="o"), "k", "v") == [(1, "a")]
    with pytest.raises(ValueError):
        dedupe(df, ["k"])


def test_merge_update_fixture(spark):
    target = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    source = spark.createDataFrame([(1, None)], "k int, v int")
    assert rows(K.merge_update_df(target, source, "k", "v"), "k", "v") == [(1, None), (2, 20)]
    dup = spark.createDataFrame([(1, 5), (1, 6)], "k int, v int")
    with pytest.raises(Exception):
        K.merge_update_df(target, dup, "k", "v").collect()


def test_refresh_window_twice_equals_once(spark):
    target = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 10)), (3, None)], "k int, d date")
    new = spark.createDataFrame([(20, dt.date(2024, 1, 11))], "k int, d date")
    once = K.refresh_window_df(target, new, "d", dt.date(2024, 1, 5))
    twice = K.refresh_window_df(once, new, "d", dt.date(2024, 1, 5))
    assert rows(once, "k") == rows(twice, "k") == [(1,), (3,), (20,)]


def test_refresh_window_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 10))], "k int, d date").write.parquet(path)
    new = spark.createDataFrame([(20, dt.date(2024, 1, 11))], "k int, d date")
    K.refresh_window(spark, path, new, "d", dt.date(2024, 1, 5))
    K.refresh_window(spark, path, new, "d", dt.date(2024, 1, 5))
    assert rows(spark.read.parquet(path), "k") == [(1,), (20,)]


def test_replace_period_partition(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "202401"), (2, "202402")], "k int, period string").write.partitionBy("period").parquet(path)
    K.replace_period(spark.createDataFrame([(3, "202402")], "k int, period string"), path, "period", "202402")
    assert rows(spark.read.schema("k int, period string").parquet(path), "k", "period") == [(1, "202401"), (3, "202402")]


def test_append_counts_and_gate(spark, tmp_path):
    path, log = str(tmp_path / "a"), str(tmp_path / "log")
    n = K.append(spark.createDataFrame([(1,), (2,)], "k int"), path)
    assert n == 2
    K.log_load(spark, log, n, "tbl", dt.datetime(2024, 1, 14, 8))   # a Sunday
    lg = spark.read.parquet(log)
    assert G.gate(lg, "tbl", "daily", dt.date(2024, 1, 14)).first()["proceed"] == 0
    assert G.gate(lg, "tbl", "weekly", dt.date(2024, 1, 14)).first()["proceed"] == 0
    assert G.gate(lg, "tbl", "weekly", dt.date(2024, 1, 14), legacy_week=True).first()["proceed"] == 1
    assert G.gate(lg, "other", "monthly", dt.date(2024, 1, 14)).first()["proceed"] == 1


def test_publish_all_gates_second_run(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    specs = [K.PublishSpec("t1", df), K.PublishSpec("t2", df, mode="overwrite")]
    base, log = str(tmp_path / "pub"), str(tmp_path / "log")
    first = {r["table"]: r["rows"] for r in K.publish_all(specs, base, log, dt.date(2024, 3, 5)).collect()}
    again = {r["table"]: r["rows"] for r in K.publish_all(specs, base, log, dt.date(2024, 3, 20)).collect()}
    assert first == {"t1": 1, "t2": 1} and again == {"t1": 0, "t2": 0}


def test_truncate_and_blank_rows(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, " ", None), (4, "d", "y")], "pos int, a string, b string")
    assert rows(FL.truncate_at_blank(df, ["a", "b"], "pos"), "pos") == [(1,), (2,)]
    assert rows(FL.drop_blank_rows(df, ["a", "b"]), "pos") == [(1,), (2,), (4,)]


def test_footer_by_position(spark):
    data = [(f, i) for f in ("f1", "f2") for i in range(7)]
    df = spark.createDataFrame(data, "f string, pos int")
    assert FL.drop_footer(df, 2, "f", "pos").count() == 10


def test_schema_drift(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    c = spark.createDataFrame([(2, 3.0)], "a int, c double")
    u = union_ragged(a, c)
    assert sorted(u.columns) == ["a", "b", "c"] and u.filter(F.col("b").isNull()).count() == 1
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert rename_positional(a, ["x"]).columns == ["x", "b"]
    assert add_missing(a, ["z"]).columns == ["a", "b", "z"]


def test_sentinels_and_wide_exclusion(spark):
    df = spark.createDataFrame([(s,) for s in ["", "0", "00", "000", "noencontrado", None, "123"]], "id string")
    assert rows(FL.drop_sentinels(df, "id"), "id") == [("123",)]
    w = spark.createDataFrame([(1, 30, 0, 0), (2, 30, 0, 1), (3, 10, 0, 0), (4, 30, None, 0)], "k int, age int, a int, b int")
    assert rows(FL.wide_exclusion(w, ["a", "b"], when=F.col("age") >= 18), "k") == [(2,), (3,), (4,)]
