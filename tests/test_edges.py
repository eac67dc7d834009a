"""Operators on NULL keys, NULL orders, big ids, duplicate sources and rows outside of a reload."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import session
from carelake.functions import coerce as C
from carelake.functions.names import camel_safe
from carelake.operators import aggregate as A
from carelake.operators import filters as FL
from carelake.operators import lookup as L
from carelake.operators import sequence as S
from carelake.sinks import gates as G
from carelake.sinks import tables as K
from carelake.sources import readers as R


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_partition_total_of_the_null_partition(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, v int")
    assert rows(S.partition_total(df, "k", "v")) == rows(spark.createDataFrame(
        [(None, 1, 3), (None, 2, 3), ("a", 5, 5)], "k string, v int, t bigint"))


def test_pick_with_null_orders_keeps_a_whole_row(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", None, 2), ("b", 7, 3), ("b", 9, 4)], "k string, o int, v int")
    assert rows(S.last_per(df, "k", "o")) == [("a", None, 1), ("b", 9, 4)]
    assert rows(S.first_per(df, "k", "o")) == [("a", None, 1), ("b", 7, 3)]


def test_coerce_int_keeps_every_bigint(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(str(big), big), ("-9223372036854775808", -big), ("2.9", 3), ("-2.9", 4), (" 7 ", 5), ("x", 6),
                                (None, None), ("nan", 8), ("1e3", 9), ("99999999999999999999", 10)], "s string, n bigint")
    got = [tuple(r) for r in df.select(C.coerce_int("s"), C.coerce_int("n")).collect()]
    assert [g[0] for g in got] == [big, -9223372036854775808, 2, -2, 7, 0, 0, 0, 1000, 0]
    assert [g[1] for g in got][:2] == [big, -big] and got[6][1] == 0
    assert spark.range(1).select(C.coerce_int(F.lit(2.9))).first()[0] == 2


def test_merge_update_finds_duplicates_whatever_is_selected(spark):
    t = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    s = spark.createDataFrame([(1, 5.0), (1, 6.0)], "k int, v double")
    with pytest.raises(Exception, match="duplicate keys"):
        K.merge_update_df(t, s, "k", "v").select("k").collect()
    other = spark.createDataFrame([(9, 5.0), (9, 6.0)], "k int, v double")
    assert rows(K.merge_update_df(t, other, "k", "v")) == [(1, 1.0), (2, 2.0)]


def test_new_rows_null_keys(spark):
    b = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, v int")
    t = spark.createDataFrame([(None,), (1,)], "k int")
    assert rows(G.new_rows(b, t, "k")) == [(2, 3), (None, 1)]
    assert rows(G.new_rows(b, t, "k", null_safe=True)) == [(2, 3)]


def test_strict_total_is_over_kept_groups(spark):
    df = spark.createDataFrame([("a", 3, "F"), ("a", 30, "M"), ("b", 30, "F")], "s string, age int, sex string")
    c = [A.cohort("lt", 5, name="young"), A.cohort("ge", 5, name="old")]
    assert rows(A.cohort_counts(df, "s", c, strict=True, total_label="T")) == [("T", 1, 1), ("a", 1, 1)]


def test_conditional_sums_keep_whole_numbers(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    out = A.conditional_sums(df, "k", {"n": F.col("v")}, {"all": F.lit(True), "none": F.lit(False)})
    assert rows(out) == [("a", 5, 0)] and out.schema["n_all"].dataType == T.LongType()


def test_reloads_lose_no_row(spark):
    d = dt.date
    t = spark.createDataFrame([(1, d(2024, 1, 1)), (2, d(2024, 1, 9)), (3, None)], "k int, day date")
    new = spark.createDataFrame([(4, d(2024, 1, 9)), (5, None), (6, d(2023, 1, 1)), (1, d(2023, 1, 1))], "k int, day date")
    with pytest.raises(Exception, match="row outside of"):
        K.refresh_window_df(t, new, "day", d(2024, 1, 5)).collect()
    once = K.refresh_window_df(t, new, "day", d(2024, 1, 5), key="k")
    want = [(1, d(2024, 1, 1)), (3, None), (4, d(2024, 1, 9)), (5, None), (6, d(2023, 1, 1))]
    assert rows(once) == sorted(want, key=str)
    assert rows(K.refresh_window_df(once, new, "day", d(2024, 1, 5), key="k")) == sorted(want, key=str)
    p = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    n = spark.createDataFrame([(3, "a"), (4, "b"), (5, None)], "k int, p string")
    with pytest.raises(Exception, match="row outside of"):
        K.replace_period_df(p, n, "p", "a").collect()
    assert rows(K.replace_period_df(p, n, "p", "a", key="k")) == rows(
        spark.createDataFrame([(2, "b"), (3, "a"), (4, "b"), (5, None)], "k int, p string"))


def test_partitioned_overwrite_and_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, p string")
    K.overwrite(df, path, partition_by="p")
    K.replace_period(spark.createDataFrame([(9, "b")], "k int, p string"), path, "p", "b")
    assert rows(spark.read.parquet(path)) == [(1, "a"), (3, "c"), (9, "b")]
    K.refresh_partitions(spark.createDataFrame([(8, "b")], "k int, p string"), path, "p", "b", "d")
    assert rows(spark.read.parquet(path)) == [(1, "a"), (8, "b")]
    K.overwrite(df.filter("p = 'c'"), path, partition_by="p")
    assert rows(spark.read.parquet(path)) == [(3, "c")]


def test_snapshot_create_and_drop(spark, tmp_path):
    df = spark.createDataFrame([(1, "a;b"), (2, None)], "k int, s string")
    assert K.snapshot_csv(df, str(tmp_path / "snap"), "202401") == 2
    back = spark.read.option("sep", ";").option("header", "true").csv(str(tmp_path / "snap"))
    assert rows(back.select("k", "s", F.col("period").cast("string"))) == [("1", "a;b", "202401"), ("2", None, "202401")]
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    K.create_table(spark, "edge_table", schema, str(tmp_path / "cat"))
    assert spark.table("edge_table").count() == 0 and K.create_table(spark, "edge_table", schema).columns == ["k"]
    K.drop_table(spark, "edge_table")
    K.drop_table(spark, "edge_table")
    assert not spark.catalog.tableExists("edge_table")


def test_empty_batch_leaves_the_table(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    run = lambda d, day: K.publish_all([K.PublishSpec("t", d, mode="overwrite")], str(tmp_path / "o"), str(tmp_path / "l"), day).first()
    assert run(df, dt.date(2024, 1, 1))["loaded"] == 1
    assert run(df.limit(0), dt.date(2024, 2, 1))["loaded"] == -1
    assert spark.read.parquet(str(tmp_path / "o" / "t")).count() == 1
    assert K.read_log(spark, str(tmp_path / "l")).count() == 1


def test_latest_file_by_period_not_by_name(spark, tmp_path):
    for n in ("b_202312", "a_202401", "~$a_209901", "readme", "c_2024011"):
        (tmp_path / n).mkdir()
    assert R.latest_file(spark, str(tmp_path), "*").endswith("/a_202401")
    with pytest.raises(FileNotFoundError):
        R.latest_file(spark, str(tmp_path), "read*")


def test_latest_period_and_rows_after(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "p string, v int")
    assert rows(FL.latest_period(df, "p")) == [("b", 2)]
    assert FL.latest_period(df.filter("p is null"), "p").count() == 0
    assert rows(G.rows_after(df, "v", df.filter("v < 2"))) == [("b", 2), (None, 3)]
    assert G.rows_after(df, "v", df.limit(0)).count() == 3


def test_flags_in_equals_single_flags(spark):
    d = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    f = spark.createDataFrame([(1, 5), (1, 6), (None, 7)], "k int, v int")
    out = L.flags_in(d, f, "k", {"big": F.col("v") > 5}, {"n": F.lit(True)}, {"top": ("v", None)})
    assert rows(out) == rows(spark.createDataFrame([(1, 1, 2, 6), (2, 0, 0, None), (None, 0, 0, None)], "k int, a int, b int, c int"))


def test_camel_safe_names():
    assert camel_safe(["A b", "a B", "a_b", "", "--", "2x", "aB_2", "Ñandú azul"]) == [
        "aB", "aB_2", "aB_3", "col", "col_2", "c_2x", "ab2", "ñandúAzul"]
    assert len(set(camel_safe(["x", "x 2", "x", "x_2", "x"]))) == 5


def test_work_dir_refuses_a_cluster_without_a_shared_folder():
    class Fake:
        class conf:
            get = staticmethod(lambda k, d=None: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.work_dir(Fake)
