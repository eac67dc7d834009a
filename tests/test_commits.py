"""Reloads, merges, commits and as-of lookups on literal rows: NULL periods, repeated extracts, crashes, replays."""

import datetime as dt

import pytest

from carelake.operators.lookup import as_of
from carelake.operators.sequence import first_last
from carelake.sinks import gates as G
from carelake.sinks import tables as K
from carelake.streaming.streams import file_stream, stream_refresh, stream_windows

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def land(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def test_first_last_without_dates(spark):
    """A row without a date is neither first nor last, with a tiebreak as without one."""
    df = spark.createDataFrame([("a", None, 1.0, 1), ("a", D(2024, 1, 2), 2.0, 2), ("a", D(2024, 1, 5), 5.0, 3), ("b", None, 7.0, 4)],
                               "k string, d date, v double, id int")
    want = [("a", 2.0, D(2024, 1, 2), 5.0, D(2024, 1, 5), 3, -3.0, 3), ("b", None, None, None, None, None, None, 1)]
    assert rows(first_last(df, "k", "d", "v", tiebreak="id")) == rows(first_last(df, "k", "d", "v")) == sorted(want, key=str)


EXTRACT = "id int, day date, v int, x int"


def test_refresh_takes_the_newest_extract(spark, tmp_path):
    base = str(tmp_path)
    d1, d2 = D(2024, 1, 1), D(2024, 1, 2)
    for data in ([(1, d1, 10, 1), (2, d2, 20, 1), (3, None, 30, 1)], [(4, d1, 40, 1), (5, None, 50, 1)],   # one extract in two parts
                 [(1, d1, 11, 2)], [(6, d1, 60, 2), (3, None, 31, 2)],                                      # again, split
                 [(9, d1, 90, 0), (9, d2, 90, None), (9, None, 90, 1)]):                                    # older ones, late
        land(spark, f"{base}/in", data, EXTRACT)
        s = file_stream(spark, f"{base}/in", spark.createDataFrame([], EXTRACT).schema, max_files=1)
        stream_refresh(s, f"{base}/t", "day", f"{base}/chk", extract="x")
    table = spark.read.schema("id int, day date, v int").parquet(f"{base}/t")
    assert rows(table.select("id", "day", "v")) == sorted([(1, d1, 11), (6, d1, 60), (2, d2, 20), (3, None, 31)], key=str)
    left = spark.read.schema("id int, day date, __version int").parquet(f"{base}/chk-staged")
    assert rows(left.select("day", "__version").distinct()) == sorted([(d1, 2), (d2, 1), (None, 2)], key=str)


def test_refresh_without_extract_ids(spark, tmp_path):
    """Every micro-batch is an extract: it replaces its periods, and no others."""
    base = str(tmp_path)
    d1 = D(2024, 1, 1)
    for data in ([(1, d1, 1, 0), (2, None, 2, 0), (3, D(2024, 1, 2), 3, 0)], [(1, d1, 100, 0)], [(2, None, 200, 0)]):
        land(spark, f"{base}/in", data, EXTRACT)
        stream_refresh(file_stream(spark, f"{base}/in", spark.createDataFrame([], EXTRACT).schema, max_files=1), f"{base}/t", "day", f"{base}/chk")
    got = spark.read.schema("id int, day date, v int").parquet(f"{base}/t")
    assert rows(got.select("id", "day", "v")) == sorted([(1, d1, 100), (2, None, 200), (3, D(2024, 1, 2), 3)], key=str)


def test_windows_keep_late_rows(spark, tmp_path):
    base, schema = str(tmp_path), "id int, k string, ts timestamp_ntz"
    t = lambda day, h=0: dt.datetime(2024, 1, day, h)
    parts = [[(1, "a", t(1)), (2, "a", t(3)), (3, "b", t(9)), (4, "a", None)], [(5, "a", t(2)), (6, "b", t(30))],
             [(7, "a", t(2)), (8, "b", t(16)), (9, "b", t(30, 5)), (10, "a", t(23, 1))], []]
    for data in parts:
        land(spark, f"{base}/in", data, schema)
        s = file_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema, max_files=1)
        out = stream_windows(s, "ts", "7 days", "k", dt.timedelta(days=7), f"{base}/w", f"{base}/late", f"{base}/chk", start="4 days")
    assert rows(out.select("window_start", "k", "n")) == sorted([
        (t(1), "a", 3), (t(8), "b", 1), (t(29), "b", 2), (t(22), "a", 1)], key=str)
    assert rows(spark.read.schema(schema).parquet(f"{base}/late").select("id")) == [(4,), (7,), (8,)]
    epochs = spark.read.schema("k string, epoch long").parquet(f"{base}/chk-open").select("epoch").distinct().count()
    assert epochs <= 2


def test_merge_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    K.overwrite(spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, None, 3.0), (4, "z", 4.0)], "id int, p string, v double"), path, partition_by="p")
    src = spark.createDataFrame([(1, 10.0), (3, None), (9, 9.0)], "id int, v double")
    assert K.merge_partitions(spark, path, src, "id", "v", "p") == 2
    assert rows(spark.read.parquet(path).select("id", "p", "v")) == sorted([(1, "x", 10.0), (2, "y", 2.0), (3, None, None), (4, "z", 4.0)], key=str)
    assert K.merge_partitions(spark, path, src.filter("id = 9"), "id", "v", "p") == 0
    with pytest.raises(Exception, match="duplicate keys"):
        K.merge_partitions(spark, path, src.unionByName(src), "id", "v", "p")
    with pytest.raises(ValueError, match="partition column"):
        K.merge_partitions(spark, path, src, "id", ["v", "p"], "p")
    assert rows(spark.read.parquet(path).filter("id = 1").select("v")) == [(10.0,)]


def test_load_is_seen_once_committed(spark, tmp_path):
    t, log, at, schema = f"{tmp_path}/t", f"{tmp_path}/log", dt.datetime(2024, 1, 1), "a int"
    df = spark.createDataFrame([(1,), (2,)], schema)
    assert K.committed(spark, t, log, "x", schema).count() == 0
    K.write_load(df, t, "one")
    assert K.committed(spark, t, log, "x", schema).count() == 0
    assert K.load_once(df, t, log, "one", "x", at) == 2 == K.load_once(df, t, log, "one", "x", at)
    K.write_load(df, t, "two")
    assert K.load_once(df.filter("a > 5"), t, log, "two", "x", at) == 0  # the rerun finds nothing: the first try's rows go
    assert rows(K.committed(spark, t, log, "x", schema)) == [(1, "one"), (2, "one")]
    assert rows(K.read_log(spark, log).select("id", "totalRegistros")) == [("one", 2), ("two", 0)]


def test_publish_null_period_once(spark, tmp_path):
    df = spark.createDataFrame([("202401", 1), (None, 2), (None, 3)], "period string, v int")
    for m in (1, 2, 3):
        K.publish_all([K.PublishSpec("t", df, period_col="period")], f"{tmp_path}/out", f"{tmp_path}/log", D(2024, m, 5))
    assert rows(spark.read.schema("v int, period string").parquet(f"{tmp_path}/out/t")) == sorted([(1, "202401"), (2, None), (3, None)], key=str)


def test_bucketed_target_is_not_shuffled(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "id * 2 as v")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = K.save_bucketed(df, "bucketed_target_test", f"{tmp_path}/b", "id", n)
    try:
        new = G.new_rows(spark.range(1900, 2100), target.hint("merge"), "id")
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
        assert new.count() == 100
    finally:
        spark.sql("DROP TABLE bucketed_target_test")


def test_as_of(spark):
    pop = spark.createDataFrame([("a", D(2024, 1, 15), 10), ("a", D(2024, 3, 15), 30), ("b", D(2024, 2, 15), None), (None, D(2024, 1, 1), 7), ("a", None, 99)],
                                "site string, period date, n int")
    v = spark.createDataFrame([(1, "a", D(2024, 1, 14)), (2, "a", D(2024, 1, 15)), (3, "a", D(2024, 2, 28)), (4, "a", D(2025, 1, 1)), (5, "b", D(2024, 3, 1)),
                               (6, None, D(2024, 3, 1)), (7, "a", None), (8, "c", D(2024, 3, 1)), (3, "a", D(2024, 2, 28))], "id int, site string, day date")
    got = rows(as_of(v, pop, "site", "day", "period", ["n"]).select("id", "n"))
    assert got == sorted([(1, None), (2, 10), (3, 10), (3, 10), (4, 30), (5, None), (6, 7), (7, None), (8, None)], key=str)


def test_fallback_period(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 2, 1), 2), (None, 3)], "p date, n int")
    assert rows(G.fallback_period(df, "p", D(2024, 5, 1))) == [(D(2024, 5, 1), 2)]
    assert rows(G.fallback_period(df, "p", D(2023, 5, 1))) == []


def test_in_values_and_drop_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c/d")], "v int, p string")
    assert rows(df.filter(K.in_values("p", ["a b", None])).select("v")) == [(1,), (2,)]
    assert rows(df.filter(K.in_values("p", [])).select("v")) == []
    df.write.partitionBy("p").parquet(f"{tmp_path}/t")
    assert K.drop_partitions(spark, f"{tmp_path}/t", df.filter("v > 1").select("p")) == 2
    assert rows(spark.read.schema("v int, p string").parquet(f"{tmp_path}/t")) == [(1, "a b")]
