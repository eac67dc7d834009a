"""Totals planned once, counted broadcasts, exports that keep microseconds."""

import datetime as dt

from pyspark.sql import functions as F

from carelake.operators.aggregate import with_total_row
from carelake.operators.lookup import broadcast_small, enrich
from carelake.sinks import gates as G
from carelake.sinks import tables as K

TOTAL = "TOTAL"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_total_row_keeps_null_and_namesake_groups(spark):
    agg = spark.createDataFrame([("a", 1, 1.5), (None, 2, None), (TOTAL, 4, 2.0)], "site string, n int, x double")
    assert rows(with_total_row(agg, ["site"], ["n", "x"], TOTAL, "site")) == sorted(
        [("a", 1, 1.5), (None, 2, None), (TOTAL, 4, 2.0), (TOTAL, 7, 3.5)], key=repr)


def test_total_row_by_period(spark):
    agg = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 5)], "period int, site string, n long")
    assert rows(with_total_row(agg, ["period", "site"], ["n"], TOTAL, "site")) == sorted(
        [(1, "a", 1), (1, "b", 2), (2, "a", 5), (1, TOTAL, 3), (2, TOTAL, 5)], key=repr)
    assert rows(with_total_row(agg.filter("n < 0"), ["period", "site"], ["n"], TOTAL, "site")) == []


def test_total_row_of_nothing(spark):
    agg = spark.createDataFrame([], "site string, n long")
    assert rows(with_total_row(agg, ["site"], ["n"], TOTAL, "site")) == [(TOTAL, None)]


def test_total_row_plans_its_frame_once(spark):
    agg = spark.range(100).groupBy((F.col("id") % 7).alias("site")).agg(F.count(F.lit(1)).alias("n"))
    plan = with_total_row(agg, ["site"], ["n"], TOTAL, "site")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 100") == 1


def test_broadcast_only_what_was_counted(spark):
    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    dim = spark.range(50).withColumnRenamed("id", "k")
    assert hinted(broadcast_small(dim, most=50)) and not hinted(broadcast_small(dim, most=49))
    assert hinted(broadcast_small(dim, rows_of=dim.limit(3), most=3))
    fact = spark.range(100).select((F.col("id") % 60).alias("k"))
    out = enrich(fact, dim.withColumn("v", F.col("k") * 2), "k", small=True)
    assert out.count() == 100 and out.filter("v IS NULL").count() == 10


def test_exports_keep_microseconds(spark, tmp_path):
    at = dt.datetime(2024, 1, 7, 0, 16, 23, 951339)
    df = spark.createDataFrame([(1, at)], "id long, ts timestamp_ntz")
    assert K.export_csv(df, f"{tmp_path}/report") == 1 and K.snapshot_csv(df, f"{tmp_path}/state", "202401") == 1
    for path in ("report", "state/period=202401"):
        back = spark.read.option("sep", ";").option("header", "true").schema(df.schema).csv(f"{tmp_path}/{path}")
        assert back.first()["ts"] == at


def test_new_rows_read_the_partitions_of_their_batch(spark, tmp_path):
    path, kind = f"{tmp_path}/t", "id long, v string, day date"
    d1, d2, d3 = (dt.date(2024, 1, i) for i in (1, 2, 3))
    spark.createDataFrame([(1, "a", d1), (2, "b", d2), (3, "c", None), (None, "n", d2)], kind).write.partitionBy("day").parquet(path)
    target = spark.read.schema(kind).parquet(path)
    batch = spark.createDataFrame([(1, "x", d2), (2, "x", d2), (3, "x", None), (None, "x", d2), (4, "x", d3)], kind)
    assert rows(G.new_in_partitions(batch, target, "id", "day", null_safe=True)) == sorted([(1, "x", d2), (4, "x", d3)], key=repr)
    assert rows(G.new_in_partitions(batch, target, "id", "day")) == sorted([(1, "x", d2), (4, "x", d3), (3, "x", None), (None, "x", d2)], key=repr)
    dated = batch.filter("day = DATE '2024-01-02'")
    plan = G.new_in_partitions(dated, target, "id", "day")._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-02" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(G.new_in_partitions(batch.filter("id < 0"), target, "id", "day", null_safe=True)) == []


def test_double_of_any_type(spark):
    from carelake.functions.coerce import to_double
    texts = [("1.5",), (" 7 ",), ("1e3",), ("-.5",), ("n/a",), ("",), ("NaN",), ("Infinity",), (None,), ("x1",), ("true",), ("\t8",), ("+9",), (": 1",)]
    got = spark.createDataFrame(texts, "s string").select("s", to_double("s").alias("d"))
    assert [r.d for r in got.collect()] == [1.5, 7.0, 1000.0, -0.5] + [None] * 7 + [8.0, 9.0, None]
    other = spark.sql("SELECT 2 AS i, 2.5D AS x, true AS b, double('NaN') AS n, CAST(3.25 AS DECIMAL(5, 2)) AS d")
    assert tuple(other.select(*[to_double(c) for c in other.columns]).first()) == (2.0, 2.5, 1.0, None, 3.25)
