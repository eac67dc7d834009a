"""Registered streaming queries.

Each reads the ``events`` file as a stream (file source over the table's
folder), runs with ``availableNow``, writes a Parquet table under the shared
work folder and returns that table; the oracle is the batch equivalent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from carelake.plans.registry import query
from carelake.session import work_dir
from carelake.streaming.streams import (
    event_time, file_stream, stream_append_new, stream_counts, stream_counts_table, stream_dedupe_load, stream_refresh,
    stream_windows,
)


def _events_stream(t):
    spark = t.events.sparkSession
    return file_stream(spark, t._dir, t.events.schema, glob="events.parquet")


@query("stream_dedupe", """
SELECT DISTINCT user_id, event_type FROM events
""")
def stream_dedupe_q(t):
    """One row per (patient, test): within two days by the stream's state,
    beyond them by the target, however long the history is."""
    spark = t.events.sparkSession
    base = work_dir(spark, "stream-dedupe")
    s = event_time(_events_stream(t), "ts").select("user_id", "event_type", "ts")
    spark.createDataFrame([], s.schema).write.parquet(f"{base}/out")
    stream_dedupe_load(s, f"{base}/out", ["user_id", "event_type"], "ts", "2 days", f"{base}/chk")
    return spark.read.parquet(f"{base}/out").select("user_id", "event_type")


@query("stream_keyed_load", """
SELECT event_id, user_id, ts FROM events
""")
def stream_keyed_load(t):
    """Target seeded with the first half of the month; the stream of all
    events appends only the keys it lacks."""
    spark = t.events.sparkSession
    base = work_dir(spark, "stream-keyed")
    cols = ["event_id", "user_id", "ts"]
    t.events.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 15))).select(*cols).write.parquet(f"{base}/table")
    stream_append_new(_events_stream(t).select(*cols), f"{base}/table", "event_id", f"{base}/chk")
    return spark.read.parquet(f"{base}/table")


@query("stream_keyed_partitions", """
SELECT event_id, user_id, ts, CASE WHEN event_id % 17 <> 0 THEN CAST(ts AS DATE) END AS day FROM events
UNION ALL SELECT event_id, user_id, ts, DATE '2023-12-01' FROM events WHERE event_id % 5 = 0
""")
def stream_keyed_partitions(t):
    """T2 on a target partitioned by day, with years of history in miniature: a
    micro-batch is compared with the days it has rows of (rows without a day
    are one of them); the stream comes twice, under checkpoints of its own."""
    spark = t.events.sparkSession
    base = work_dir(spark, "stream-partitions")
    day = F.when(F.col("event_id") % 17 != 0, F.to_date("ts")).alias("day")
    cols = ["event_id", "user_id", "ts"]
    old = t.events.filter("event_id % 5 = 0").select(*cols, F.lit(dt.date(2023, 12, 1)).alias("day"))
    seen = t.events.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 15))).select(*cols, day)
    old.unionByName(seen).write.partitionBy("day").parquet(f"{base}/table")
    for run in range(2):
        stream_append_new(_events_stream(t).select(*cols, day), f"{base}/table", "event_id", f"{base}/chk{run}", partition_by="day")
    return spark.read.schema(f"event_id bigint, user_id {t.events.schema['user_id'].dataType.simpleString()}, ts timestamp_ntz, day date").parquet(f"{base}/table")


@query("stream_daily_counts", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end,
       event_type, CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2, 3
""")
def stream_daily_counts(t):
    """Daily counts per test, the days that are still open included."""
    spark = t.events.sparkSession
    base = work_dir(spark, "stream-counts")
    c = stream_counts(_events_stream(t), "ts", "1 day", "event_type", "1 day")
    out = c.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                   F.col("window.end").cast("timestamp_ntz").alias("window_end"), "event_type", "n")
    return stream_counts_table(out, f"{base}/out", ["window_start", "window_end", "event_type"], f"{base}/chk")


@query("stream_refresh_split_period", """
SELECT event_id, user_id, value, CAST(ts AS DATE) AS day FROM events
""")
def stream_refresh_split_period(t):
    """T4: every day comes in two files of one extract, and so in two
    micro-batches; both halves are in the refreshed table."""
    spark = t.events.sparkSession
    base = work_dir(spark, "stream-split")
    e = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    e.withColumn("value", F.col("value") * 2).write.partitionBy("day").parquet(f"{base}/table")
    for half in (0, 1):
        e.filter(F.col("event_id") % 2 == half).withColumn("extract", F.lit(1)).coalesce(1).write.mode("append").parquet(f"{base}/landing")
    s = file_stream(spark, f"{base}/landing", e.withColumn("extract", F.lit(1)).schema, max_files=1)
    stream_refresh(s, f"{base}/table", "day", f"{base}/chk", extract="extract")
    return spark.read.parquet(f"{base}/table").select("event_id", "user_id", "value", "day")


@query("stream_keyed_null_replay", """
SELECT CASE WHEN event_id % 50 <> 0 THEN event_id END AS event_id, user_id FROM events
""")
def stream_keyed_null_replay(t):
    """A table that holds NULL keys gets the whole stream replayed: nothing
    is added, NULL keys included."""
    spark = t.events.sparkSession
    base = work_dir(spark, "stream-null")
    key = F.when(F.col("event_id") % 50 != 0, F.col("event_id")).alias("event_id")
    t.events.select(key, "user_id").write.parquet(f"{base}/table")
    stream_append_new(_events_stream(t).select(key, "user_id"), f"{base}/table", "event_id", f"{base}/chk")
    return spark.read.parquet(f"{base}/table")


@query("stream_refresh", """
SELECT event_id, user_id, value, CAST(ts AS DATE) AS day FROM events
""")
def stream_refresh_q(t):
    """T4: a stale copy (values doubled) is refreshed period by period."""
    spark = t.events.sparkSession
    base = work_dir(spark, "stream-refresh")
    e = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    e.withColumn("value", F.col("value") * 2).write.partitionBy("day").parquet(f"{base}/table")
    s = _events_stream(t).select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    stream_refresh(s, f"{base}/table", "day", f"{base}/chk")
    return spark.read.parquet(f"{base}/table").select("event_id", "user_id", "value", "day")


_DAY_SQL = "CASE WHEN user_id % 17 <> 0 THEN CAST(ts AS DATE) END"


@query("stream_refresh_versions", f"""
SELECT event_id, {_DAY_SQL} AS day, CASE WHEN again THEN value + 1 ELSE value END AS value
FROM (SELECT *, coalesce(dayofmonth({_DAY_SQL}) % 3 = 0, true) AS again FROM events)
WHERE NOT (again AND event_id % 10 = 0)
""")
def stream_refresh_versions(t):
    """T4/K5: a first extract in two files; then every third day and the rows
    without a day are extracted again, in two files, changed and without the
    rows that the source has deleted; then an extract that is older than both
    comes late. Each micro-batch reads the periods it brings."""
    spark = t.events.sparkSession
    base = work_dir(spark, "stream-versions")
    day = F.when(F.col("user_id") % 17 != 0, F.to_date("ts"))
    e = t.events.select("event_id", "value", day.alias("day"))
    again = e.filter(F.coalesce(F.dayofmonth("day") % 3 == 0, F.lit(True)) & (F.col("event_id") % 10 != 0)).withColumn(
        "value", F.col("value") + 1)
    for df, extract in ((e, 20240201), (again, 20240202)):
        for half in (0, 1):
            df.filter(F.col("event_id") % 2 == half).withColumn("extract", F.lit(extract)).coalesce(1).write.mode(
                "append").parquet(f"{base}/landing")
    late = e.filter(F.col("event_id") % 5 == 0).withColumn("value", -F.col("value")).withColumn("extract", F.lit(20240131))
    late.coalesce(1).write.mode("append").parquet(f"{base}/landing")
    s = file_stream(spark, f"{base}/landing", late.schema, max_files=1)
    stream_refresh(s, f"{base}/table", "day", f"{base}/chk", extract="extract")
    return spark.read.schema(e.schema).parquet(f"{base}/table").select("event_id", "day", "value")


_LATE_SQL = "event_id % 10 = 0 AND ts < TIMESTAMP '2024-01-15'"


@query("stream_weekly_late", f"""
SELECT 'count' AS part, CAST(date_trunc('week', ts) AS TIMESTAMP) AS week, event_type, CAST(NULL AS BIGINT) AS event_id,
       CAST(count(*) AS BIGINT) AS n
FROM events WHERE NOT ({_LATE_SQL}) GROUP BY 2, 3
UNION ALL
SELECT 'late', NULL, event_type, event_id, 1 FROM events WHERE {_LATE_SQL}
""")
def stream_weekly_late(t):
    """Weekly counts per test (weeks from Monday, open ones included);
    rows of the first weeks that come after all others are in the side table."""
    spark = t.events.sparkSession
    base = work_dir(spark, "stream-weeks")
    e = t.events.select("event_id", "event_type", "ts")
    late = (F.col("event_id") % 10 == 0) & (F.col("ts") < F.lit(dt.datetime(2024, 1, 15)))
    early = F.col("ts") < F.lit(dt.datetime(2024, 1, 15))
    for part in (e.filter(early & ~late), e.filter(~early), e.filter(late)):
        part.coalesce(1).write.mode("append").parquet(f"{base}/landing")
    s = file_stream(spark, f"{base}/landing", e.schema, max_files=1)
    n = stream_windows(s, "ts", "7 days", "event_type", dt.timedelta(days=7), f"{base}/weeks", f"{base}/late", f"{base}/chk",
                       start="4 days")
    rest = spark.read.schema(e.schema).parquet(f"{base}/late")
    null = F.lit(None)
    return n.select(F.lit("count").alias("part"), F.col("window_start").alias("week"), "event_type",
                    null.cast("long").alias("event_id"), "n").unionByName(
        rest.select(F.lit("late").alias("part"), null.cast("timestamp_ntz").alias("week"), "event_type", "event_id",
                    F.lit(1).cast("long").alias("n")))
