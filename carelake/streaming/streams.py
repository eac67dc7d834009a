"""Structured Streaming operators.

The batch jobs handle late data by re-reading an overlapping window and
discarding known keys, or by deleting and reloading the window. As streams:

* T1 ``stream_dedupe``: watermark + ``dropDuplicatesWithinWatermark``; state
  is bounded by the delay (keys older than the watermark are forgotten).
* T2 ``stream_append_new``: ``foreachBatch`` with a left anti join against
  the target before appending; replaying an epoch after a failure appends
  nothing twice (the target already holds those keys).
* T3 ``stream_counts``: tumbling windows with a watermark, append mode: a
  window is emitted once, when the watermark passes its end; later rows for
  it are dropped (the late-data cut-off). ``stream_windows`` keeps them in a
  side table, and the open windows beside the closed ones.
* T4 ``stream_refresh``: ``foreachBatch`` + dynamic partition overwrite: a
  micro-batch replaces exactly the periods it carries, by the newest extract
  of each.

Every query checkpoints into the shared folder named by
``spark.checkpoint.dir`` so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carelake.session import work_dir
from carelake.sinks.gates import new_in_partitions, new_rows
from carelake.sinks.tables import append, drop_partitions, in_values, overwrite_partitions, path_exists

__all__ = ["event_time", "stream_dedupe", "stream_append_new", "stream_counts", "stream_refresh",
           "run_available", "file_stream", "stream_dedupe_load", "stream_counts_table", "stream_windows"]


def file_stream(spark: SparkSession, directory: str, schema, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    """A Parquet file source over a landing folder (new files = new rows)."""
    r = spark.readStream.schema(schema).format("parquet")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(directory)


def event_time(sdf: DataFrame, ts: str) -> DataFrame:
    """Watermarks need ``timestamp`` (not ``timestamp_ntz``): cast in the
    session time zone (UTC), which keeps the wall clock."""
    return sdf.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_dedupe(sdf: DataFrame, key, ts: str, delay: str) -> DataFrame:
    """First row per key within the watermark delay."""
    keys = [key] if isinstance(key, str) else list(key)
    return event_time(sdf, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def stream_dedupe_load(sdf: DataFrame, table_path: str, key, ts: str, delay: str,
                       checkpoint: str | None = None) -> StreamingQuery:
    """T1 beyond the delay: duplicates within it are dropped by the stream's
    bounded state, older ones by the target (T2)."""
    return stream_append_new(stream_dedupe(sdf, key, ts, delay), table_path, key, checkpoint)


def stream_counts_table(counts: DataFrame, path: str, keys, checkpoint: str | None = None) -> DataFrame:
    """T3 with its open windows: every trigger's changed counts are staged under
    their epoch (update mode); the result is the latest count of each key."""
    spark = counts.sparkSession
    checkpoint = checkpoint or work_dir(spark, "chk-counts")

    def stage(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            overwrite_partitions(batch.withColumn("epoch", F.lit(epoch)), path, "epoch")

    run_available(counts.writeStream.outputMode("update").foreachBatch(stage), checkpoint)
    return spark.read.parquet(path).groupBy(*keys).agg(F.max_by("n", "epoch").alias("n"))


def stream_counts(sdf: DataFrame, ts: str, width: str, keys, delay: str) -> DataFrame:
    """Rows per tumbling window (and keys), late rows beyond ``delay`` cut."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    s = event_time(sdf, ts).withWatermark(ts, delay)
    return s.groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def run_available(sdf_writer, checkpoint: str) -> StreamingQuery:
    """Process everything available now, then stop (batch-like scheduling of
    a streaming query; rerun later to pick up new files)."""
    q = sdf_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def stream_append_new(sdf: DataFrame, table_path: str, key, checkpoint: str | None = None, since=None,
                      since_col: str | None = None, partition_by: str | None = None) -> StreamingQuery:
    """Continuous keyed load: each micro-batch minus the keys already in
    the target is appended (NULL keys compare equal, so a replay adds nothing
    twice). The part of the target that is looked at is bounded by ``since``, or
    by ``partition_by``, the target's partition column, which is then part of the
    key: a micro-batch reads the partitions that it has rows of."""
    spark = sdf.sparkSession
    checkpoint = checkpoint or work_dir(spark, "chk-append")

    def load(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if partition_by is None:
            append(new_rows(batch, spark.read.parquet(table_path), key, since=since, since_col=since_col, null_safe=True), table_path)
            return
        target = spark.read.schema(batch.schema).parquet(table_path) if path_exists(spark, table_path) else batch.limit(0)
        append(new_in_partitions(batch, target, key, partition_by, null_safe=True), table_path, partition_by=partition_by)

    return run_available(sdf.writeStream.foreachBatch(load), checkpoint)


def stream_refresh(sdf: DataFrame, table_path: str, period: str, checkpoint: str | None = None,
                   extract: str | None = None) -> StreamingQuery:
    """T4/K5: each micro-batch replaces the partitions (periods) it contains, by the newest extract of each.

    ``extract`` names the column that tells extracts apart (greater is newer;
    NULL is oldest): the parts of one extract come in several micro-batches
    and add up, a later extract of a period replaces it whole, and an older
    one that comes late changes nothing. Without it every micro-batch is an
    extract of its own. The NULL period is a period.

    A batch is first staged under (period, extract, epoch), so that a replay
    replaces it; then its periods, a literal filter, are read back and
    written. What a newer extract has replaced is dropped from the staging
    table, whose size so stays that of the periods' newest extracts.
    """
    checkpoint = checkpoint or work_dir(sdf.sparkSession, "chk-refresh")
    staged = f"{checkpoint.rstrip('/')}-staged"
    parts = [period, "__version", "__epoch"]

    def refresh(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        version = F.col(extract) if extract else F.lit(epoch).cast("long")
        new = batch.withColumn("__version", version).withColumn("__epoch", F.lit(epoch).cast("long"))
        overwrite_partitions(new, staged, parts)
        held = [r[0] for r in batch.select(period).distinct().collect()]  # a row a partition to be written
        mine = spark.read.schema(new.schema).parquet(staged).filter(in_values(period, held))
        newest = F.broadcast(mine.groupBy(F.col(period).alias("__p")).agg(F.max("__version").alias("__newest")))  # a row of held each
        both = mine.join(newest, F.col(period).eqNullSafe(F.col("__p")))
        latest = F.col("__version").eqNullSafe(F.col("__newest"))
        state = both.filter(latest).select(*[c for c in batch.columns if c != extract])
        overwrite_partitions(state, table_path, period)
        drop_partitions(spark, staged, both.filter(~latest).select(*parts[:2]))

    return run_available(sdf.writeStream.foreachBatch(refresh), checkpoint)


def stream_windows(sdf: DataFrame, ts: str, width: str, keys, delay: dt.timedelta, table_path: str, late_path: str,
                   checkpoint: str | None = None, start: str | None = None) -> DataFrame:
    """T3 with its late rows: counts per window and keys, and every row that came after its window was closed.

    A window is closed when the latest time of *earlier* micro-batches less
    ``delay`` has passed its end; its counts are then in ``table_path``, for
    good. Rows that come later, or without a time, are kept in ``late_path``
    instead of being dropped. ``start`` shifts the windows (``4 days`` makes
    7-day windows begin on Mondays).

    The open windows' counts are one partition per epoch, made from the one
    before; older ones are dropped, so state and work grow with the
    open windows, not with the history. Each write replaces its own
    partitions, so a replayed epoch gives the same tables. Returns closed and open counts:
    ``window_start, window_end, keys, n``.
    """
    spark = sdf.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    checkpoint = (checkpoint or work_dir(spark, "chk-windows")).rstrip("/")
    open_path, marks_path = f"{checkpoint}-open", f"{checkpoint}-marks"
    w = F.window(F.col(ts).cast("timestamp"), width, width, start) if start else F.window(F.col(ts).cast("timestamp"), width)
    ends = [w.getField(x).cast("timestamp_ntz").alias(f"window_{x}") for x in ("start", "end")]
    group = ["window_start", "window_end", *keys]
    counts = T.StructType([T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType()),
                           *[sdf.schema[k] for k in keys], T.StructField("n", T.LongType()), T.StructField("epoch", T.LongType())])
    marks = "latest timestamp_ntz, epoch long"

    def read(session: SparkSession, path: str, schema) -> DataFrame:
        return session.read.schema(schema).parquet(path) if path_exists(session, path) else session.createDataFrame([], schema)

    def load(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        before = read(session, marks_path, marks).filter(F.col("epoch") < epoch).agg(
            F.max("latest").alias("latest"), F.max("epoch").alias("epoch")).first()
        here = batch.agg(F.max(F.col(ts).cast("timestamp_ntz"))).first()[0]
        latest = max((x for x in (before.latest, here) if x is not None), default=None)
        shut = F.lit(False) if before.latest is None else F.col("window_end") <= F.lit(before.latest - delay)
        dated = batch.filter(F.col(ts).isNotNull()).select("*", *ends)
        late = dated.filter(shut).drop("window_start", "window_end").unionByName(batch.filter(F.col(ts).isNull()))
        overwrite_partitions(late.withColumn("epoch", F.lit(epoch)), late_path, "epoch")
        had = read(session, open_path, counts).filter(F.col("epoch") == F.lit(before.epoch))
        new = dated.filter(~shut).groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
        state = had.select(*group, "n").unionByName(new).groupBy(*group).agg(F.sum("n").alias("n"))
        done = F.lit(False) if latest is None else F.col("window_end") <= F.lit(latest - delay)
        overwrite_partitions(state.filter(done), table_path, "window_start")
        overwrite_partitions(state.filter(~done).withColumn("epoch", F.lit(epoch).cast("long")), open_path, "epoch")
        mark = session.createDataFrame([(latest, epoch)], marks)
        overwrite_partitions(mark, marks_path, "epoch")
        if before.epoch is not None:
            old = read(session, open_path, counts).select("epoch").filter(F.col("epoch") < F.lit(before.epoch))
            drop_partitions(session, open_path, old)

    run_available(sdf.writeStream.foreachBatch(load), checkpoint)
    last = read(spark, marks_path, marks).agg(F.max("epoch")).first()[0]
    closed = read(spark, table_path, T.StructType(counts.fields[:-1]))
    return closed.select(*group, "n").unionByName(
        read(spark, open_path, counts).filter(F.col("epoch") == F.lit(last)).select(*group, "n"))
