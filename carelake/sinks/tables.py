"""Sinks and table mutation.

Parquet tables here have no MERGE/DELETE, so every mutation is expressed as
the new table state (a DataFrame) and written copy-on-write:

* the new state is checkpointed into the cluster's shared checkpoint folder
  (``spark.checkpoint.dir``), which cuts its lineage from the files being
  replaced and survives executor loss, then written over the target; or
* for partitioned tables, dynamic partition overwrite replaces only the
  partitions present in the written data.

Row counts come from ``DataFrame.observe`` during the write itself, so no
extra pass and nothing but one number reaches the driver.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions import coerce as C
from carelake.operators.shape import conform, conformed
from carelake.session import work_dir

__all__ = [
    "append", "overwrite", "overwrite_partitions", "only", "rewrite", "refresh_window_df", "refresh_window",
    "refresh_partitions", "export_csv", "replace_period_df",
    "replace_period", "merge_update_df", "update_from_df", "write_with_schema", "LOG_SCHEMA",
    "log_load", "snapshot_csv", "PublishSpec", "publish_all", "create_table", "drop_table",
    "run_summary", "jdbc_write", "dual_write", "in_values", "drop_partitions", "merge_partitions", "load_once", "committed",
    "save_bucketed",
]

LOG_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("fechaCargue", T.TimestampNTZType()),
    T.StructField("totalRegistros", T.LongType()),
    T.StructField("idBigquery", T.StringType()),
])


#: How reports and state files are written; the writer's own timestamp form would drop the microseconds.
_CSV = {"sep": ";", "header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _write(df: DataFrame, path: str, mode: str, fmt: str = "parquet", partition_by=None, **opts) -> int:
    obs = Observation(f"w{uuid.uuid4().hex[:8]}")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode(mode).format(fmt).options(**opts)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)
    return int(obs.get.get("n", 0) or 0)


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> int:
    """K1: append; returns the number of rows written (0 for an empty batch)."""
    return _write(df, path, "append", fmt, partition_by)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> int:
    """K2/K7: truncate and reload (``df`` must not read ``path``; see rewrite).

    The write says so itself (static partition overwrite): under the session's
    dynamic mode a partition that is absent from ``df`` would survive.
    """
    return _write(df, path, "overwrite", fmt, partition_by, partitionOverwriteMode="static")


def overwrite_partitions(df: DataFrame, path: str, partition_by) -> int:
    """Replace exactly the partitions that ``df`` holds rows of."""
    return _write(df, path, "overwrite", "parquet", partition_by, partitionOverwriteMode="dynamic")


def in_values(col: str, values) -> Column:
    """``col`` is one of the literal values, NULL among them if it is one (partitions are pruned by it)."""
    some = [v for v in values if v is not None]
    cond = F.col(col).isin(some) if some else F.lit(False)
    return cond | F.col(col).isNull() if len(some) < len(list(values)) else cond


def drop_partitions(spark: SparkSession, path: str, parts: DataFrame) -> int:
    """Deletes the partitions of a table that the rows of ``parts`` name, outermost column first (a row a partition)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    named = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    rows = parts.select(*[F.col(c).cast("string") for c in parts.columns]).distinct().collect()
    for r in rows:
        p = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *[named.getPartitionPathString(c, r[c]) for c in parts.columns]]))
        p.getFileSystem(conf).delete(p, True)
    return len(rows)


def only(df: DataFrame, cond: Column, what: str) -> DataFrame:
    """``df``, failing the job on the first row that doesn't meet ``cond`` (NULL fails too)."""
    bad = F.raise_error(F.concat(F.lit(f"row outside of {what}: "), F.to_json(F.struct(*df.columns)))).cast("boolean")
    return df.filter(F.when(F.coalesce(cond, F.lit(False)), F.lit(True)).otherwise(bad))


def _append_rest(keep: DataFrame, new: DataFrame, inside: Column, what: str, key) -> DataFrame:
    """Kept target rows plus the batch. Batch rows that are not ``inside`` the
    reloaded part would be appended again by every run: with ``key`` they are
    added unless the kept rows hold their key (NULL keys compare equal), and
    without one they fail the job. None is dropped."""
    from carelake.sinks.gates import new_rows
    if key is None:
        return keep.unionByName(only(new, inside, what), allowMissingColumns=True)
    ok = F.coalesce(inside, F.lit(False))
    rest = new_rows(new.filter(~ok), keep, key, null_safe=True)
    return keep.unionByName(new.filter(ok), allowMissingColumns=True).unionByName(rest, allowMissingColumns=True)


def rewrite(state: DataFrame, path: str, partition_by=None) -> int:
    """Write a new state of a table that was computed *from* that table.

    A reliable checkpoint (shared folder) materializes the state first, so
    the overwrite no longer reads the files it replaces.
    """
    work_dir(state.sparkSession)  # ensures a checkpoint folder exists
    return overwrite(state.checkpoint(eager=True), path, partition_by=partition_by)


def refresh_window_df(target: DataFrame, new: DataFrame, col: str, lo, key=None) -> DataFrame:
    """K5 state: target rows before the window start, plus the whole batch.

    Target rows with a NULL date are kept. Batch rows before the window or
    without a date are added by ``key``, or fail the job (see _append_rest).
    """
    keep = target.filter(~F.coalesce(F.col(col) >= F.lit(lo), F.lit(False)))
    return _append_rest(keep, new, F.col(col) >= F.lit(lo), f"{col} >= {lo}", key)


def refresh_window(spark: SparkSession, path: str, new: DataFrame, col: str, lo, key=None) -> int:
    """K5: idempotent window reload of an unpartitioned table (copy-on-write)."""
    return rewrite(refresh_window_df(spark.read.parquet(path), new, col, lo, key), path)


def refresh_partitions(new: DataFrame, path: str, day_col: str, lo, hi) -> int:
    """K5 on a table partitioned by a date: only partitions in ``[lo, hi)`` are rewritten.

    Dates of the window that the batch lacks are emptied as well (their rows
    were deleted at the source); batch rows outside the window fail the job.
    Every other partition stays as it is, whatever becomes of the run.
    """
    spark = new.sparkSession
    n = overwrite_partitions(only(new, (F.col(day_col) >= F.lit(lo)) & (F.col(day_col) < F.lit(hi)),
                                  f"{day_col} in [{lo}, {hi})"), path, day_col)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    have = {r[0] for r in spark.read.parquet(path).filter((F.col(day_col) >= F.lit(lo)) & (F.col(day_col) < F.lit(hi)))
            .select(day_col).distinct().collect()}  # a row per partition
    held = {r[0] for r in new.select(day_col).distinct().collect()}
    for day in have - held:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{day_col}={day}")
        p.getFileSystem(conf).delete(p, True)
    return n


def replace_period_df(target: DataFrame, new: DataFrame, period_col: str, value, key=None) -> DataFrame:
    """K6 state: every period but ``value`` kept, ``value`` replaced by the batch.

    Batch rows of another period are added by ``key``, or fail the job.
    """
    keep = target.filter(~F.coalesce(F.col(period_col) == F.lit(value), F.lit(False)))
    return _append_rest(keep, new, F.col(period_col) == F.lit(value), f"{period_col} = {value}", key)


def replace_period(new: DataFrame, path: str, period_col: str, value) -> int:
    """K6 on a table partitioned by ``period_col``: replaces exactly that
    partition; batch rows of another period fail the job."""
    return overwrite_partitions(only(new, F.col(period_col) == F.lit(value), f"{period_col} = {value}"), path, period_col)


def merge_update_df(target: DataFrame, source: DataFrame, keys, set_cols, when: Column | None = None,
                    only_changed: bool = False) -> DataFrame:
    """K8/K9 state: ``UPDATE target SET cols = source.cols WHERE keys match``.

    Unmatched target rows are unchanged, unmatched source rows ignored, a
    matched NULL overwrites (K8). ``only_changed=True`` updates only where
    the values differ (``t.v <> s.v``: a NULL on either side is no update,
    K9); ``when`` is an extra condition on target columns (date floor).
    Several source rows for one matched key fail the job (checked lazily
    inside the plan with ``raise_error``, per key, on the executors).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    set_cols = [set_cols] if isinstance(set_cols, str) else list(set_cols)
    src = source.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(f"__s_{c}") for c in set_cols])
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k_{k}") for k in keys])
    j = target.join(src, cond, "left")
    matched = F.col("__n").isNotNull()
    if when is not None:
        matched = matched & F.coalesce(when, F.lit(False))

    # A filter, not a value: it stays in the plan whatever columns are selected.
    dup = F.raise_error(F.lit("merge source has duplicate keys")).cast("boolean")
    j = j.filter(F.when(F.col("__n") > 1, dup).otherwise(F.lit(True)))

    def new_value(c: str) -> Column:
        m = matched
        if only_changed:
            m = m & F.coalesce(F.col(c) != F.col(f"__s_{c}"), F.lit(False))
        return F.when(m, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c)

    return j.select(*[new_value(c) if c in set_cols else F.col(c) for c in target.columns])


def update_from_df(target: DataFrame, source: DataFrame, keys, set_cols, floor_col: str | None = None,
                   floor=None) -> DataFrame:
    """K9: update from an aggregated/windowed source where values differ,
    only for target rows at or after a date floor."""
    when = (F.col(floor_col) >= F.lit(floor)) if floor_col else None
    return merge_update_df(target, source, keys, set_cols, when=when, only_changed=True)


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys, set_cols, partition_by: str,
                     when: Column | None = None, only_changed: bool = False) -> int:
    """K8/K9 on a partitioned table: only partitions that hold a matched key are rewritten.

    The touched partitions (one value each on the driver) are a literal filter of
    the scan, so the others are neither read for the new state nor written. The
    number of rows written; the duplicate-key check is merge_update_df's.
    """
    from carelake.operators.lookup import semi
    keys = [keys] if isinstance(keys, str) else list(keys)
    set_cols = [set_cols] if isinstance(set_cols, str) else list(set_cols)
    if partition_by in set_cols:
        raise ValueError(f"{partition_by} is the partition column: an update of it would move rows")
    target = spark.read.parquet(path)
    found = source.select(partition_by) if partition_by in keys else semi(
        target.select(*keys, partition_by), source, keys).select(partition_by)
    touched = [r[0] for r in found.distinct().collect()]
    if not touched:
        return 0
    work_dir(spark)
    state = merge_update_df(target.filter(in_values(partition_by, touched)), source, keys, set_cols, when, only_changed)
    return overwrite_partitions(state.checkpoint(eager=True), path, partition_by)


def load_once(df: DataFrame, path: str, log_path: str, load_id: str, table: str, at: dt.datetime) -> int:
    """K1+K12 as one commit: the rows under ``load_id=``, then the log row that makes them count.

    A run that stops between the two leaves rows that ``committed`` doesn't
    show; the rerun under the same id replaces them, and its log row.
    """
    spark = df.sparkSession
    n = write_load(df, path, load_id)
    row = spark.createDataFrame([(load_id, at, n, table)], LOG_SCHEMA)
    overwrite_partitions(row, log_path, ["idBigquery", "id"])
    return n


def write_load(df: DataFrame, path: str, load_id: str) -> int:
    """The first half of ``load_once``: the load's rows, in place of those of an earlier try."""
    spark = df.sparkSession
    n = overwrite_partitions(df.withColumn("load_id", F.lit(load_id)), path, "load_id")
    if not n:
        drop_partitions(spark, path, spark.createDataFrame([(load_id,)], "load_id string"))
    return n


def committed(spark: SparkSession, path: str, log_path: str, table: str, schema) -> DataFrame:
    """The rows of the loads that the log names, with their ``load_id``."""
    from carelake.operators.lookup import semi
    kind = T.StructType(list(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema) + [T.StructField("load_id", T.StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], kind)
    loads = read_log(spark, log_path).filter(F.col("idBigquery") == F.lit(table)).select(F.col("id").alias("load_id"))
    return semi(spark.read.schema(kind).parquet(path), loads, "load_id")


def save_bucketed(df: DataFrame, name: str, path: str, key, buckets: int) -> DataFrame:
    """A catalog table at ``path`` in hash buckets of ``key``, sorted in them: a join
    by the key with as many shuffle partitions reads it without an exchange, so
    that a keyed load (G5-G8) shuffles its batch only."""
    keys = [key] if isinstance(key, str) else list(key)
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_with_schema(df: DataFrame, schema: T.StructType, path: str, mode: str = "append",
                      date_formats=("yyyy-MM-dd",)) -> tuple[int, dict[str, int]]:
    """Explicit target types on write: rows written, and per column the
    cells that held a value and could not be converted (written as NULL)."""
    typed = conform(df, schema, date_formats)
    flagged = df.select(*[F.col(c).alias(f"__r_{c}") for c in df.columns])
    both = flagged.select("*", *[conformed(F.col(f"__r_{f.name}"), df.schema[f.name].dataType, f.dataType, date_formats)
                                 .alias(f.name) for f in schema.fields])
    obs = Observation(f"w{uuid.uuid4().hex[:8]}")
    bad = [F.sum(C.bad_value(f"__r_{f.name}", f.name)).alias(f"bad_{f.name}") for f in schema.fields]
    out = both.observe(obs, F.count(F.lit(1)).alias("n"), *bad).select(*typed.columns)
    out.write.mode(mode).parquet(path)
    got = obs.get
    return int(got.get("n", 0) or 0), {f.name: int(got.get(f"bad_{f.name}") or 0) for f in schema.fields}


def log_load(spark: SparkSession, log_path: str, n: int, table: str, at: dt.datetime) -> int:
    """Append the audit row ``(id, at, n, table)``."""
    row = spark.createDataFrame([(uuid.uuid4().hex, at, int(n), table)], LOG_SCHEMA)
    return append(row, log_path)


def snapshot_csv(df: DataFrame, path: str, period: str) -> int:
    """Month state file (``;``-separated, header) under ``period=`` ."""
    return _write(df, f"{path.rstrip('/')}/period={period}", "overwrite", "csv", **_CSV)


@dataclass
class PublishSpec:
    """One output of a multi-table job."""

    table: str
    df: DataFrame
    mode: str = "append"
    period_col: str | None = None
    grain: str = "monthly"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The load log; empty before the first load. Any other failure is one."""
    if path_exists(spark, log_path):
        return spark.read.schema(LOG_SCHEMA).parquet(log_path)
    return spark.createDataFrame([], LOG_SCHEMA)


def publish_all(specs, base: str, log_path: str, run: dt.date, at: dt.datetime | None = None) -> DataFrame:
    """For each spec: gate on the load log, drop the rows whose
    period the target already holds (the NULL period is one), stop on an empty batch, write (append or
    overwrite), log the load; returns the run summary (one row per table).

    ``loaded``: 1 written, 0 gate closed, -1 nothing to write (the target is
    left as it is: an empty batch never empties a table).
    """
    from carelake.operators.lookup import anti
    from carelake.sinks.gates import gate
    spark = specs[0].df.sparkSession if specs else None
    at = at or dt.datetime.combine(run, dt.time())
    rows = []
    for s in specs:
        if gate(read_log(spark, log_path), s.table, s.grain, run).first()["proceed"] != 1:
            rows.append((s.table, 0, at, 0))
            continue
        path = f"{base.rstrip('/')}/{s.table}"
        df = s.df
        if s.period_col and s.mode == "append" and path_exists(spark, path):
            df = anti(df, spark.read.schema(df.schema).parquet(path).select(s.period_col).distinct(), s.period_col, null_safe=True)
        work_dir(spark)
        df = df.checkpoint(eager=True)  # once, whether it turns out empty or not
        n = 0 if df.isEmpty() else (append if s.mode == "append" else overwrite)(df, path, partition_by=s.period_col)
        if n:
            log_load(spark, log_path, n, s.table, at)
        rows.append((s.table, int(n), at, 1 if n else -1))
    return run_summary(spark, rows)


def export_csv(df: DataFrame, path: str) -> int:
    """A report as ``;`` CSV with a header, only if it has rows (an empty
    one leaves the earlier export); returns the number of rows."""
    if df.isEmpty():
        return 0
    return _write(df, path, "overwrite", "csv", **_CSV)


def run_summary(spark: SparkSession, rows) -> DataFrame:
    """``(table, rows, load time, loaded)`` as a small DataFrame."""
    return spark.createDataFrame(rows, "table string, rows bigint, loaded_at timestamp_ntz, loaded int")


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> DataFrame:
    """Catalog table (parquet), created when missing."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    kw = {"path": path} if path else {}
    return spark.catalog.createTable(name, schema=schema, source="parquet", **kw)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop, a missing table tolerated."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", props: dict | None = None,
               batchsize: int = 20000, num_partitions: int | None = None) -> None:
    """K3: operational-database write in batches of 20,000 rows; parallel
    connections are bounded by ``num_partitions``."""
    if num_partitions:
        df = df.coalesce(num_partitions)
    df.write.mode(mode).jdbc(url, table, properties={"batchsize": str(batchsize), **(props or {})})


def dual_write(df: DataFrame, first, second) -> tuple:
    """K4: materialize once (reliable checkpoint), then two writes
    (``first``/``second`` are callables taking the DataFrame)."""
    work_dir(df.sparkSession)
    staged = df.checkpoint(eager=True)
    return first(staged), second(staged)
