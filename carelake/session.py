"""Session construction and the shared work folder.

Settings chosen for scale:
* AQE on, with partition coalescing and skew-join splitting, so the shuffle
  partition count can be sized for the largest stage and shrink at runtime.
* ``partitionOverwriteMode=dynamic`` so window/period reloads only replace the
  partitions they write.
* Session time zone UTC and ANSI mode on (coercions use ``try_*``).
* The work folder (for copy-on-write table rewrites and streaming
  checkpoints) is read from ``spark.checkpoint.dir``; only when it is unset
  and the master is local (tests) a scratch folder is created.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "carelake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    master = master or os.environ.get("CARELAKE_MASTER", "local[*]")
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.driver.memory"] = os.environ.get("CARELAKE_DRIVER_MEMORY", "8g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Session-level settings that operators rely on (safe to call twice)."""
    for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.session.timeZone"):
        spark.conf.set(k, DEFAULT_CONF[k])


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder on a cluster. Where it is
    unset, a local master (tests) gets a new scratch folder; any other master
    is refused, because each executor would write to its own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="carelake-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    sub = f"{name or 'work'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + sub


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
