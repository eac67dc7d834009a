"""Shared helpers: reading tables, shared-folder tables, text-to-words, Arrow column appending.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]`` unless an operator says
otherwise; on UTF-8 bytes that is exactly what ``bytes.split()`` returns.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh3_64_intdigest

WORD = r"[^\x20\x09-\x0D]+"
#: Characters of text that one numpy step holds; longer texts form a step of their own.
STEP_CHARS = 1_000_000
#: Rows of an Arrow batch at most: whole texts in batches of Spark's default 10,000 rows take too much memory.
BATCH_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names.

    Only where it is unset, and only on a local master (tests), a scratch
    folder is made; on a cluster a missing setting is an error, because a
    machine-local folder would be invisible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="carelake-llm-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{tag}-{uuid.uuid4().hex[:12]}"


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives a lost executor."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    _MADE.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Paths of the intermediate tables that this process has written and not dropped.
_MADE: list[str] = []


def stashes() -> list[str]:
    return list(_MADE)


def drop_stashes(spark: SparkSession, paths: list[str]) -> None:
    """Deletes intermediate tables of this process (other paths are left alone)."""
    for p in paths:
        if p in _MADE:
            _MADE.remove(p)
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def share(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcast an object of this package's own classes by value; call the result in a task to get it."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


def fold(col: F.Column | str, n: int) -> F.Column:
    """crc32(id as text) mod n; a null id has fold -1 and is in no fold."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % n, F.lit(-1))


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; none for null."""
    return [] if text is None else utf8(text).split()


def utf8(text: str) -> bytes:
    """UTF-8 bytes; a lone surrogate (possible after character references) becomes ``?``."""
    return text.encode("utf-8", "replace")


def word_hashes(ws: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word (XXH3, the same on every machine)."""
    return np.fromiter(map(xxh3_64_intdigest, ws), np.uint64, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64 (fixed constants)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(h: np.ndarray, n: int, gap: int = 1) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive values (or of values ``gap`` apart)."""
    m = len(h) - (n - 1) * gap
    if m <= 0:
        return np.empty(0, np.uint64)
    out = h[:m] + np.uint64(n * 131 + gap)
    for i in range(1, n):  # a polynomial in the word hashes, modulo 2**64
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[i * gap:i * gap + m]
    return out ^ (out >> np.uint64(29))


def append_columns(df: DataFrame, text_col: str, keep: list[str], fields: list[tuple[str, T.DataType]],
                   make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """``keep`` columns plus new ``fields`` computed from ``text_col``, one output row per input row.

    ``make()`` runs once per task and returns ``fn(texts) -> [values of field 0, ...]``.
    Column positions are used inside, so clashing names of other columns do no harm.
    """
    src = df.select(*[F.col(_q(c)).alias(f"k{i}") for i, c in enumerate(keep)], F.col(_q(text_col)).alias("t"))
    out = T.StructType([T.StructField(f"k{i}", src.schema[i].dataType) for i in range(len(keep))]
                       + [T.StructField(f"f{i}", t) for i, (_, t) in enumerate(fields)])
    kinds = [to_arrow_type(t) for _, t in fields]
    n_keep = len(keep)

    def run(batches):
        fn = make()
        for b in batches:
            if not b.num_rows:
                continue
            col = b.column(n_keep)
            for a, z in _slices(col):
                vals = fn(col.slice(a, z - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(a, z - a) for i in range(n_keep)]
                    + [pa.array(v, k) for v, k in zip(vals, kinds)],
                    names=[f.name for f in out])

    _small_batches(src)
    res = src.mapInArrow(run, out)
    return res.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
                      *[F.col(f"f{i}").alias(n) for i, (n, _) in enumerate(fields)])


def _small_batches(df: DataFrame) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))


def _slices(col: pa.Array) -> Iterator[tuple[int, int]]:
    import pyarrow.compute as pc
    n = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    a, size = 0, 0
    for i, x in enumerate(n):
        if i > a and size + x > STEP_CHARS:
            yield a, i
            a, size = i, 0
        size += int(x)
    yield a, len(n)


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def emit(df: DataFrame, cols: list[str], schema: str | T.StructType,
         run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """mapInArrow over ``cols`` (by position) where ``run`` yields dicts of column values."""
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = [to_arrow_type(f.dataType) for f in st]
    names = [f.name for f in st]

    def go(batches):
        for d in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(d[n], k) for n, k in zip(names, kinds)], names=names)

    src = df.select(*[F.col(_q(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    _small_batches(src)
    return src.mapInArrow(go, st)


def read_texts(batches, text_at: int) -> Iterator[tuple[pa.RecordBatch, int, int, list]]:
    """(batch, from, to, texts) in slices near STEP_CHARS."""
    for b in batches:
        if b.num_rows:
            col = b.column(text_at)
            for a, z in _slices(col):
                yield b, a, z, col.slice(a, z - a).to_pylist()

