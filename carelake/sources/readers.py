"""Readers (S1-S15).

Files are read with explicit schemas (no inference pass), several files in
one ``spark.read`` call (one scan, parallel over files and splits), and
provenance from the hidden ``_metadata`` column instead of a Python loop
over paths.
"""

from __future__ import annotations

import fnmatch
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.shape import reconciled, to_schema

__all__ = [
    "scan_jdbc", "scan_sql", "scan_csv", "with_file_name", "drop_footer_rows", "scan_sheet",
    "list_files", "latest_file", "existing_paths", "scan_union", "inline_table", "string_schema",
    "scan_lines", "drop_last_lines", "parse_lines", "scan_drifting",
]


def scan_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              partition_column: str | None = None, lower=None, upper=None, num_partitions: int = 8,
              props: dict | None = None, fetchsize: int = 10000) -> DataFrame:
    """Operational-database read. With ``partition_column`` the read
    is split into ``num_partitions`` range queries (parallel, bounded
    connections); filters and projections applied later are pushed into the
    generated SQL."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetchsize))
    for k, v in (props or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", table or f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", str(lower)).option("upperBound", str(upper))
             .option("numPartitions", str(num_partitions)))
    elif query:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", table)
    return r.load()


def scan_sql(spark: SparkSession, sql: str) -> DataFrame:
    """S3: warehouse SQL over catalog tables/views."""
    return spark.sql(sql)


def string_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def scan_csv(spark: SparkSession, paths, names=None, schema: T.StructType | None = None, sep: str = ",",
             header: bool = False, encoding: str = "UTF-8", dtypes: dict | None = None,
             columns=None) -> DataFrame:
    """Delimited text with an imposed header.

    ``names`` imposes all-string columns (headerless files), ``dtypes``
    overrides some of them; ``columns`` keeps a subset (pruned at the scan).
    """
    if schema is None and names is not None:
        schema = T.StructType([T.StructField(n, (dtypes or {}).get(n, T.StringType())) for n in names])
    r = spark.read.option("sep", sep).option("header", str(header).lower()).option("encoding", encoding)
    r = r.option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(paths if isinstance(paths, (list, tuple)) else [paths])
    return df.select(*columns) if columns else df


def with_file_name(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Provenance column from the file each row came from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def drop_footer_rows(df: DataFrame, key: str, pattern: str = r"^[0-9]+$") -> DataFrame:
    """S7 by predicate: footer/summary lines are the rows whose key column
    is not an identifier (short footer lines arrive NULL-padded)."""
    return df.filter(F.trim(F.col(key)).rlike(pattern))


def scan_lines(spark: SparkSession, paths, encoding: str = "UTF-8") -> DataFrame:
    """Lines of text files with their number: ``value, source_file, line_no, n_lines``.

    Files are read in splits as usual. A split's rows have consecutive row
    ids, so a row's place in its split is its id less the split's least; the
    number of lines before a split is a running sum over the splits of its
    file. What is summed and joined has one row a split, not one a line.
    """
    read = spark.read.option("encoding", encoding).text(paths if isinstance(paths, (list, tuple)) else [paths])
    lines = read.select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("__at"),
                        F.monotonically_increasing_id().alias("__id"))
    splits = lines.groupBy("source_file", "__at").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("source_file")  # the splits of a file
    before = F.coalesce(F.sum("__n").over(w.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select(F.col("source_file").alias("__f"), F.col("__at").alias("__a"), "__first", before.alias("__before"),
                           F.sum("__n").over(w).alias("n_lines"))
    j = lines.join(splits, (F.col("source_file") == F.col("__f")) & (F.col("__at") == F.col("__a")))
    return j.select("value", "source_file", (F.col("__before") + F.col("__id") - F.col("__first") + 1).alias("line_no"), "n_lines")


def drop_last_lines(lines: DataFrame, n: int = 2) -> DataFrame:
    """S7 by position: the last ``n`` lines of each file go."""
    return lines.filter(F.col("line_no") <= F.col("n_lines") - n)


def parse_lines(lines: DataFrame, names, sep: str = ",") -> DataFrame:
    """The text columns of delimited lines, beside file and line number."""
    row = F.from_csv("value", ", ".join(f"`{n}` string" for n in names), {"sep": sep})
    return lines.select(row.alias("__r"), *[c for c in lines.columns if c != "value"]).select("__r.*", *[c for c in lines.columns if c != "value"])


def scan_drifting(spark: SparkSession, paths, overrides: dict | None = None) -> DataFrame:
    """Parquet snapshots whose columns and types differ, in one reconciled schema, with their file.

    Only schemas reach the driver, one a snapshot.
    """
    frames = [spark.read.parquet(p) for p in paths]
    schema = reconciled([f.schema for f in frames], overrides)
    named = [to_schema(f, schema).withColumn("source_file", F.lit(p.rstrip("/").rsplit("/", 1)[-1])) for p, f in zip(paths, frames)]
    return reduce(lambda a, b: a.unionByName(b), named)


def scan_sheet(spark: SparkSession, path: str, tag: str | None = "sheet") -> DataFrame:
    """``{"columns": [...], "rows": [[...], ...]}`` envelopes -> a table
    of strings. One envelope per line.

    Each envelope's own header places its values; the result has every
    column that any of them names, in order of first place then name, NULL
    where an envelope lacks it. Only header names reach the driver. A sheet
    is one row of the file and so one task (the format's own limit: such
    sheets hold at most some 10 million cells).
    """
    env = spark.read.schema("columns array<string>, rows array<array<string>>, sheet string").json(path)
    heads = env.select(F.posexplode("columns").alias("at", "name")).groupBy("name").agg(F.min("at").alias("at"))
    names = [r["name"] for r in heads.orderBy("at", "name").collect()]
    body = env.select("columns", "sheet", F.explode("rows").alias("__row"))
    cols = [F.get(F.col("__row"), (F.array_position("columns", n) - 1).cast("int")).alias(n) for n in names]
    return body.select(*cols, *([F.col("sheet").alias(tag)] if tag else []))


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> list[str]:
    """Names in a folder matching a glob (driver-side listing: names only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(directory)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if fnmatch.fnmatch(str(s.getPath().getName()), pattern))


def latest_file(spark: SparkSession, directory: str, pattern: str, exclude_prefix: str = "~$") -> str:
    """The file of the newest ``YYYYMM`` in its name (of equals the last
    name), whatever stands before it; lock files excluded; fails when none."""
    names = [n for n in list_files(spark, directory, pattern) if not n.startswith(exclude_prefix)]
    dated = [(max(p), n) for n in names if (p := re.findall(r"(?<!\d)\d{6}(?!\d)", n))]
    if not dated:
        raise FileNotFoundError(f"no dated file matching {pattern} in {directory}")
    return f"{directory.rstrip('/')}/{max(dated)[1]}"


def existing_paths(spark: SparkSession, paths) -> list[str]:
    """Keep the parts that exist (a missing part is skipped)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        if jp.getFileSystem(conf).exists(jp):
            out.append(p)
    return out


def scan_union(spark: SparkSession, paths, skip_missing: bool = True, **csv) -> DataFrame:
    """N same-shape files in one scan, with the file name."""
    ps = existing_paths(spark, paths) if skip_missing else list(paths)
    return with_file_name(scan_csv(spark, ps, **csv))


def inline_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A literal table (small reference data such as a population history)."""
    return spark.createDataFrame(rows, schema)
