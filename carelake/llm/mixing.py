"""Mixing sources to target weights by weighted fair queueing.

Method
    Each source's documents are put in a shuffled order (by a hash of the id) and offered up to
    ``EPOCHS`` times. A copy's virtual finish time is the cumulative number of its source's words up to its
    end, divided by the source's target. All copies are ordered by that time and cut
    where their cumulative words pass the total budget; since every source reaches
    time 1 at its target, the cut takes each near it.
    Targets: the budget is shared by weight; a target stops at EPOCHS times its source, and
    the excess is reshared by weight until none is above.

Scale
    One scan of the texts makes a narrow table (id, source, size, hash); everything else works on that.
    Cumulative sums are taken in hash buckets of about ``BUCKET_ROWS`` rows, whose offsets come from the
    bucket sums, so a hot source is spread over many tasks. The cut is found by
    zooming: 1,000 bins of finish time are summed at a time, until the bin that holds the cut has
    few rows. The driver gets one row per source (the mix's configuration) and those sums.

Defined results
    Null or blank text has size 0 and takes nothing. Null source is a source of its own, the last in
    order. Rows with a null id are shuffled by their text. Repeated rows are documents of their own. An empty table gives no rows.
    More than ``MOST_SOURCES`` sources are an error: each has a weight, a target and a row on the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm import base

WEIGHTS = (3, 1, 2)
BUDGET_NUM, BUDGET_DEN = 3, 2
EPOCHS = 2
BUCKET_ROWS = 4_000
MOST_SOURCES = 100_000
ZOOM_BINS, LAST_ROWS = 1000, 20_000


def shuffle_hash(col: str) -> F.Column:
    """60 bits of the MD5 of the id; of the text (of the empty one for null) where the id is null."""
    key = F.coalesce(F.col(col).cast("string"), F.concat(F.lit("text:"), F.coalesce("text", F.lit(""))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def size_of(text_col: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(base.WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple = WEIGHTS) -> dict[str | None, tuple[int, float]]:
    """Rank and target of each source: water-filling of the budget under the caps."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget = BUDGET_NUM * sum(sizes.values()) / BUDGET_DEN
    capped: set = set()
    while True:
        rest = [s for s in order if s not in capped]
        level = (budget - sum(EPOCHS * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if EPOCHS * sizes[s] < level * weight[s]]
        if not over:
            break
        capped.update(over)
    return {s: (i, float(EPOCHS * sizes[s]) if s in capped else level * weight[s]) for i, s in enumerate(order)}


def marks() -> list[F.Column]:
    """Two independent 64-bit hashes of a row: together its key, never null."""
    return [F.xxhash64("doc_id", "source", "text", F.lit(1)).alias("mark"),
            F.xxhash64(F.lit(2), "text", "source", "doc_id").alias("mark2")]


def finish_times(docs: DataFrame, weights: tuple = WEIGHTS) -> tuple[DataFrame, int]:
    """Rows ``doc_id, mark, mark2, size, h, si, source_size, target, done`` (words of the source up to the row's end) and the budget."""
    spark = docs.sparkSession
    narrow = base.stash(docs.select("doc_id", "source", size_of().alias("size"), shuffle_hash("doc_id").alias("h"),
                                    *marks()), "sizes")
    rows = narrow.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    plan = targets({r.source: r["size"] for r in rows}, weights)
    table = [(r.source, *plan[r.source], r["size"], max(1, math.ceil(r.n / BUCKET_ROWS))) for r in rows]
    kind = narrow.schema["source"].dataType.simpleString()
    by = spark.createDataFrame(table, f"s {kind}, si int, target double, source_size long, nb long")
    x = narrow.join(by, F.col("source").eqNullSafe(F.col("s")), "left").withColumn(
        "bucket", F.shiftright(F.shiftright("h", 30) * F.col("nb"), 30))
    sums = x.groupBy("si", "bucket").agg(F.sum("size").alias("b"))
    before = F.sum("b").over(Window.partitionBy("si").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("si", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum("size").over(Window.partitionBy("si", "bucket").orderBy("h", "doc_id", "size", "mark")
                                .rowsBetween(Window.unboundedPreceding, 0))
    out = x.withColumn("inside", inside).join(sums, ["si", "bucket"])
    out = out.select("doc_id", "mark", "mark2", "size", "h", "si", "source_size", "target",
                     (F.col("before") + F.col("inside")).alias("done"))
    budget = BUDGET_NUM * sum(r["size"] for r in rows) // BUDGET_DEN
    return base.stash(out, "finish"), budget


def finish(epoch: int) -> F.Column:
    return (F.lit(epoch) * F.col("source_size") + F.col("done")).cast("double") / F.col("target")


def copies(times: DataFrame) -> DataFrame:
    """A row ``v, si, h, doc_id, size, mark, epoch, mark2`` for each copy on offer that has words."""
    each = F.explode(F.array(*[F.struct(finish(e).alias("v"), F.lit(e).alias("epoch")) for e in range(EPOCHS)]))
    return times.where("size > 0").select("si", "h", "doc_id", "size", "mark", "mark2", each.alias("x")).select(
        "x.v", "si", "h", "doc_id", "size", "mark", "x.epoch", "mark2")


ORDER = ["v", "si", "h", "doc_id", "size", "mark", "epoch"]


def find_cut(offered: DataFrame, budget: int) -> tuple | None:
    """The first copy, in order, whose cumulative words pass the budget; null if none does."""
    low, high, left = 0.0, None, budget
    high = offered.agg(F.max("v")).first()[0]
    if high is None:
        return None
    while True:
        part = offered.where((F.col("v") > low) & (F.col("v") <= high))
        wide = (high - low) / ZOOM_BINS
        bins = (part.groupBy(F.least(F.floor((F.col("v") - low) / wide), F.lit(ZOOM_BINS - 1)).alias("bin"))
                .agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("z"))
                .orderBy("bin").collect())  # ZOOM_BINS rows at most
        hit = None
        for r in bins:
            if r["size"] > left:
                hit = r
                break
            left -= r["size"]
        if hit is None:
            return None
        part = part.where((F.col("v") >= hit.a) & (F.col("v") <= hit.z))
        if hit.n <= LAST_ROWS or hit.a == hit.z:
            break
        low, high = math.nextafter(hit.a, 0.0), hit.z
    for r in part.orderBy(*[F.asc_nulls_first(c) for c in ORDER]).toLocalIterator():
        if r["size"] > left:
            return tuple(r[c] for c in ORDER)
        left -= r["size"]
    return None


def before_cut(cut: tuple | None, cols: dict[str, F.Column]) -> F.Column:
    """Whether a copy comes before the cut, column by column (nulls first)."""
    if cut is None:
        return F.lit(True)
    out = F.lit(False)
    for c, x in zip(reversed(ORDER), reversed(cut)):
        col = cols[c]
        less = F.lit(False) if x is None else (col.isNull() | (col < F.lit(x)))
        out = F.coalesce(less, F.lit(False)) | (col.eqNullSafe(F.lit(x)) & out)
    return out


def taken(docs: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    times, budget = finish_times(docs, weights)
    cut = find_cut(copies(times), budget)
    cols = {c: F.col(c) for c in ("si", "h", "doc_id", "size", "mark")}
    n = sum((F.when(F.col("size") > 0, before_cut(cut, {**cols, "v": finish(e), "epoch": F.lit(e)}).cast("long"))
             .otherwise(0) for e in range(EPOCHS)), F.lit(0))
    return times.select("doc_id", "size", "source_size", "target", (F.col("size") * n).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """``docs``' rows, each as often as the mix takes it, range-sorted by virtual finish time.

    Texts are shuffled twice: by row key to meet their copies, and by finish time.
    """
    times, budget = finish_times(docs, weights)
    offered = copies(times)
    kept = offered.where(before_cut(find_cut(offered, budget), {c: F.col(c) for c in ORDER}))
    keys = ["llm k1", "llm k2"]  # one key for both: repeated rows meet the list of all their copies once
    kept = kept.groupBy(F.col("mark").alias(keys[0]), F.col("mark2").alias(keys[1])).agg(F.collect_list("v").alias("llm v"))
    row = docs.withColumns(dict(zip(keys, marks()))).dropDuplicates(keys)
    out = row.join(kept, keys)
    out = out.select(*[F.col(base._q(c)) for c in docs.columns], F.explode("llm v").alias("llm v"))
    # finish times are unique but for ties between sources; the range sort spreads copies of one document
    return out.repartitionByRange(F.col("llm v")).sortWithinPartitions("llm v", "doc_id").drop("llm v")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(base.table(spark, sf_dir, "documents"))


ORACLE = r"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'text:' || coalesce(text, ''))), 1, 15) as bigint) as h
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size,
         row_number() over (order by source nulls last) - 1 as si from d group by source),
w as (select *, case si % 3 when 0 then 3 when 1 then 1 else 2 end as weight from s),
c as (
  select *, sum(source_size) over () * 3 / 2.0 as budget,
         row_number() over (order by cast(2 * source_size as double) / weight, si) as k from w),
l as (
  select a.k as k, (any_value(a.budget) - coalesce(sum(2 * b.source_size) filter (b.k < a.k), 0))
         / sum(b.weight) filter (b.k >= a.k) as level
  from c a cross join c b group by a.k),
cap as (
  select min(c.k) as first_free from c join l on c.k = l.k where not 2 * c.source_size < l.level * c.weight),
lev as (select level from l, cap where l.k = cap.first_free),
t as (
  select source, source_size, si, budget,
         case when k < first_free then cast(2 * source_size as double) else level * weight end as target
  from c, cap, lev),
f as (
  select d.doc_id, d.size, d.h, t.si, t.source_size, t.target, t.budget,
         sum(d.size) over (partition by t.si order by d.h, d.doc_id nulls first, d.size rows unbounded preceding) as done
  from d join t on d.source is not distinct from t.source),
e as (
  select doc_id, size, h, si, budget, p.epoch, cast(p.epoch * source_size + done as double) / target as v
  from f, (values (0), (1)) p(epoch) where size > 0),
g as (
  select *, sum(size) over (order by v, si, h, doc_id nulls first, size, epoch rows unbounded preceding) as total from e),
n as (select doc_id, size, h, si, count(*) as n from g where total <= floor(budget) group by all)
select f.doc_id, f.size, f.source_size, f.target, cast(f.size * coalesce(n.n, 0) as bigint) as taken
from f left join n on f.doc_id is not distinct from n.doc_id and f.si = n.si and f.size = n.size
"""
