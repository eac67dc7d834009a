"""Connected components by alternating large-star and small-star steps; nothing is collected but two sums a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import base


def components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """``node, comp`` for every node of ``edges (u, v)``; ``comp`` is the least node it is connected with.

    Each step is a groupBy (with map-side minimum) and a join whose one side has a row per
    node, so a node with very many neighbours is split by the skew join. Rounds grow with
    the logarithm of the longest path. Null ends and loops are ignored.
    """
    e = base.stash(edges.where("u is not null and v is not null and u <> v")
                   .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), tag)
    state = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
            .where("u <> v").distinct())
        e = base.stash(small, tag)
        now = e.agg(F.count("*"), F.sum("v"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
