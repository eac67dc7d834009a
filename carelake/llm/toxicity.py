"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Method
    Words (letters and digits, lower-cased), bigrams and pairs one word apart are hashed to ``DIMS``
    features, each present or not. FTRL with per-coordinate rates and an L1 penalty leaves
    few weights that are not 0; only those are broadcast.

Scale
    The classifier is fitted, in one task, on about ``SAMPLE_PER_CLASS`` labelled rows of each class, drawn by a hash of
    the id among all labelled rows outside of the held-out fold; their ids (a list whose length is checked) are
    broadcast to the documents, so no text is shuffled. A document that comes several times is one row of the sample (the
    text of the least hash), and a row gives at most ``SAMPLE_FEATURES`` features to learn from, those of the least
    hash: so the task's input is bounded in bytes too. Every whole text is scored, with all its features, in one pass.

Defined results
    Null, empty and wordless texts get the bias's score. Rows with a null id are scored and never learned
    from, and not held out. A document with several labels is toxic if any says so. Without labels of
    both classes, or if the sample has documents of one class only (labels of documents that aren't in the table), the
    score of all is the share of toxic labels (0 if there are none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm import base, ftrl

DIMS = 1 << 20
SAMPLE_PER_CLASS, SAMPLE_FEATURES = 5_000, 12_000
PASSES, ALPHA, L1, L2 = 4, 1.0, 10.0, 0.01
FOLDS, HELD_OUT = 5, 0
_KEEP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def features(text: str | None) -> np.ndarray:
    """Different features of a text, in order."""
    if not text:
        return np.empty(0, np.int64)
    h = base.word_hashes(base.utf8(text.lower()).translate(_KEEP).split())
    h = np.concatenate([h, base.ngrams(h, 2), base.ngrams(h, 2, gap=2)])
    return np.unique((h >> np.uint64(44)).astype(np.int64))


@dataclass(frozen=True)
class ToxicModel:
    """The weights that are not 0, and the bias."""
    at: np.ndarray
    weight: np.ndarray
    bias: float


def few(at: np.ndarray) -> np.ndarray:
    """At most SAMPLE_FEATURES of a text's features, those of the least hash, in order."""
    if len(at) > SAMPLE_FEATURES:
        at = np.sort(at[np.argsort(base.mix(at.astype(np.uint64)), kind="stable")[:SAMPLE_FEATURES]])
    return at.astype(np.int32)


def _share_only(n: dict[int, int]) -> ToxicModel:
    """Nothing to tell the classes by: the share of toxic labels."""
    rate = min(max(n.get(1, 0) / max(1, sum(n.values())), 1e-6), 1 - 1e-6)
    return ToxicModel(np.empty(0, np.int64), np.empty(0), float(np.log(rate / (1 - rate))))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    spark = docs.sparkSession
    marks = (labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
             .where(base.fold("doc_id", FOLDS) != HELD_OUT))
    n = {r.label: r["count"] for r in marks.groupBy("label").count().collect()}
    if len(n) < 2:
        return _share_only(n)
    part = F.when(F.col("label") == 1, ftrl.share(n[1], SAMPLE_PER_CLASS)).otherwise(ftrl.share(n[0], SAMPLE_PER_CLASS))
    drawn = base.stash(marks.withColumn("turn", F.xxhash64("doc_id", F.lit(9)))
                       .where(F.pmod(F.col("turn"), F.lit(1_000_000)) < part * 1_000_000), "toxic-ids")
    side = F.broadcast(drawn) if drawn.count() <= 4 * SAMPLE_PER_CLASS else drawn
    rows = docs.select("doc_id", "text").join(side, "doc_id")

    def run(batches):
        for b, a, z, texts in base.read_texts(batches, 0):
            yield {"turn": b.column(1).slice(a, z - a), "label": b.column(2).slice(a, z - a), "at": [few(features(t)) for t in texts]}

    found = base.emit(rows, ["text", "turn", "label"], "turn long, label int, at array<int>", run)
    once = found.groupBy("turn", "label").agg(F.min_by("at", F.xxhash64("at")).alias("at")).withColumn("shard", F.lit(0))
    sample = base.stash(once, "toxic-sample")
    if sample.select("label").distinct().count() < 2:
        return _share_only(n)
    w = ftrl.train(sample, DIMS, 1, PASSES, alpha=ALPHA, l1=L1, l2=L2)[:, 0]
    # the sample holds the classes in other shares than the labels do
    shift = np.log(ftrl.share(n[0], SAMPLE_PER_CLASS) / ftrl.share(n[1], SAMPLE_PER_CLASS))
    at = np.flatnonzero(w[:-1])
    return ToxicModel(at, w[at], float(w[-1] + shift))


def score(docs: DataFrame, model: ToxicModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``score``."""
    shared = base.share(docs.sparkSession, model)

    def make():
        m = shared()
        w = np.zeros(DIMS)
        w[m.at] = m.weight

        def fn(texts):
            z = np.array([w[features(t)].sum() + m.bias for t in texts])
            return [1 / (1 + np.exp(-np.clip(z, -500, 500)))]
        return fn

    return base.append_columns(docs, text_col, keep, [("score", T.DoubleType())], make)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, base.table(spark, sf_dir, "labels")), ["doc_id"])
    return out.select("doc_id", (base.fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
