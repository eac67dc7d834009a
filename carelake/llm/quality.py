"""Quality rules: base counts and a hashed n-gram log-likelihood ratio with one threshold.

Method
    Word unigrams and bigrams are hashed to ``BUCKETS`` bins. Two multinomials are
    counted: the raw corpus (every document) and the trusted target (about
    ``TRUSTED_SAMPLE``, half at most, of the documents whose ``labels.quality`` is 1). With a Dirichlet
    prior of PRIOR times the target's size in raw-distributed counts, ``llr = mean over n-grams of log p_target - log p_raw``,
    so length does not matter. A rare n-gram, seen or not, stays near 0.
    The threshold is the value between the scores of the other trusted (1) and the rejected (0)
    labelled documents which has the best balanced accuracy over a fixed grid of
    score bins; every document is then held against it.

Scale
    Pass 1 sends at most BUCKETS partial counts a task to a native sum; pass 2
    scores with the broadcast table (BUCKETS doubles, a fixed size) and writes one
    narrow row a document, joined with the labels by id. The sample's ids (a
    bounded list) are broadcast. No text is shuffled.

Defined results
    Null, empty or blank text: no words, all counts 0, ``base_failed`` true. Rows with
    a null id are scored and never labelled. Repeated rows each get their row. No labels
    of either kind, no trusted document besides the target's, or scores that don't separate the labels:
    threshold ``-inf``, so only the base rules reject. Empty table: no rows.
    Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm import base, ftrl

BUCKETS = 1 << 16
PRIOR = 0.1
#: About so many trusted documents (half of them at most), drawn by a hash of the id, make the target multinomial.
TRUSTED_SAMPLE = 50_000
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Score bins in which the threshold is looked for: 1/200 wide, from -10 to 10.
BINS_A_UNIT, BIN_LIMIT = 200, 10
SYMBOLS = "#*$%&|<>"

STATS = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
         ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType())]


@dataclass(frozen=True)
class QualityModel:
    """``weights``: log p_target - log p_raw by bucket; ``part``: share of the trusted ids they were learned from."""
    weights: np.ndarray
    part: float


def _turn(col: str) -> F.Column:
    return F.pmod(F.xxhash64(col), F.lit(1_000_000))


def drawn(col: str, part: float) -> F.Column:
    """Whether an id is in the sample."""
    return _turn(col) < F.lit(part * 1_000_000)


def grams(h: np.ndarray) -> np.ndarray:
    """Buckets of the unigrams and bigrams of a text, from its word hashes."""
    return (np.concatenate([h, base.ngrams(h, 2)]) % np.uint64(BUCKETS)).astype(np.int64)


def repeat_words(h: np.ndarray) -> int:
    """Words that lie in a 3-word window which the text holds twice or more (windows are told apart by 64 bits)."""
    n = len(h)
    if n < 4:
        return 0
    key = base.ngrams(h, 3)
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for i in range(3):
        hit[i:n - 2 + i] |= twice
    return int(hit.sum())


def base_counts(text: str | None, h: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    if not len(h):
        return 0, 0, sum(text.count(c) for c in SYMBOLS) if text else 0, 0, 0
    blank = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line and line.strip(" \t\x0b\x0c\r"):
            seen.add(line)
    return (len(h), len(text) - blank, sum(text.count(c) for c in SYMBOLS), dup,
            repeat_words(h))


def fit_ratio(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> QualityModel:
    """Both multinomials in one scan: each row carries a flag if it is in the trusted sample.

    A draw that takes no trusted document (of a few labels) is replaced by the trusted document of the least hash.
    """
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("l_id")).distinct()
    part = min(0.5, ftrl.share(trusted.count(), TRUSTED_SAMPLE))
    texts = docs.select(F.col(id_col).alias("l_id"), F.col(text_col).alias("l_text"))
    raw, target = _counts(texts, trusted.where(drawn("l_id", part)))
    if not target.sum():
        have = texts.where(F.col("l_text").rlike(base.WORD)).join(trusted.where(~drawn("l_id", part)), "l_id", "left_semi")
        least = have.agg(F.min(_turn("l_id")).alias("t")).first().t
        if least is not None:
            part = (least + 0.5) / 1_000_000
            raw, target = _counts(texts, trusted.where(drawn("l_id", part)))
    p_raw = (raw + 1) / (raw.sum() + BUCKETS)
    if not target.sum():
        return QualityModel(np.zeros(BUCKETS), part)
    prior = PRIOR * target.sum()
    return QualityModel(np.log((target + prior * p_raw) / (target.sum() + prior) / p_raw), part)


def _counts(texts: DataFrame, good: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket is in the texts (l_id, l_text), and in those of the ids in ``good (l_id)``."""
    good = base.stash(good.withColumn("l_good", F.lit(True)), "trusted-ids")
    few = good.count() <= 4 * TRUSTED_SAMPLE  # as the draw gives, whatever its luck
    tagged = texts.join(F.broadcast(good) if few else good, "l_id", "left")

    def run(batches):
        n = np.zeros((2, BUCKETS), np.int64)
        for b, a, z, texts in base.read_texts(batches, 0):
            flags = b.column(1).slice(a, z - a).to_pylist()
            for t, f in zip(texts, flags):
                at = grams(base.word_hashes(base.words(t)))
                np.add.at(n[0], at, 1)
                if f:
                    np.add.at(n[1], at, 1)
        at = np.flatnonzero(n[0])
        yield {"bucket": at, "raw": n[0][at], "target": n[1][at]}

    counts = base.emit(tagged, ["l_text", "l_good"], "bucket long, raw long, target long", run)
    rows = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:  # BUCKETS rows at most
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    return raw, target


def score(docs: DataFrame, model: QualityModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, the base counts and ``llr`` of each row."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)

    def make():
        w = weights.value

        def fn(texts):
            rows = []
            for t in texts:
                h = base.word_hashes(base.words(t))
                rows.append((*base_counts(t, h), float(w[grams(h)].mean()) if len(h) else 0.0))
            return list(zip(*rows))
        return fn

    return base.append_columns(docs, text_col, keep, [*STATS, ("llr", T.DoubleType())], make)


def fit_threshold(scored: DataFrame, labels: DataFrame, model: QualityModel) -> float:
    """The bin edge with the best balanced accuracy between labels 0 and 1 (of equals the middle one); -inf if none separates them.

    Only rows that the base rules pass decide, as only they are held against it, and of the
    trusted ones those that the target was not learned from.
    """
    marks = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marks = marks.where((F.col("quality") == 0) | ~drawn("doc_id", model.part))
    bins = (scored.where(~base_failed()).join(marks, "doc_id")
            .select("quality", F.floor(F.least(F.greatest(F.col("llr"), F.lit(-BIN_LIMIT)), F.lit(BIN_LIMIT))
                                       * BINS_A_UNIT).cast("int").alias("bin"))
            .groupBy("quality", "bin").count().collect())  # bounded by the grid
    n = np.zeros((2, 2 * BIN_LIMIT * BINS_A_UNIT + 2))
    for r in bins:
        n[r.quality, r.bin + BIN_LIMIT * BINS_A_UNIT] += r["count"]
    if not n[0].sum() or not n[1].sum():
        return float("-inf")
    below = np.concatenate([[0], n.cumsum(1)[0]]) / n[0].sum()
    above = 1 - np.concatenate([[0], n.cumsum(1)[1]]) / n[1].sum()
    if (below + above).max() <= 1 + 1e-12:  # no edge is better than none: the scores don't separate the labels
        return float("-inf")
    good = np.flatnonzero(below + above >= (below + above).max() - 1e-12)
    return (int(good[len(good) // 2]) - BIN_LIMIT * BINS_A_UNIT) / BINS_A_UNIT


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def apply_rules(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``keep`` columns (doc_id first), base counts, base_failed, kept, llr."""
    model = fit_ratio(docs, labels)
    scored = base.stash(score(docs, model, ["doc_id"]), "quality")
    threshold = fit_threshold(scored, labels, model)
    out = scored.withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns and nothing else.

    The verdict is computed beside the row, so no join on the id is needed and repeated
    ids are judged by their own text.
    """
    model = fit_ratio(docs, labels)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = score(docs, model, docs.columns).toDF(*names, *[n for n, _ in STATS], "llr")
    rows = base.stash(rows, "quality")  # texts are hashed once for the verdict and its threshold
    threshold = fit_threshold(rows.withColumnRenamed(names[docs.columns.index("doc_id")], "doc_id"), labels, model)
    kept = rows.where(~base_failed() & (F.col("llr") >= F.lit(threshold)))
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "labels"))
    return out.select("doc_id", *[n for n, _ in STATS], "base_failed", "kept", "llr")
