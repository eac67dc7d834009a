"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Method
    Letters are lower-cased, all else is one space; character 1-, 2- and 3-grams are hashed to
    ``DIMS`` features with value SCALE * (share of the text's n-grams) * idf. Weights are
    trained by FTRL with elastic-net penalties (most become 0), then one temperature is
    fitted on held-back rows of the sample so that scores are probabilities.

Scale
    Document frequencies are counted over all rows that may be learned from (at most DIMS
    partial counts a task, summed natively). The classifier is fitted on a sample of about
    ``SAMPLE_PER_LANG`` rows of each language, drawn by a hash of the row. Beyond ``BLOCK_LANGS`` languages
    they are learned in blocks, most frequent first, each with a class for rows of the other blocks (a sample of
    ``OTHER_ROWS``); a text takes the language of the highest probability over all blocks. Every whole text is scored in
    one pass a block with a broadcast table of fixed size, written between blocks so that one table is held at a time.

Defined results
    Null text, or one without a letter: ``und`` with score 0. Nothing to learn from: ``und``, 0 for all. One
    language only: that one, score 1. Rows with a null lang or id are scored but not learned from; a
    null id is not held out. Repeated rows count as often as they come. Equal probabilities: the first language
    by block, then by name. More than ``MAX_LANGS`` lang values are an error, as that is no list of languages. Other
    columns, those named like a result's included, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm import base, ftrl

ORDERS = (1, 2, 3)
DIMS = 1 << 16
SCALE = 100.0
SAMPLE_PER_LANG, BLOCK_LANGS, OTHER_ROWS = 2500, 200, 10_000
MAX_LANGS = 10_000
PASSES, ALPHA, L1, L2 = 2, 0.2, 0.02, 1e-4
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"


def letters() -> np.ndarray:
    """Bits of the code points that are letters."""
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def grams(text: str | None, letter: np.ndarray) -> np.ndarray:
    """Hashed n-grams of a text, with repeats; none if it has no letter."""
    if not text:
        return np.empty(0, np.int64)
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letter[cp]
    if not is_letter.any():
        return np.empty(0, np.int64)
    cp = np.where(is_letter, cp, np.uint32(32))
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    cp = np.concatenate([np.array([32], np.uint32), cp[keep]])
    out, h = [], np.zeros(len(cp), np.uint32)
    for n in ORDERS:
        if n > len(cp):
            break
        h = (h[:len(cp) - n + 1] + cp[n - 1:] + np.uint32(n)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0x85EBCA6B)) >> np.uint32(16))
    return np.concatenate(out).astype(np.int64)


@dataclass(frozen=True)
class LangModel:
    langs: tuple[str, ...]
    table: np.ndarray  # SCALE * idf * weight, by feature and language
    bias: np.ndarray
    temperature: float
    more: tuple["LangModel", ...] = ()  # further blocks of languages; then the last class of each is "another block's"

    def best(self, at: np.ndarray) -> tuple[str, float]:
        """The likeliest language of this block and its probability."""
        p = ftrl.softmax(self.logits(at) / self.temperature)
        best = int(p[:len(self.langs)].argmax())
        return self.langs[best], float(p[best])

    def logits(self, at: np.ndarray) -> np.ndarray:
        return self.table.take(at, axis=0).mean(axis=0, dtype=np.float64) + self.bias


def doc_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each feature is, and how many texts have any; over all rows."""
    shared = docs.sparkSession.sparkContext.broadcast(letters())

    def run(batches):
        letter = np.unpackbits(shared.value).astype(bool)
        n, last, total = np.zeros(DIMS, np.int64), np.full(DIMS, -1, np.int64), 0
        for _, _, _, texts in base.read_texts(batches, 0):
            for t in texts:
                at = grams(t, letter)
                if len(at):
                    place = np.arange(len(at))
                    last[at] = place
                    n[at[last[at] == place]] += 1  # each feature once: where its last place was written
                    total += 1
        i = np.flatnonzero(n)
        yield {"i": np.append(i, -1), "n": np.append(n[i], total)}

    rows = base.emit(docs, [text_col], "i long, n long", run).groupBy("i").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(DIMS), 0
    for r in rows:  # DIMS + 1 rows at most
        if r.i < 0:
            total = r.n
        else:
            df[r.i] = r.n
    return df, total


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
        width: int = BLOCK_LANGS) -> LangModel | None:
    """Learns from rows outside of the held-out fold that have a language; ``width`` languages at a time."""
    spark = docs.sparkSession
    mine = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where(F.col("lang").isNotNull() & (base.fold("id", FOLDS) >= 0) & (base.fold("id", FOLDS) != HELD_OUT)))
    counts = mine.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS + 1).collect()
    if not counts:
        return None
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} values in {lang_col}")
    df, total = doc_frequencies(mine)
    idf = np.log((1 + total) / (1 + df)) + 1
    shared = spark.sparkContext.broadcast((letters(), idf))
    blocks = [_fit_block(mine, counts[a:a + width], counts[:a] + counts[a + width:], shared, idf)
              for a in range(0, len(counts), width)]
    return replace(blocks[0], more=tuple(blocks[1:]))


def _fit_block(mine: DataFrame, counts: list, others: list, shared, idf: np.ndarray) -> LangModel:
    """A model of the languages of ``counts``, with one class more for a sample of the ``others``, if any."""
    langs = tuple(sorted(r.lang for r in counts))
    rest = ftrl.share(sum(r["count"] for r in others), OTHER_ROWS)
    table = [(r.lang, langs.index(r.lang), ftrl.share(r["count"], SAMPLE_PER_LANG)) for r in counts]
    table += [(r.lang, len(langs), rest) for r in others]
    shares = mine.sparkSession.createDataFrame(table, "lang string, label int, share double")
    drawn = (mine.join(F.broadcast(shares), "lang").withColumn("turn", F.xxhash64("id", "text", F.lit(1)))
             .where(F.pmod(F.col("turn"), F.lit(1_000_000)) < F.col("share") * 1_000_000))
    drawn = drawn.withColumn("shard", F.pmod(F.xxhash64("turn"), F.lit(ftrl.SHARDS + 2)).cast("int"))

    def run(batches):
        bits, weight = shared.value
        letter = np.unpackbits(bits).astype(bool)
        for b, a, z, texts in base.read_texts(batches, 0):
            at, x = [], []
            for t in texts:
                g, c = np.unique(grams(t, letter), return_counts=True)
                at.append(g.astype(np.int32))
                x.append((SCALE * c / max(1, c.sum()) * weight[g]).astype(np.float32))
            yield {**{n: b.column(i + 1).slice(a, z - a) for i, n in enumerate(("shard", "turn", "label"))},
                   "at": at, "x": x}

    sample = base.stash(base.emit(drawn, ["text", "shard", "turn", "label"],
                                  "shard int, turn long, label int, at array<int>, x array<float>", run)
                        .where(F.size("at") > 0), "lang-sample")
    classes = len(langs) + bool(others)
    w = ftrl.train(sample.where(F.col("shard") < ftrl.SHARDS), DIMS, classes, PASSES, alpha=ALPHA, l1=L1, l2=L2)
    held = sample.where(F.col("shard") >= ftrl.SHARDS).orderBy("turn").select("label", "at", "x").toLocalIterator()
    logits, labels = [], []
    for r in held:  # a fifth of the bounded sample
        logits.append(np.asarray(r.x) @ w[np.asarray(r.at)] + w[-1])
        labels.append(r.label)
    t = ftrl.temperature(np.array(logits).reshape(len(labels), classes), np.array(labels, int))
    return LangModel(langs, (SCALE * idf[:, None] * w[:-1]).astype(np.float32), w[-1], t)


def predict(docs: DataFrame, model: LangModel | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred and score."""
    if model is None or not model.more:
        return _predict_block(docs, model, keep, text_col)
    # positions instead of names, so that clashing names do no harm: kept columns, the text, the best so far
    held = [f"k{i}" for i in range(len(keep))]
    out = docs.select(*[F.col(base._q(c)).alias(k) for c, k in zip(keep, held)], F.col(base._q(text_col)).alias("t"))
    for i, block in enumerate([replace(model, more=()), *model.more]):
        best = held + ["t"] + (["name", "p"] if i else [])
        out = _predict_block(out, block, best, "t")
        if i:
            new = F.col("score") > F.col("p")
            out = out.select(*held, "t", F.when(new, F.col("lang_pred")).otherwise(F.col("name")).alias("name"),
                             F.when(new, F.col("score")).otherwise(F.col("p")).alias("p"))
        else:
            out = out.select(*held, "t", F.col("lang_pred").alias("name"), F.col("score").alias("p"))
        if i < len(model.more):
            out = base.stash(out, "lang-best")
    return out.select(*[F.col(k).alias(c) for k, c in zip(held, keep)], F.col("name").alias("lang_pred"), F.col("p").alias("score"))


def _predict_block(docs: DataFrame, model: LangModel | None, keep: list[str], text_col: str) -> DataFrame:
    shared = base.share(docs.sparkSession, (letters(), model))

    def make():
        bits, m = shared()
        letter = np.unpackbits(bits).astype(bool)

        def fn(texts):
            names, scores = [], []
            for t in texts:
                at = grams(t, letter)
                name, p = (UNKNOWN, 0.0) if m is None or not len(at) else m.best(at)
                names.append(name)
                scores.append(p)
            return [names, scores]
        return fn

    return base.append_columns(docs, text_col, keep, [("lang_pred", T.StringType()), ("score", T.DoubleType())], make)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    out = predict(docs, fit(docs), ["doc_id"])
    return out.select("doc_id", (base.fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
