"""Grouping spelling variants by pivotal bigrams.

Method
    Bigram types are ordered by the number of words that hold them, rarest first. A word's prefix is its three first
    bigrams in that order (all places of the third's type included), of which dynamic programming
    chooses two that don't overlap, the pivots, of the least total frequency. If one edit separates two words, the
    one whose prefix ends earlier in the order has a pivot that the edit leaves whole: the other word holds it too,
    and then in its prefix. So pivots are joined with prefixes: an index row for each prefix bigram,
    a probe for each pivot and each length that the other word may have. Position limits: the edit lies on one side of the whole pivot, so
    on its other side both words are the same from the word's end up to the pivot. That side, with the
    pivot, is the join key: a pivot at another place, or after another beginning, isn't met.
    Candidates are verified with a Levenshtein distance of exactly 1.

    Very common keys (more than ``HOT`` words) are split exactly: of what is left of both words, the edit spares
    the first or the last half, which joins the key there.

Scale
    Counting words is one scan with a map-side sum, so a frequent word is one row a task. What follows works on words that
    occur ``MIN_COUNT`` times: about seven index rows and twelve probes each, joined by equality. The
    bigram order has at most 8,100 rows (two of 90 letters), whatever the corpus, and is all that is sent to tasks.
    No group is collected. Forms lead to words at least twice as frequent, so roots are found by doubling jumps in
    a number of rounds that grows with the logarithm of the logarithm of the largest count.

Defined results
    Null, empty and letterless texts have no words. A null id counts as the empty string in the typing-error rule.
    Repeated rows count as often as they occur. No words: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import base

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run whose hash this number divides loses a letter.
SLIP = 97
MIN_LETTERS, MIN_COUNT = 5, 3
#: Index rows of one key beyond which the key is split by halves of the rest.
HOT = 64
#: (extra letters of the other word) that one edit allows.
STEPS = (-1, 0, 1)


def slipped(docs: DataFrame) -> DataFrame:
    """``word``: the runs of all texts, lower-cased, without the letter that the hash rule deletes; short ones left out."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all("text", F.lit(RUN), 0)).alias("run"))
    runs = runs.where(F.length("run") >= MIN_LETTERS).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.select(F.when(h % SLIP == 0, cut).otherwise(F.col("run")).alias("word")).where(
        F.length("word") >= MIN_LETTERS)


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words that occur often enough."""
    return slipped(docs).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def gram_order(words: DataFrame) -> dict[str, int]:
    """Rank of each bigram type by the number of words that hold it, then by itself. At most 90 * 90 types."""
    grams = words.select(F.explode(F.array_distinct(F.expr(
        "transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))"))).alias("gram"))
    rows = grams.groupBy("gram").agg(F.count("*").alias("df")).collect()
    return {r.gram: (k, r.df) for k, r in enumerate(sorted(rows, key=lambda r: (r.df, r.gram)))}


def prefix(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[int], int]:
    """Places of the bigrams up to the type of the third in the order, ascending, and that type's rank."""
    ranks = [order[word[i:i + 2]][0] for i in range(len(word) - 1)]
    last = sorted(ranks)[2]
    return [i for i, r in enumerate(ranks) if r <= last], last


def pivots(word: str, places: list[int], order: dict[str, tuple[int, int]]) -> tuple[int, int]:
    """The two places, not overlapping, of the least total frequency (ties: the earlier ones)."""
    one: tuple | None = None      # the best single bigram that ends before the present one
    waiting: list[tuple] = []     # bigrams that may still overlap the present one
    two: tuple | None = None
    for i in places:
        while waiting and waiting[0][1] <= i - 2:
            head = waiting.pop(0)
            one = head if one is None or head < one else one
        cost = order[word[i:i + 2]][1]
        if one is not None and (two is None or one[0] + cost < two[0]):
            two = (one[0] + cost, one[1], i)
        waiting.append((cost, i))
    return two[1], two[2]


def rest_of(word: str, key: str, side: str) -> str:
    return word[len(key):] if side == "<" else word[:len(word) - len(key)]


def halves(rest: str, other: int) -> list[str]:
    """First and last half of a rest, as it is to be compared with one of length ``other``; one of them is spared by an edit."""
    m = min(len(rest), other)
    return ["a" + rest[:m // 2], "z" + rest[len(rest) - (m - m // 2):]]


def _emit(words: DataFrame, order, probes: bool) -> DataFrame:
    """Rows ``key, size, word, n, last``: of each prefix bigram, or of each pivot and length that the other word may have."""
    sent = base.share(words.sparkSession, order)

    def rows(batches) -> Iterator[dict]:
        ranks = sent()
        for b in batches:
            out: dict[str, list] = {"key": [], "size": [], "word": [], "n": [], "last": []}
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                places, last = prefix(word, ranks)
                for i in pivots(word, places, ranks) if probes else places:
                    for key in ("<" + word[:i + 2], ">" + word[i:]):
                        for step in STEPS if probes else (0,):
                            out["key"].append(key)
                            out["size"].append(len(word) + step)
                            out["word"].append(word)
                            out["n"].append(n)
                            out["last"].append(last)
            yield out

    return base.emit(words, ["word", "n"], "key string, size int, word string, n long, last int", rows)


def _halved(rows: DataFrame, probes: bool) -> DataFrame:
    """The same rows with a half of the rest in the key; an index row has them for each length that the other word may have."""
    def split(batches) -> Iterator[dict]:
        for b in batches:
            out: dict[str, list] = {"key": [], "size": [], "word": [], "n": [], "last": []}
            for key, size, word, n, last in zip(*(b.column(i).to_pylist() for i in range(5))):
                rest = rest_of(word, key[1:], key[0])
                if key[0] == ">":
                    rest = rest[::-1]  # count from the pivot outwards
                for other in ((size,) if probes else tuple(size + s for s in STEPS)):
                    mine, theirs = (len(word), other) if probes else (size, other)
                    lengths = f"{theirs},{mine}" if probes else f"{mine},{theirs}"  # index word, probe word
                    for half in halves(rest, theirs - len(key) + 1):
                        out["key"].append(f"{key}|{lengths}|{half}")
                        out["size"].append(size)
                        out["word"].append(word)
                        out["n"].append(n)
                        out["last"].append(last)
            yield out

    return base.emit(rows, ["key", "size", "word", "n", "last"], "key string, size int, word string, n long, last int", split)


def _met(index: DataFrame, probe: DataFrame) -> DataFrame:
    """Verified pairs ``a, an, b, bn`` of index and probe rows of one key and length."""
    p = probe.select("key", "size", F.col("word").alias("a"), F.col("n").alias("an"), F.col("last").alias("al"))
    i = index.select("key", "size", F.col("word").alias("b"), F.col("n").alias("bn"), F.col("last").alias("bl"))
    return (p.join(i, ["key", "size"]).where("al <= bl and a <> b")
            .where(F.levenshtein("a", "b", 1) == 1).select("a", "an", "b", "bn"))


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """Each two words of one edit, in both directions: ``word, n, near, near_n``."""
    order = gram_order(words)
    index = base.stash(_emit(words, order, False), "grams")
    probe = _emit(words, order, True)
    common = base.stash(index.groupBy("key", "size").count().where(F.col("count") > hot).select("key", "size"), "hot-grams")
    pairs = _met(index.join(common, ["key", "size"], "left_anti"), probe)
    if common.count():
        pairs = pairs.unionAll(_met(_halved(index.join(common, ["key", "size"], "left_semi"), False),
                                    _halved(probe.join(common, ["key", "size"], "left_semi"), True)))
    each = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("near"), F.col("bn").alias("near_n")),
                             F.struct(F.col("b").alias("word"), F.col("bn").alias("n"), F.col("a").alias("near"), F.col("an").alias("near_n"))))
    return pairs.select(each.alias("x")).select("x.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows ``word, form`` (null where none): jumps that double their reach until none moves."""
    now = base.stash(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        up = now.where("root <> word").select(F.col("word").alias("w"), F.col("root").alias("up"))
        new = base.stash(now.join(up, F.col("root") == F.col("w"), "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "roots")
        now = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return now


def variants(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """A row ``word, form, root, n, n_near, form_n`` for each word."""
    words = base.stash(vocabulary(docs), "words")
    # the largest n, then the smallest word: max of (n, -order) has no string form, so min of (-n, word)
    best = near_pairs(words, hot).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    out = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.minus") >= 2 * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.minus") >= 2 * F.col("n"), -F.col("best.minus")).alias("form_n"))
    out = base.stash(out, "forms")
    return out.join(roots(out), "word").select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(base.table(spark, sf_dir, "documents"))
