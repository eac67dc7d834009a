"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Method
    Items are lower-cased (A-Z) and cut into words; all items go into one generalised
    suffix automaton over word numbers. Each training text is streamed through it,
    which gives at every word the longest match that ends there. Where that is at
    least ``WINDOW`` words long, those words are hit; a shorter item counts only as a whole,
    found through the automaton's suffix links. Spans of hit words are then removed by
    a length limit, or the whole document by a coverage limit.

Scale
    The automaton goes to the tasks. Items are cut into
    blocks of at most ``BLOCK_WORDS`` words, one automaton each, so what is broadcast is
    bounded whatever the size of the test set; the documents are streamed once for each
    block and only the hit spans of different blocks are merged, by a key of the text. An automaton
    keeps its states in flat arrays, with a dictionary only for those with several ways on. Texts are not
    shuffled, but when ``clean`` has several blocks and more than ``MOST_HIT`` different texts with hits: then
    these meet their spans in a shuffle join instead of a broadcast one.
    A text is only walked inside runs of words that all occur in the block and are as long as its
    shortest window: a match cannot lie elsewhere.

Defined results
    Null, empty or wordless texts have 0 words, no hits and are not contaminated; null or
    wordless items have no window; repeated items keep their own ids (several ids may be reported
    for one window); an empty item table contaminates nothing. Item ids are compared as strings.
    Null item ids count as items in the hits but have no id to report.
"""

from __future__ import annotations

import itertools
import re
from array import array
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm import base

WINDOW = 13
COVERAGE = 20  # contaminated if hit words * COVERAGE >= words
BLOCK_WORDS = 1_000_000
#: Different texts with hits whose spans are broadcast.
MOST_HIT = 50_000
#: Bytes that are part of a word after lower-casing A-Z: 0-9, a-z and everything beyond ASCII.
_KEEP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

#: The same words in a text whose case is kept.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def match_words(text: str | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; none for null."""
    return [] if text is None else base.utf8(text).lower().translate(_KEEP).split()


class ItemAutomaton:
    """Generalised suffix automaton over the words of the items of one block."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        #: A state's only way on (word, state): -1 for none; -2 for several, which ``ways`` has.
        self.word, self.to = array("i", [-1]), array("i", [-1])
        self.ways: dict[int, dict[int, int]] = {}
        self.link, self.length = array("i", [-1]), array("i", [0])
        self.items: list[str | None] = []
        words_of = []
        for name, ws in items:
            if ws:
                self.items.append(name)
                words_of.append(array("i", [self.vocab.setdefault(w, len(self.vocab)) for w in ws]))
        for seq in words_of:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        #: Least window of any item: shorter runs can't hold a hit.
        self.least = min([window, *map(len, words_of)]) if words_of else 0
        self._mark(words_of)

    def _way(self, s: int, c: int) -> int:
        """The state after word c, -1 if there is none."""
        w = self.word[s]
        if w == c:
            return self.to[s]
        return self.ways[s].get(c, -1) if w == -2 else -1

    def _lead(self, s: int, c: int, t: int) -> None:
        w = self.word[s]
        if w == -2:
            self.ways[s][c] = t
        elif w in (-1, c):
            self.word[s], self.to[s] = c, t
        else:
            self.ways[s] = {w: self.to[s], c: t}
            self.word[s] = -2

    def _extend(self, last: int, c: int) -> int:
        nxt = self._way(last, c)
        if nxt >= 0:
            return nxt if self.length[nxt] == self.length[last] + 1 else self._split(last, c, nxt)
        new = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and self._way(p, c) < 0:
            self._lead(p, c, new)
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self._way(p, c)
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _state(self, length: int) -> int:
        self.word.append(-1)
        self.to.append(-1)
        self.length.append(length)
        self.link.append(0)
        return len(self.word) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.length[p] + 1)
        self.word[clone], self.to[clone] = self.word[q], self.to[q]
        if self.word[q] == -2:
            self.ways[clone] = dict(self.ways[q])
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self._way(p, c) == q:
            self._lead(p, c, clone)
            p = self.link[p]
        return clone

    def _mark(self, words_of: list) -> None:
        """The windows (size, item) that are suffixes of a state's strings, own class only, stand in ``size`` and ``item`` from
        ``first[state]`` on; ``up``: the nearest state on the suffix chain, the state included, that has any."""
        state, size, item = array("i"), array("i"), array("i")
        for k, seq in enumerate(words_of):
            least = min(self.window, len(seq))
            s = n = 0
            for c in seq:
                s, n = self._next(s, n, c)
                while self.length[self.link[s]] >= least and s:
                    s = self.link[s]
                    n = self.length[s]
                if n >= least:
                    state.append(s)
                    size.append(least)
                    item.append(k)
        found = np.unique(np.stack([np.frombuffer(x, np.int32) for x in (state, size, item)]), axis=1) if state else np.zeros((3, 0), np.int32)
        count = np.bincount(found[0], minlength=len(self.word)).astype(np.int32)
        self.first = array("i", np.concatenate([[0], np.cumsum(count)]).astype(np.int32).tobytes())
        self.size, self.item = array("i", found[1].tobytes()), array("i", found[2].tobytes())
        length, link = np.frombuffer(self.length, np.int32), np.frombuffer(self.link, np.int32)
        up = np.where(count > 0, np.arange(len(count), dtype=np.int32), np.int32(-1))
        order = np.argsort(length, kind="stable")
        for s in order[count[order] == 0].tolist():  # a link is shorter than its state, so it is done before
            if s:
                up[s] = up[link[s]]
        self.up = array("i", up.tobytes())

    def _next(self, s: int, n: int, c: int) -> tuple[int, int]:
        """State and length of the longest match after reading c."""
        t = self._way(s, c)
        while s and t < 0:
            s = self.link[s]
            n = self.length[s]
            t = self._way(s, c)
        return (t, n + 1) if t >= 0 else (0, 0)

    def longest(self, ws: list[bytes]) -> list[int]:
        """Length of the longest match that ends at each word."""
        out, s, n = [], 0, 0
        for w in ws:
            c = self.vocab.get(w, -3)
            s, n = self._next(s, n, c)
            out.append(n)
        return out

    def hits(self, ws: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Merged [from, to) spans of hit words, and the numbers of the items with a window there."""
        if not self.least or len(ws) < self.least:
            return [], set()
        get = self.vocab.get
        ids = [get(w, -1) for w in ws]
        known = np.fromiter(ids, np.int64, len(ids)) >= 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        spans: list[list[int]] = []
        items: set[int] = set()
        for a, z in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if z - a < self.least:
                continue
            s = n = 0
            for i in range(a, z):
                s, n = self._next(s, n, ids[i])
                u = self.up[s]
                longest = 0
                while u >= 0:
                    for k in range(self.first[u], self.first[u + 1]):
                        size = self.size[k]
                        if size <= n:
                            items.add(self.item[k])
                            longest = max(longest, size)
                    u = self.up[self.link[u]] if u else -1
                if longest:
                    start = i + 1 - longest
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append([start, i + 1])
        return spans, items


def blocks(items: DataFrame, block_words: int = BLOCK_WORDS, id_col: str = "item_id",
           text_col: str = "text") -> Iterable[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of at most ``block_words`` words (one item at least), streamed to the driver a partition at a time."""
    now: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for r in items.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator():
        ws = match_words(r[1])
        if now and size + len(ws) > block_words:
            yield now
            now, size = [], 0
        if ws:
            now.append((r[0], ws))
            size += len(ws)
    if now:
        yield now


FIELDS = [("n_words", T.LongType()), ("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
          ("item_ids", T.ArrayType(T.StringType())), ("n_items", T.LongType())]


def _scan(docs: DataFrame, auto: ItemAutomaton, keep: list[str], text_col: str,
          cut_from: int | None = None) -> DataFrame:
    shared = base.share(docs.sparkSession, auto)
    fields = FIELDS if cut_from is None else [*FIELDS, ("cut", T.StringType())]

    def make():
        a = shared()

        def fn(texts):
            rows = []
            for t in texts:
                ws = match_words(t)
                spans, ks = a.hits(ws)
                row = (len(ws), spans, sorted(a.items[k] for k in ks if a.items[k] is not None), len(ks))
                rows.append(row if cut_from is None else (*row, cut(t, spans, cut_from)))
            return list(zip(*rows))
        return fn

    return base.append_columns(docs, text_col, keep, fields, make)


def find_hits(docs: DataFrame, items: DataFrame, keep: list[str], window: int = WINDOW, text_col: str = "text",
              block_words: int = BLOCK_WORDS, cut_from: int | None = None) -> DataFrame:
    """``keep`` columns and n_words, ``spans`` ([from, to) word ranges), ``item_ids`` (sorted strings), ``n_items``.

    With ``cut_from`` also ``cut``: the text without the spans of at least so many words (null: unchanged).
    """
    it = iter(blocks(items, block_words))
    first, second = next(it, []), next(it, None)
    if second is None:
        return _scan(docs, ItemAutomaton(first, window), keep, text_col, cut_from)
    marks = ["llm t1", "llm t2"]  # hits are a matter of the text alone
    t = F.col(base._q(text_col))
    docs = docs.withColumns({marks[0]: F.xxhash64(t, F.lit(1)), marks[1]: F.xxhash64(F.lit(2), t)})
    parts = None
    for block in itertools.chain([first, second], it):
        part = _scan(docs, ItemAutomaton(block, window), marks, text_col).where("n_items > 0").dropDuplicates(marks)
        part = base.stash(part.select(*marks, "spans", "item_ids", "n_items"), "hits")
        parts = part if parts is None else parts.unionAll(part)
    found = base.stash(parts.groupBy(*marks).agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans2"),  # a row a block
        F.array_sort(F.flatten(F.collect_list("item_ids"))).alias("items2"), F.sum("n_items").alias("n2")), "all-hits")
    side = F.broadcast(found) if found.count() <= MOST_HIT else found
    held = [*keep, *marks] + ([text_col] if cut_from is not None else [])
    out = _scan(docs, ItemAutomaton([], window), held, text_col)  # counts the words
    names = [f"k{i}" for i in range(len(keep))]
    out = out.toDF(*names, *marks, *(["llm text"] if cut_from is not None else []), *[f for f, _ in FIELDS]).join(side, marks, "left")
    cols = [F.col(k).alias(c) for k, c in zip(names, keep)] + [
        "n_words", F.coalesce("spans2", "spans").alias("spans"), F.coalesce("items2", "item_ids").alias("item_ids"),
        F.coalesce("n2", "n_items").alias("n_items")]
    if cut_from is None:
        return out.select(*cols)

    @F.pandas_udf("string")
    def cutter(texts, spans):
        import pandas as pd
        return pd.Series([cut(t, merge([list(x) for x in s]), cut_from) if s is not None and len(s) else None
                          for t, s in zip(texts, spans)], dtype=object)

    return out.select(*cols, cutter("llm text", "spans2").alias("cut"))


def cut(text: str | None, spans: list[list[int]], least: int) -> str | None:
    """The text without the words (and what stands between them) of spans of ``least`` words or more; null if none."""
    spans = [x for x in spans if x[1] - x[0] >= least]
    if not spans:
        return None
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for a, z in spans:
        out.append(text[last:at[a][0]])
        last = at[z - 1][1]
    return "".join([*out, text[last:]])


def merge(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(z, out[-1][1])
        else:
            out.append([a, z])
    return out


def n_hit() -> F.Column:
    """Different words in the spans (those of several blocks may overlap)."""
    each = F.transform("spans", lambda x: F.sequence(x[0], x[1] - 1))
    return F.size(F.array_distinct(F.flatten(each))).cast("long")


def contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (COVERAGE * F.col("n_hit") >= F.col("n_words"))


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    out = find_hits(docs, items, ["doc_id"], **options).withColumn("n_hit", n_hit())
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                      contaminated().alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, cut_from: int = WINDOW, **options) -> DataFrame:
    """``docs`` without contaminated documents; in the others, spans of ``cut_from`` hit words or more are removed.

    ``n_chars``, where there is such a column, follows the text.
    """
    cols = docs.columns
    out = find_hits(docs, items, cols, cut_from=cut_from, **options)
    out = out.toDF(*[f"c{i}" for i in range(len(cols))], *[f for f, _ in FIELDS], "cut")
    out = out.withColumn("n_hit", n_hit()).where(~contaminated())
    text = f"c{cols.index('text')}"

    def value(i: int, c: str) -> F.Column:
        if c == "text":
            return F.coalesce("cut", text)
        if c == "n_chars":
            return F.when(F.col("cut").isNotNull(), F.length("cut").cast(docs.schema[i].dataType)).otherwise(F.col(f"c{i}"))
        return F.col(f"c{i}")

    return out.select(*[value(i, c).alias(c) for i, c in enumerate(cols)])


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "benchmark"))
