"""Token counts of texts under a unigram vocabulary, by dynamic programming shared along a trie.

Method
    Texts are cut into pre-tokens (runs without white space, with a leading word mark). Each
    task walks the trie of its batches' distinct pre-tokens. The unigram forward score of a
    prefix (the best score of any segmentation into pieces, and of equals the fewest pieces)
    is computed once and serves all pre-tokens that start with it; at a terminal the number of pieces is
    stored. Characters without a piece count one token for each UTF-8 byte.
    Piece scores: the vocabulary is public and never trained; its file orders pieces by rank,
    and a piece's log-probability is that of Zipf's law, -log(rank + 10).

Scale
    No shuffle: rows are counted where they are read. A task remembers the counts of at most ``MOST_KNOWN``
    pre-tokens and forgets all beyond that, so memory is bounded and counts are the same.

Defined results
    Null, empty and blank texts: 0 pre-tokens, 0 tokens. Very long pre-tokens take time in
    proportion to their length and are not remembered beyond ``KEPT_CHARS`` characters. Repeated rows
    each get their row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from carelake.llm import base

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MOST_KNOWN = 400_000
KEPT_CHARS = 64
#: Score of a character without a piece, a byte: below every piece's.
BYTE_SCORE = -20.0


def read_scores(path: str = VOCABULARY) -> dict[str, float]:
    """Piece -> log-probability by rank, without control and byte pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {p: -math.log(r + 10) for r, p in enumerate(pieces)}


class PieceTrie:
    """Token counts of pre-tokens, and the forward pass that finds them along a trie.

    The distinct pre-tokens of a batch, sorted, are their trie in depth-first order: the path to the
    current node is kept with the forward score and token count of each prefix, and only what
    a pre-token doesn't share with the one before it is computed.
    """

    def __init__(self, scores: dict[str, float], most: int = MOST_KNOWN):
        self.most = most
        # pieces by their reversed text, as nodes [score or None, children]: the pieces
        # that end at a place are found in one walk back
        self.back: dict[str, list] = {}
        for p, s in scores.items():
            level, node = self.back, None
            for c in reversed(p):
                node = level.setdefault(c, [None, {}])
                level = node[1]
            if node is not None:
                node[0] = s
        self.known: dict[str, int] = {}

    def counts(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of the best segmentation of each pre-token."""
        known = self.known
        out = {}
        new = []
        for w in words:
            n = known.get(w)
            if n is None:
                new.append(w)
            else:
                out[w] = n
        new.sort()
        self._walk(new, out)
        if len(known) + len(new) > self.most:
            known.clear()
        known.update((w, out[w]) for w in new[:self.most] if len(w) <= KEPT_CHARS)
        return out

    def _walk(self, words: list[str], out: dict[str, int]) -> None:
        back = self.back
        best, count = [0.0], [0]
        before = ""
        for w in words:
            size = len(w)
            k, most = 0, min(len(before), size)
            while k < most and before[k] == w[k]:
                k += 1
            del best[k + 1:], count[k + 1:]
            for i in range(k, size):
                c = w[i]
                n = 1 if c < "\x80" else len(c.encode("utf-8", "replace"))
                b, m = best[i] + BYTE_SCORE * n, count[i] + n
                node, j = back.get(c), i
                while node is not None:
                    s = node[0]
                    if s is not None:
                        s += best[j]
                        if s > b or s == b and count[j] + 1 < m:
                            b, m = s, count[j] + 1
                    if not j:
                        break
                    j -= 1
                    node = node[1].get(w[j])
                best.append(b)
                count.append(m)
            out[w] = count[size]
            before = w


def count_tokens(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """``keep`` columns, n_pretokens and n_tokens."""
    scores = docs.sparkSession.sparkContext.broadcast(read_scores(vocabulary))

    def make():
        trie = PieceTrie(scores.value)

        def fn(texts):
            pre, tokens = [], []
            for t in texts:
                pre.append(Counter(t.split()) if t else {})
            known = trie.counts({MARK + w for ws in pre for w in ws})
            for ws in pre:
                tokens.append(sum(known[MARK + w] * n for w, n in ws.items()))
            return [[sum(ws.values()) for ws in pre], tokens]
        return fn

    return base.append_columns(docs, text_col, keep, [("n_pretokens", T.LongType()), ("n_tokens", T.LongType())], make)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(base.table(spark, sf_dir, "documents"), ["doc_id"])
