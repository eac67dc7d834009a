"""Token ids in packed rows: best-fit-decreasing with a segment tree over remaining capacities.

Method
    Texts become byte-pair ids of a public vocabulary (its path is a parameter; nothing is
    trained) with one end-of-text id after each document. Documents longer than a row are split
    losslessly into full rows and a rest. Pieces are taken longest first, each into the row
    with the least remaining capacity that still fits; a segment tree over the
    capacities 0..ROW_TOKENS finds it in log steps.
    A packed row has its ids as one fixed-width binary line of the id matrix, padded with the
    end id, the cumulative segment lengths, and the places where positions start at 0 again.

Scale
    Documents are packed where they are read: no shuffle. A task packs blocks of at most
    ``BLOCK_TOKENS`` ids, so its memory is bounded; only the last rows of a block can be part empty.
    The vocabulary (a file of about 1 MB) is read on the driver and broadcast.

Defined results
    Null and empty texts have no ids and are in no row. Ids of a document are the concatenation of its
    segments by ``part``, and those that the tokenizer gives for the whole text, however long its runs are. Repeated rows are packed as often as they come; rows with a null id are
    packed with a null id. ``pack_id`` numbers rows by input partition and differs if that changes.
"""

from __future__ import annotations

import base64
import re

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import base

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that the vocabulary was made with (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROW_TOKENS = 2048
BLOCK_TOKENS = 4_000_000
#: White space (as the splitter sees it) that the splitter isn't given, as it recurses over its length.
_BLANKS = re.compile(r"[^\S\x1c-\x1f]{5000,}")


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes -> id from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Ids of texts; made once per task from the broadcast ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken
        whole = tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self._encode, self._piece = whole.encode_ordinary, whole._encode_single_piece
        self.end = max(ranks.values()) + 1
        self.dtype = np.dtype("<u2") if self.end < 1 << 16 else np.dtype("<u4")

    def ids(self, text: str | None) -> np.ndarray:
        """The ids of a text and the end id; none for null or empty."""
        if not text:
            return np.empty(0, self.dtype)
        out = []
        last = 0
        if len(text) > 5000:
            for m in _BLANKS.finditer(text):  # one piece, but for the last blank if a word follows: that joins it
                end = m.end() - (m.end() < len(text))
                out += self._encode(text[last:m.start()]) + self._piece(text[m.start():end])
                last = end
        out += self._encode(text[last:] if last else text)
        out.append(self.end)
        return np.array(out, self.dtype)


class CapacityTree:
    """Segment tree over remaining capacities: how many open rows have each, and the least that is at least ``c``."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        i = capacity + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes a row with the least capacity >= ``least``: (capacity, row)."""
        count, i = self.count, least + self.size
        if not count[i]:
            while i > 1 and (i & 1 or not count[i ^ 1]):  # up, until a right neighbour has rows
                i >>= 1
            if i <= 1:
                return None
            i ^= 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.size
        while i:
            count[i] -= 1
            i >>= 1
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(lengths: list[int], row: int) -> list[list[int]]:
    """Rows of piece numbers; pieces are at most ``row`` long, ties go in input order."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    tree, rows = CapacityTree(row), []
    for i in order:
        n = lengths[i]
        got = tree.take(n)
        if got is None:
            got = (row, len(rows))
            rows.append([])
        rows[got[1]].append(i)
        if got[0] > n:
            tree.put(got[0] - n, got[1])
    return rows


def pack(docs: DataFrame, row_tokens: int = ROW_TOKENS, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
         text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Packed rows: ``pack_id, n_tokens, ids, cu_seqlens, position_resets, doc_ids, parts, starts``.

    ``ids``: row_tokens little-endian ids (2 bytes each below 65,536 ids, else 4). ``cu_seqlens``: 0 and the
    end of each segment. ``position_resets``: where positions are 0, each segment's start and, if any,
    the padding's. For each segment its document, which part of it this is, and at which token it starts.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches):
        enc = Encoder(ranks.value)
        first = TaskContext.get().partitionId() << 40
        made = 0
        pieces: list[tuple] = []
        held = 0

        def flush():
            nonlocal made, pieces, held
            rows = best_fit_decreasing([len(p[0]) for p in pieces], row_tokens)
            for a in range(0, len(rows), 512):
                out = {k: [] for k in ("pack_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids",
                                       "parts", "starts")}
                for own in rows[a:a + 512]:
                    seg = [pieces[i] for i in own]
                    ends = np.cumsum([0, *(len(p[0]) for p in seg)])
                    line = np.full(row_tokens, enc.end, enc.dtype)
                    line[:ends[-1]] = np.concatenate([p[0] for p in seg])
                    out["pack_id"].append(first + made)
                    out["n_tokens"].append(int(ends[-1]))
                    out["ids"].append(line.tobytes())
                    out["cu_seqlens"].append(ends)
                    out["position_resets"].append(ends if ends[-1] < row_tokens else ends[:-1])
                    out["doc_ids"].append([p[1] for p in seg])
                    out["parts"].append([p[2] for p in seg])
                    out["starts"].append([p[2] * row_tokens for p in seg])
                    made += 1
                yield out
            pieces, held = [], 0

        for b, a, z, texts in base.read_texts(batches, 1):
            for doc, t in zip(b.column(0).slice(a, z - a).to_pylist(), texts):
                ids = enc.ids(t)
                for k in range(0, len(ids), row_tokens):
                    piece = ids[k:k + row_tokens]
                    if held + len(piece) > block_tokens:
                        yield from flush()
                    pieces.append((piece, doc, k // row_tokens))
                    held += len(piece)
        if pieces:
            yield from flush()

    kind = docs.schema[id_col].dataType.simpleString()
    return base.emit(docs, [id_col, text_col],
                     "pack_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
                     f"doc_ids array<{kind}>, parts array<int>, starts array<long>", run)


def unpack(packs: DataFrame, dtype: str = "<u2") -> DataFrame:
    """``doc_id, part, ids`` of every segment: the inverse of ``pack`` up to the order of parts."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                line = np.frombuffer(r["c1"], dtype)
                cu = r["c2"]
                yield {"doc_id": r["c3"], "part": r["c4"], "pack_id": [r["c0"]] * len(r["c3"]),
                       "ids": [line[x:y].astype(np.int32) for x, y in zip(cu[:-1], cu[1:])]}

    return base.emit(packs, ["pack_id", "ids", "cu_seqlens", "doc_ids", "parts"],
                     "doc_id long, part int, pack_id long, ids array<int>", run)


def op3_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(base.table(spark, sf_dir, "documents"))
