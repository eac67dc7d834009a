"""Secret scan by a battery of randomness tests.

Method
    Base patterns find assignments, access keys and long hexadecimal runs. Beside them every maximal run of
    ``[A-Za-z0-9+/_-]`` of ``MIN_LEN`` characters and ``MIN_BITS`` bits at least is tested. Its encoding is the smallest
    alphabet that holds all its characters. Three tests, each under the hypothesis of independent uniform symbols: chi-squared
    uniformity over the alphabet (moments of the multinomial at this length; too uniform counts as well), runs above and below the
    alphabet's middle, and serial correlation of neighbours. Simes' rule makes them one p-value, ``p``.
    A run is a secret if ``p`` is at least ``ALPHA`` (it passes for random) and it is a discovery against
    writing: ``q(p)``, the chance that written text of the same encoding and length reaches ``p``, is at most the cut that the
    Benjamini-Hochberg procedure at ``FDR`` gives for its encoding over all distinct runs of the corpus.
    A short run seldom reaches a small q, since short text often passes for random: the control is aware of length.
    Written text is simulated: letters (of one case) and digits follow the corpus' own pairs in shorter runs, pieces
    are as long as the corpus' pieces, and the strings must have the same inferred encoding.

Scale
    Two scans of the texts. The first gives pair counts (one row a task and pair) and the p-value of each long run,
    of which a task keeps one row a distinct run. Simulation is a task for each encoding and length; lengths
    above ``LAST_LEN`` use its null, which is stricter than theirs. The driver and the tasks get a row of
    ``len(GRID)`` numbers for each encoding and length, at most 12 * (LAST_LEN - MIN_LEN + 1).

Defined results
    Null and empty texts have no spans. Repeated rows and null ids are rows of their own (each row has its own spans; a repeated
    text doesn't count again in the control). An empty table gives no rows. A tested run that
    overlaps a base span isn't reported again. Other columns are kept by ``find`` and not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from carelake.llm import base

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32

MIN_LEN, MIN_BITS, LAST_LEN = 16, 64, 128
ALPHA, FDR = 1e-4, 0.01
SIMULATED, SIM_TASKS = 9_999, 64
#: Strings that are drawn at a time, and draws at most for those that have the encoding.
DRAWN, MOST_DRAWS = 2_000, 100
#: Values of q that are told apart.
GRID = np.logspace(-4, -1, 61)

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = DIGITS + UPPER + LOWER + "+/-_"
#: Fixed alphabets, smallest first.
ENCODINGS = {
    "decimal": DIGITS, "hex": DIGITS + LOWER[:6], "upper hex": DIGITS + UPPER[:6], "lower": LOWER, "upper": UPPER,
    "base32": UPPER + "234567", "lower36": DIGITS + LOWER, "upper36": DIGITS + UPPER, "letters": UPPER + LOWER,
    "base62": DIGITS + UPPER + LOWER, "base64": DIGITS + UPPER + LOWER + "+/", "base64url": DIGITS + UPPER + LOWER + "-_",
    "base66": SYMBOLS,
}
NAMES = list(ENCODINGS)
_SETS = [frozenset(a) for a in ENCODINGS.values()]
_AT = np.full(256, len(SYMBOLS), np.int16)
_AT[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
_CLASS = np.array([0] * 10 + [1] * 26 + [2] * 26 + [3] * 4)
_N = len(SYMBOLS)
#: Letters of both cases count as one, the lower-case one; the last number stands for all other characters.
_FOLD = np.array([*range(10), *range(36, 62), *range(36, _N + 1)], np.int16)


def encoding(run: str) -> int:
    """The number of the smallest alphabet with all the characters."""
    used = set(run)
    return next(i for i, s in enumerate(_SETS) if used <= s)


def testable(length: int, enc: int) -> bool:
    return length >= MIN_LEN and length * math.log2(len(_SETS[enc])) >= MIN_BITS


def two_sided(z: np.ndarray) -> np.ndarray:
    """Chance of a normal value at least as far from 0."""
    return np.array([math.erfc(x) for x in np.abs(z) / math.sqrt(2)])


def battery(x: np.ndarray, k: int) -> np.ndarray:
    """p-values (rows: chi-squared, runs, serial correlation) of strings given as symbol numbers, one string a row of x."""
    m, n = x.shape
    counts = np.bincount((x + np.arange(m)[:, None] * k).ravel(), minlength=m * k).reshape(m, k).astype(float)
    chi = k / n * (counts * counts).sum(1) - n
    mean, var = k - 1, 2 * (k - 1) * (n - 1) / n
    df = 2 * mean * mean / var  # a scaled chi-squared with the same mean and variance; Wilson and Hilferty's cube root
    z_chi = (np.cbrt(chi / mean) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    high = x >= k // 2
    z_runs = ((high[:, 1:] != high[:, :-1]).sum(1) - (n - 1) / 2) / (math.sqrt(n - 1) / 2)
    c = x - (k - 1) / 2
    z_serial = (c[:, 1:] * c[:, :-1]).sum(1) / math.sqrt(n - 1) / ((k * k - 1) / 12)
    return np.stack([two_sided(z_chi), two_sided(z_runs), two_sided(z_serial)])


def combined(ps: np.ndarray) -> np.ndarray:
    """Simes: the least of p(i) * m / i over the sorted p-values."""
    s = np.sort(ps, axis=0)
    return np.minimum(1.0, (s * (len(s) / np.arange(1, len(s) + 1))[:, None]).min(0))


def symbols(run: str, enc: int) -> np.ndarray:
    a = ENCODINGS[NAMES[enc]]
    return np.array([[a.index(c) for c in run]])


def randomness(run: str, enc: int) -> float:
    return float(combined(battery(symbols(run, enc), len(_SETS[enc])))[0])


def long_runs(text: str) -> tuple[np.ndarray, list[tuple[int, str]]]:
    """Symbol numbers of the text's bytes without its long runs, and (place, run) of these: maximal, of MIN_LEN characters or more."""
    raw = np.frombuffer(base.utf8(text), np.uint8)
    at = _AT[raw]
    inside = np.concatenate([[False], at < _N, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    a, z = edge[::2], edge[1::2]
    keep = z - a >= MIN_LEN
    a, z = a[keep], z[keep]
    if not len(a):
        return at, []
    short = at.copy()
    for i, j in zip(a, z):
        short[i:j] = _N
    data = raw.tobytes()
    place = a if len(raw) == len(text) else np.cumsum((raw & 0xC0) != 0x80)[a] - 1
    return short, [(int(p), data[i:j].decode("ascii")) for p, i, j in zip(place, a, z)]


def base_spans(text: str, runs: list[tuple[int, str]]) -> list[tuple[str, int, int]]:
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    for p, run in runs:  # access keys and hexadecimal runs of these lengths lie within long runs
        out += [("access", p + m.start(), p + m.end()) for m in ACCESS.finditer(run) if m.end() - m.start() >= MIN_ACCESS]
        if len(run) >= MIN_HEX:
            out += [("hex", p + m.start(), p + m.end()) for m in HEX.finditer(run) if m.end() - m.start() >= MIN_HEX]
    return out


def _stratum(length: int) -> int:
    return min(length, LAST_LEN)


def survey(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, np.ndarray]:
    """``enc, len, p`` of each distinct testable run of all texts, and the counts of neighbouring characters."""
    def run(batches) -> Iterator[dict]:
        pairs = np.zeros((_N + 1) ** 2, np.int64)
        for _, _, _, texts in base.read_texts(batches, 0):
            found: dict[str, int] = {}
            for t in texts:
                if t:
                    at, runs = long_runs(t)
                    at = _FOLD[at]
                    pairs += np.bincount(at[:-1].astype(np.int32) * (_N + 1) + at[1:], minlength=len(pairs))
                    for _, r in runs:
                        if r not in found and testable(len(r), e := encoding(r)):
                            found[r] = e
            out = [(np.int64(np.uint64(xxh3_64_intdigest(r.encode())).view(np.int64)), e, len(r), randomness(r, e)) for r, e in found.items()]
            if out:
                h, e, n, p = zip(*out)
                yield {"h": h, "enc": e, "len": n, "p": p}
        at = np.flatnonzero(pairs)
        yield {"h": pairs[at], "enc": np.full(len(at), -1), "len": at, "p": np.zeros(len(at))}  # pair counts under encoding -1

    found = base.stash(base.emit(docs, [text_col], "h long, enc int, len long, p double", run), "runs")
    counts = np.zeros((_N + 1) ** 2)
    for r in found.where("enc = -1").groupBy("len").agg(F.sum("h").alias("n")).collect():  # 67 * 67 rows at most
        counts[r.len] = r.n
    distinct = found.where("enc >= 0").groupBy("h", "enc", "len").agg(F.min("p").alias("p"))
    return base.stash(distinct, "distinct-runs"), counts.reshape(_N + 1, _N + 1)[:_N, :_N]


def written(rng: np.random.Generator, enc: int, length: int, pairs: np.ndarray, m: int) -> np.ndarray:
    """m strings (as symbol numbers of the alphabet) of pieces of written text that have this inferred encoding."""
    alphabet = ENCODINGS[NAMES[enc]]
    k, of = len(alphabet), np.array([SYMBOLS.index(c) for c in alphabet])
    cls = _CLASS[of]
    low = _FOLD[of]
    near = pairs[np.ix_(low, low)] + 0.01
    same = cls[:, None] == cls[None, :]
    step = np.where(same, near, 0)
    step = np.cumsum(step / step.sum(1, keepdims=True), axis=1)
    use = pairs.sum(1)[low] + 0.01
    stay = np.zeros(4)
    for c in range(4):
        mine = _CLASS == (2 if c == 1 else c)
        stay[c] = (pairs[np.ix_(mine, mine)].sum() + 3) / (pairs[mine].sum() + 4)
    kinds = np.unique(cls)
    start = [np.cumsum(np.where(cls == c, use, 0)) / use[cls == c].sum() for c in kinds]
    need = {a for a in range(len(NAMES)) if a < enc and not _SETS[a] >= _SETS[enc]}
    smaller = np.array([[ch in _SETS[a] for ch in alphabet] for a in sorted(need)]).reshape(-1, k)
    got, size = [], DRAWN
    for _ in range(MOST_DRAWS):
        x = np.empty((size, length), np.int16)
        pick = rng.integers(len(kinds), size=size)
        for i in range(length):
            if i:
                cur = x[:, i - 1]
                leave = rng.random(size) >= stay[cls[cur]]
                at = np.searchsorted(kinds, cls[cur])
                hop = (at + rng.integers(1, max(2, len(kinds)), size=size)) % len(kinds)
                pick = np.where(leave, hop, at)
            u = rng.random(size)
            first = np.stack([np.searchsorted(s, u, side="right") for s in start])[pick, np.arange(size)]
            x[:, i] = first if not i else np.where(leave, first, (step[cur] <= u[:, None]).sum(1))
        x = np.minimum(x, k - 1)
        fits = ~smaller[:, x].all(2).any(0) if len(smaller) else np.ones(size, bool)
        got.append(x[fits])
        if sum(map(len, got)) >= m:
            break
    out = np.concatenate(got)
    return out[:m] if len(out) else x  # no string of several kinds in all draws: take what text there is


def thresholds(enc: int, length: int, pairs: np.ndarray, m: int = SIMULATED) -> np.ndarray:
    """For each q of GRID the least p at which at most that share of written strings pass for random."""
    rng = np.random.default_rng([enc, length, 11])
    x = written(rng, enc, length, pairs, m)
    p = [combined(battery(x[a:a + DRAWN].astype(np.int64), len(_SETS[enc]))) for a in range(0, len(x), DRAWN)]
    p = np.sort(np.concatenate(p))[::-1]
    at = np.floor(GRID * (len(p) + 1)).astype(int) - 1  # so many strings may reach it: (1 + count) / (1 + m) <= q
    return np.where(at >= 0, np.nextafter(p[np.clip(at, 0, len(p) - 1)], 2), np.inf)


def learn(docs: DataFrame, text_col: str = "text") -> dict[tuple[int, int], float]:
    """For each encoding and length, the least p of a run that is a discovery."""
    spark = docs.sparkSession
    found, pairs = survey(docs, text_col)
    found = found.select("enc", F.least("len", F.lit(LAST_LEN)).alias("len"), "p")
    strata = found.select("enc", "len").distinct().repartition(SIM_TASKS, "enc", "len")

    def simulate(batches) -> Iterator[dict]:
        for b in batches:
            for e, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield {"enc": [e], "len": [n], "at": [thresholds(e, n, pairs)]}

    null = base.emit(strata, ["enc", "len"], "enc int, len long, at array<double>", simulate)
    null = base.stash(null, "null").collect()  # 13 encodings and LAST_LEN lengths at most
    if not null:
        return {}
    table = spark.createDataFrame([(r.enc, r["len"], r["at"]) for r in null], "enc int, len long, at array<double>")
    # the number of grid points whose threshold the run misses: its q is the first that it reaches
    cell = found.join(F.broadcast(table), ["enc", "len"]).select(
        "enc", F.when(F.col("p") >= ALPHA, F.size(F.filter("at", lambda a: a > F.col("p")))).otherwise(len(GRID)).alias("cell"))
    counts = {(r.enc, r.cell): r["n"] for r in cell.groupBy("enc", "cell").agg(F.count("*").alias("n")).collect()}
    cut: dict[int, int] = {}
    for e in {e for e, _ in counts}:
        total, reached = sum(n for (x, _), n in counts.items() if x == e), 0
        for c, q in enumerate(GRID):
            reached += counts.get((e, c), 0)
            if reached and q * total <= FDR * reached:
                cut[e] = c
    return {(r.enc, r["len"]): max(ALPHA, r["at"][cut[r.enc]]) for r in null if r.enc in cut}


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType()), T.StructField("value", T.StringType())]))


def spans_of(text: str, least: dict[tuple[int, int], float]) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, kind and end."""
    _, runs = long_runs(text)
    out = base_spans(text, runs)
    taken = [(a, z) for _, a, z in out]
    for p, r in runs:
        e = encoding(r)
        if not testable(len(r), e) or any(a < p + len(r) and p < z for a, z in taken):
            continue
        at = least.get((e, _stratum(len(r))))
        if at is not None and randomness(r, e) >= at:
            z = p + len(r)
            pad = -len(r) % 4 if len(_SETS[e]) >= 62 else 0  # base64's padding belongs to it
            out.append(("random", p, z + pad if pad < 3 and text[z:z + pad] == "=" * pad else z))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of each row and ``spans``: an array of kind, start, end (code points) and value."""
    least = learn(docs, text_col)

    def make():
        def fn(texts):
            rows = []
            for t in texts:
                found = spans_of(t, least) if t else []
                rows.append([{"kind": k, "start": a, "end": z, "value": t[a:z]} for k, a, z in found])
            return [rows]
        return fn

    return base.append_columns(docs, text_col, keep, [("spans", SPANS)], make)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(base.table(spark, sf_dir, "documents"), ["doc_id"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    by_kind = [counted(k) for k in KINDS]
    return found.select("doc_id", *by_kind, F.sha2(listed(F.filter("spans", lambda s: s.kind != "random")), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
