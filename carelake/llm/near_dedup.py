"""Near-duplicate classes with DartMinHash signatures, banded joining and an exact check.

Method
    A document is the set (or, by count, the weighted set) of its five-word shingles.
    DartMinHash throws hashed darts at each element's weighted region: arrivals of a Poisson
    process over (weight, time) whose randomness comes from the element's hash alone, so that
    two documents see the same darts on what they share. Each dart names one of K
    coordinates; the earliest dart of a coordinate is its signature value, and two
    documents agree there with the probability of their (weighted) Jaccard similarity. Only
    about K ln K + 2K darts are looked at, however long the document is.
    ROWS coordinates make a band; documents that share a band are candidates. At
    similarity 0.8 a pair is missed with probability (1 - 0.8**4)**20 = 2.7e-5. Candidates are then
    checked exactly on their shingle sets, and linked documents form classes
    (connected components).

How large groups stay linear
    1. Exact copies (same words) are one node from the start.
    2. In each bucket the members are checked against LEADERS leaders, those that share
       buckets with most others (the originals of a family of copies), not against each other.
       Members that match none of them elect leaders of their own, once more.
    3. What is then still in another component than its leader is checked against the other members of
       that leader's group, but only against those that can reach the similarity. Let R be the
       shingles outside of the leader that at most RARE members have, i a text's shingles not in R, n all of them, and s the
       ones of R that two texts share: their intersection is at most min(i_a, i_b) + s. Pairs that
       share of R meet in a plain join (a shingle of R meets RARE members at most). Pairs that min(i_a, i_b) alone allows
       have 5 i >= 4 n on both sides; those members meet on the n - ceil(4 n / 5) + 1 rarest of their shingles, of
       which two texts of the similarity share one. So no link between candidates is lost, and
       members of one component are never paired.
    A bucket's members meet its leaders in salted joins: one more salt for each SALT_ROWS members.

    Texts are shuffled nowhere: signatures and shingle sets are made where documents are read, the latter only
    for ids in a broadcast filter of at most MOST_BITS bits.

Defined results
    Texts without words (null, empty) are in no class but their own. Rows with a null id are each
    a row of their own: null class, kept. A text of under five words is one shingle. Repeated rows share their class; different
    texts under one id are documents of their own, each with the class of its text. Class id: the least doc_id of the class
    (of an id with several texts, classes may have the same). Other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from carelake.llm import base
from carelake.llm.graph import components

SHINGLE = 5
BANDS, ROWS = 20, 4
K = BANDS * ROWS
#: Similarity from which documents are linked, as a fraction (4/5).
NUM, DEN = 4, 5
#: Leaders of a bucket, elections, members that share a rare shingle, and bits of the id filter at most.
LEADERS, TURNS, RARE, MOST_BITS = 4, 2, 8, 1 << 27
#: Members of a bucket that one task compares with its leaders.
SALT_ROWS = 256


def shingles(ws: list[bytes]) -> np.ndarray:
    """Hashes of the five-word windows, in order; of the whole text if it has fewer words."""
    h = base.word_hashes(ws)
    return base.ngrams(h, min(SHINGLE, len(h))) if len(h) else h


def fold_words(text: str | None) -> list[bytes]:
    return [] if text is None else base.utf8(text).lower().split()


def dart_minhash(element: np.ndarray, weight: np.ndarray, doc: np.ndarray, n_docs: int, k: int = K) -> np.ndarray:
    """Signatures (n_docs x k) of weighted sets given as parallel arrays; each document has an element.

    The weight axis is cut into the layers [0,1), [1,2), [2,4), ...: darts arrive in each with its
    width as their rate, and one at height x belongs to the set if x is under the weight.
    """
    layers = np.where(weight <= 1, 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(int) + 1)
    at = np.repeat(np.arange(len(element)), layers)
    layer = np.arange(len(at)) - np.repeat(np.cumsum(layers) - layers, layers)
    low = np.where(layer == 0, 0.0, 2.0 ** (layer - 1))
    width = np.maximum(low, 1.0)
    owner, top = doc[at], weight[at]
    seed = base.mix(element[at] ^ (layer.astype(np.uint64) << np.uint64(56)))
    step = np.uint64(0xD1B54A32D192ED03)
    until = (k * np.log(k) + 2 * k) / np.bincount(doc, weight, n_docs)
    first = np.full(n_docs * k, np.inf)
    value = np.zeros(n_docs * k, np.uint64)

    def chance(r):
        return ((r >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53

    throw = base.mix(seed)
    time = -np.log(chance(throw)) / width
    while True:
        now = np.flatnonzero(time < until[owner])
        while now.size:
            r = base.mix(throw[now] ^ step)
            inside = low[now] + width[now] * chance(base.mix(r ^ step)) <= top[now]
            slot = (owner[now] * k + (r % np.uint64(k)).astype(np.int64))[inside]
            y, v = time[now][inside], r[inside]
            np.minimum.at(first, slot, y)
            won = y == first[slot]
            value[slot[won]] = v[won]
            throw[now] = base.mix(throw[now] + step)
            time[now] -= np.log(chance(throw[now])) / width[now]
            now = now[time[now] < until[owner[now]]]
        empty = np.isinf(first.reshape(n_docs, k)).any(1)
        if not empty.any():
            return value.reshape(n_docs, k)
        until[empty] *= 2


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of ROWS coordinates."""
    parts = sig.reshape(len(sig), -1, ROWS)
    key = np.arange(parts.shape[1], dtype=np.uint64)[None, :] + np.zeros((len(sig), 1), np.uint64)
    for i in range(ROWS):
        key = base.mix(key ^ parts[:, :, i])
    return key.view(np.int64)


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_count: bool = False) -> DataFrame:
    """``doc_id, digest, n, keys, mark, mark2``: digest of the words, number of different shingles, band keys (none without words), row key."""
    def run(batches):
        for b, a, z, texts in base.read_texts(batches, 1):
            out = {"doc_id": b.column(0).slice(a, z - a), "digest": [], "n": [], "keys": [None] * (z - a),
                   "mark": b.column(2).slice(a, z - a), "mark2": b.column(3).slice(a, z - a)}
            sets, counts, who = [], [], []
            for i, t in enumerate(texts):
                ws = fold_words(t)
                s, c = np.unique(shingles(ws), return_counts=True)
                out["digest"].append(xxh3_128_digest(b" ".join(ws)) if ws else None)
                out["n"].append(len(s))
                if ws:
                    sets.append(s)
                    counts.append(c if by_count else np.ones(len(s)))
                    who.append(i)
            if who:
                doc = np.repeat(np.arange(len(who)), [len(s) for s in sets])
                sig = dart_minhash(np.concatenate(sets), np.concatenate(counts).astype(float), doc, len(who))
                for i, keys in zip(who, band_keys(sig)):
                    out["keys"][i] = keys
            yield out

    ids = docs.where(F.col(id_col).isNotNull())
    ids = ids.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *row_marks(id_col, text_col))
    kind = ids.schema["id"].dataType.simpleString()
    return base.emit(ids, ids.columns, f"doc_id {kind}, digest binary, n int, keys array<long>, mark long, mark2 long", run)


def row_marks(id_col: str = "doc_id", text_col: str = "text") -> list[F.Column]:
    """Two independent 64-bit hashes of id and text: together a row's key."""
    return [F.xxhash64(id_col, text_col, F.lit(3)).alias("mark"), F.xxhash64(F.lit(4), text_col, id_col).alias("mark2")]


def id_bits(nodes: DataFrame, most: int = MOST_BITS) -> tuple[np.ndarray, int]:
    """A Bloom filter of the ids in ``nodes (node)``: its words, and its size in bits (at most ``most``)."""
    n = nodes.count()
    size = min(most, max(1024, 1 << (16 * n).bit_length()))
    spots = nodes.select(F.explode(F.array(*_spots("node", size))).alias("p"))
    words = spots.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    bits = np.zeros(size // 64, np.int64)
    for r in words.toLocalIterator():  # size / 64 rows at most
        bits[r.w] = r.b
    return bits, size


def _spots(col: str, size: int) -> list[F.Column]:
    return [F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(size)) for seed in range(3)]


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, toks``: the different shingles of the texts in ``nodes (node, digest, id)``.

    Documents are picked by a broadcast filter of their ids, of bounded size, so texts are not shuffled; what it
    lets through wrongly has the digest of no node.
    """
    bits, size = id_bits(nodes.select(F.col("id").alias("node")))
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        have = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            ok = np.ones(b.num_rows, bool)
            for k in range(2, 5):
                p = b.column(k).to_numpy(zero_copy_only=False)
                ok &= (have[p >> 6] >> (p & 63)) & 1 == 1
            b = b.filter(pa.array(ok))
            for _, _, _, texts in base.read_texts([b], 1):
                folded = [fold_words(t) for t in texts]
                yield {"digest": [xxh3_128_digest(b" ".join(ws)) for ws in folded],
                       "toks": [np.unique(shingles(ws)).view(np.int64) for ws in folded]}

    ids = docs.where("doc_id is not null").select(
        "doc_id", "text", *[x.alias(f"p{i}") for i, x in enumerate(_spots("doc_id", size))])
    found = base.emit(ids, ids.columns, "digest binary, toks array<long>", run).dropDuplicates(["digest"])
    return found.join(nodes.select("digest", "node"), "digest").select("node", "toks")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, na, nb, both``: sizes and intersections of the pairs' shingle sets."""
    x = pairs.join(sets.select(F.col("node").alias("b"), F.col("toks").alias("tb")), "b")
    x = x.join(sets.select(F.col("node").alias("a"), F.col("toks").alias("ta")), "a")
    return x.select("a", "b", F.size("ta").alias("na"), F.size("tb").alias("nb"),
                    F.size(F.array_intersect("ta", "tb")).alias("both"))


def similar(both="both", na="na", nb="nb") -> F.Column:
    """both / (na + nb - both) >= NUM / DEN, in whole numbers."""
    return (NUM + DEN) * F.col(both) >= NUM * (F.col(na) + F.col(nb))


def leaders(members: DataFrame) -> DataFrame:
    """``key, size, rank, leader``: of each bucket's members (key, node, size) the LEADERS that share buckets with most."""
    rank = members.groupBy("node").agg(F.sum("size").alias("c"))
    by = Window.partitionBy("key").orderBy(F.desc("c"), "node")
    top = members.join(rank, "node").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= LEADERS)
    return top.select("key", "size", "rank", F.col("node").alias("leader"))


def near_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_shingles`` for every row with an id."""
    sk, of = _text_classes(docs)
    return sk.join(of, "digest", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.col("n").cast("long").alias("n_shingles"))


def _text_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketches, and ``digest, node, comp, class_id`` of each different text that has words; texts are numbered by ``node``."""
    sk = base.stash(sketch(docs), "sketch")
    reps = base.stash(sk.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.any_value("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()), "reps")
    found = base.stash(_classes(docs, reps), "classes")
    of = base.stash(reps.select("digest", "node", "id").join(found, "node", "left").select(
        "digest", "node", "id", F.coalesce("comp", "node").alias("comp")), "of")
    least = of.groupBy("comp").agg(F.min("id").alias("class_id"))
    return sk, base.stash(of.join(least, "comp").select("digest", "node", "comp", "class_id"), "text-classes")


def _classes(docs: DataFrame, reps: DataFrame) -> DataFrame:
    rows = reps.select("node", F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = base.stash(rows.join(sizes, "key"), "members")
    linked = reps.select("node", "digest", "id").join(members.select("node").distinct(), "node")
    sets = base.stash(shingle_sets(docs, base.stash(linked, "linked")), "sets")
    links, groups = None, None
    for turn in range(TURNS):
        salts = F.ceil(F.col("size") / SALT_ROWS)
        salted = members.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(5)), salts))
        led = base.stash(salted.join(leaders(members).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("size"),
                                     ["key", "salt"]).where("node <> leader").select("key", "rank", "leader", "node"), "led")
        pairs = led.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        checked = base.stash(verify(pairs, sets), "checked")
        if groups is None:
            groups = led.where("rank = 1").select("leader", "node").distinct()
        new = checked.where(similar()).select(F.col("a").alias("u"), F.col("b").alias("v"))
        links = new if links is None else links.unionAll(new)
        if turn + 1 < TURNS:  # members without a link to any of their bucket's leaders elect their own
            tied = new.toDF("leader", "node")
            tied = tied.unionAll(new.toDF("node", "leader").select("leader", "node"))
            left = (led.join(tied.withColumn("ok", F.lit(1)), ["leader", "node"], "left")
                    .groupBy("key", "node").agg(F.max("ok").alias("ok")).where("ok is null").select("key", "node"))
            sizes = left.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
            members = base.stash(left.join(sizes, "key"), "members")
    comps = base.stash(components(links), "comps")
    extra = base.stash(_rest(groups, comps, sets), "rest")
    if extra.isEmpty():
        return comps
    name = comps.select(F.col("node").alias("n"), F.col("comp").alias("c"))
    ends = (extra.join(name.toDF("u", "cu"), "u", "left").join(name.toDF("v", "cv"), "v", "left")
            .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
    merged = base.stash(components(ends), "merged")
    both = comps.join(merged.toDF("comp", "m"), "comp", "left").select("node", F.coalesce("m", "comp").alias("comp"))
    return both.unionAll(merged.toDF("node", "comp").join(comps.select("node"), "node", "left_anti"))


def _rest(groups: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of a leader's group that are still in different components (step 3)."""
    name = comps.select(F.col("node"), F.col("comp").alias("c"))
    g = groups.join(name, "node", "left").withColumn("c", F.coalesce("c", "node"))
    g = g.join(name.toDF("leader", "cl"), "leader", "left").withColumn("cl", F.coalesce("cl", "leader"))
    g = g.select("leader", "node", "c", (F.col("c") != F.col("cl")).alias("out"))
    open_ = g.where("out").select("leader").distinct()
    g = (g.join(open_, "leader", "left_semi").join(sets.toDF("node", "tn"), "node")
         .join(sets.toDF("leader", "tl"), "leader")
         .select("leader", "node", "c", "out", F.size("tn").alias("n"), F.explode_outer(F.array_except("tn", "tl")).alias("tok")))
    g = base.stash(g, "outside")
    rare = g.where("tok is not null").groupBy("leader", "tok").agg(F.count("*").alias("df")).where(f"df <= {RARE}")
    g = base.stash(g.join(rare, ["leader", "tok"], "left"), "rare")
    member = g.groupBy("leader", "node").agg(F.any_value("c").alias("c"), F.any_value("out").alias("out"),
                                             (F.any_value("n") - F.count("df")).alias("i"), F.any_value("n").alias("n"))
    member = base.stash(member, "groups")
    once = ~F.col("y.out") | (F.col("x.node") < F.col("y.node"))
    apart = (F.col("x.leader") == F.col("y.leader")) & (F.col("x.c") != F.col("y.c")) & once
    pairs = _alike(member, sets, apart)
    shared = g.where("df > 1").join(member.select("leader", "node", "i"), ["leader", "node"])
    x, y = shared.where("out").alias("x"), shared.alias("y")
    shared = (x.join(y, (F.col("x.tok") == F.col("y.tok")) & apart)
              .groupBy("x.leader", "x.node", "y.node", "x.n", "y.n", "x.i", "y.i").agg(F.count("*").alias("s"))
              .toDF("leader", "a", "b", "nx", "ny", "ix", "iy", "s")
              .where((NUM + DEN) * (F.least("ix", "iy") + F.col("s")) >= NUM * (F.col("nx") + F.col("ny"))))
    pairs = pairs.unionAll(shared.select("a", "b")).distinct()
    return verify(pairs, sets).where(similar()).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _alike(member: DataFrame, sets: DataFrame, apart: F.Column) -> DataFrame:
    """Pairs of a straggler and a member of its leader's group, ``a, b``, whose shingles that aren't rare may suffice.

    Such members have 5 i >= 4 n. They meet on their rarest shingles: if two texts share so much, they share one of the first
    n - ceil(4 n / 5) + 1 of each, in one order of all shingles.
    """
    able = member.where(DEN * F.col("i") >= NUM * F.col("n"))
    able = base.stash(able.join(able.where("out").select("leader").distinct(), "leader", "left_semi"), "able")
    toks = base.stash(able.join(sets, "node").select("leader", "node", "c", "out", "i", "n", F.explode("toks").alias("tok")), "able-toks")
    df = toks.groupBy("leader", "tok").agg(F.count("*").alias("df")).where("df > 1")
    own = toks.join(df, ["leader", "tok"], "left").groupBy("leader", "node").agg(
        *[F.any_value(c).alias(c) for c in ("c", "out", "i", "n")],
        F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "tok"))).alias("toks"))  # a text's own shingles
    first = F.expr(f"transform(slice(toks, 1, cast(n - ceil({NUM} * n / {DEN}) + 1 as int)), x -> x.tok)")
    rows = own.where(F.size("toks") > 0).withColumn("head", first)
    rows = rows.select("leader", "node", "c", "out", "i", "n", "head", F.posexplode("head").alias("at", "tok"), "toks")
    rows = base.stash(rows.where(F.expr("toks[at].df > 1")).drop("toks"), "able-heads")
    x, y = rows.where("out").alias("x"), rows.alias("y")
    need = NUM * (F.col("x.n") + F.col("y.n"))
    enough = (NUM + DEN) * F.least("x.i", "y.i") >= need
    # they meet where their heads first agree: from there on, enough of both must be left
    once = F.array_intersect("x.head", "y.head")[0] == F.col("x.tok")
    left = (NUM + DEN) * F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at")) >= need
    return x.join(y, (F.col("x.tok") == F.col("y.tok")) & apart & enough & left & once).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, one of its least id; rows with a null id or without words stay."""
    sk, of = _text_classes(docs)
    ids = sk.join(of, "digest", "left").select("comp", F.struct("doc_id", "mark", "mark2").alias("row"))
    stay = ids.groupBy("comp").agg(F.min("row").alias("row")).where("comp is not null").select(
        F.col("row.mark").alias("llm k1"), F.col("row.mark2").alias("llm k2"))
    keys = ["llm k1", "llm k2"]
    marked = docs.where("doc_id is not null").withColumns(dict(zip(keys, row_marks())))
    wordless = sk.where("n = 0").select(F.col("mark").alias(keys[0]), F.col("mark2").alias(keys[1])).distinct()
    kept = marked.join(stay, keys, "left_semi").dropDuplicates(keys).unionAll(marked.join(wordless, keys, "left_semi"))
    return kept.drop(*keys).unionAll(docs.where("doc_id is null"))


def without_id(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_shingles`` of the rows with a null id: both null, and the shingles counted."""
    def run(batches):
        for b, a, z, texts in base.read_texts(batches, 1):
            yield {"doc_id": [None] * (z - a), "class_id": [None] * (z - a),
                   "n_shingles": [len(np.unique(shingles(fold_words(t)))) for t in texts]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return base.emit(docs.where("doc_id is null"), ["doc_id", "text"], f"doc_id {kind}, class_id {kind}, n_shingles long", run)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_classes(docs).unionAll(without_id(docs))
    kept = F.col("doc_id").isNull() | (F.col("doc_id") == F.col("class_id"))
    return out.select("doc_id", "class_id", kept.alias("kept"), "n_shingles")
