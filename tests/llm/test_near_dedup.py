"""Near-duplicate classes against all pairs; signatures; components; the pipeline."""

import random

import numpy as np
from conftest import DOCS, odd_rows

from carelake.llm import graph, near_dedup


def words(r, n):
    return ["".join(r.choices("abcdefghij", k=4)) for _ in range(n)]


def family(r, n, copies, edits):
    """A text and copies with a number of words replaced."""
    first = words(r, n)
    out = [first]
    for _ in range(copies):
        c = list(first)
        for _ in range(r.randint(0, edits)):
            c[r.randrange(n)] = "".join(r.choices("klmnop", k=5))
        out.append(c)
    return [" ".join(x) for x in out]


def brute(rows):
    sets = [(i, frozenset(near_dedup.shingles(near_dedup.fold_words(t)).tolist())) for i, t in rows if i is not None]
    comp = {i: i for i, _ in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                comp[y] = x
    return {i: find(i) for i in comp}


def test_classes_match_all_pairs(make_docs):
    r = random.Random(4)
    texts = [" ".join(words(r, r.randint(1, 90))) for _ in range(60)]
    for n, copies, edits in ((60, 40, 5), (120, 25, 9), (30, 10, 2), (200, 30, 12)):
        texts += family(r, n, copies, edits)
    texts += [texts[3]] * 7 + [texts[70].upper().replace(" ", "\n")] * 3
    r.shuffle(texts)
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, None), (903, "two words"), (904, "two  words")]
    got = {x.doc_id: x.class_id for x in near_dedup.near_classes(make_docs(rows)).collect()}
    assert got == brute(rows)


def test_straggler_links_are_found(make_docs):
    """A chain whose far ends are alike only through members in the middle, in one hot group."""
    r = random.Random(9)
    base_words = words(r, 150)
    chain = []
    for step in range(12):
        base_words = list(base_words)
        for k in range(2):
            base_words[(step * 11 + k * 5) % 150] = f"edit{step}x{k}"
        chain.append(" ".join(base_words))
    rows = list(enumerate(chain))
    got = {x.doc_id: x.class_id for x in near_dedup.near_classes(make_docs(rows)).collect()}
    assert got == brute(rows)


def test_keep_one(spark, make_docs):
    r = random.Random(2)
    a = family(r, 80, 6, 1)
    rows = [(10 + i, t) for i, t in enumerate(a)] + [(1, a[0]), (50, "other text of its own"), (50, "other text of its own"),
                                                    (None, a[0]), (60, None), (61, "")]
    docs = make_docs(rows)
    out = near_dedup.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((x.doc_id for x in out.collect()), key=str) == sorted([1, 50, 60, 61, None], key=str)
    none = spark.createDataFrame([], DOCS)
    assert near_dedup.keep_one(none).count() == 0 and near_dedup.near_classes(none).count() == 0
    odd = make_docs(odd_rows(6))
    assert near_dedup.near_classes(odd).count() == odd.where("doc_id is not null").count()


def test_rows_without_id_are_rows_of_the_result(spark, make_docs, tmp_path):
    rows = odd_rows(6) + [(None, None), (None, "a b c d e f"), (None, "a b c d e f")]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = near_dedup.op7_near_dedup(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
    assert sorted(tuple(r)[1:] for r in out if r.doc_id is None) == [(None, True, n) for n in (0, 2, 2, 4)]
    assert all(r.kept == (r.doc_id == r.class_id) for r in out if r.doc_id is not None)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    wa = rng.integers(0, 6, 300).astype(float)
    wb = rng.integers(0, 6, 300).astype(float)
    k = 4096
    sig = near_dedup.dart_minhash(np.concatenate([h[wa > 0], h[wb > 0]]), np.concatenate([wa[wa > 0], wb[wb > 0]]),
                                  np.repeat([0, 1], [(wa > 0).sum(), (wb > 0).sum()]), 2, k)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 0.03
    alone = near_dedup.dart_minhash(h[wa > 0], wa[wa > 0], np.zeros((wa > 0).sum(), int), 1, k)
    assert np.array_equal(alone[0], sig[0])  # a batch changes nothing
    tiny = near_dedup.dart_minhash(h[:1], np.ones(1), np.zeros(1, int), 1, 80)
    assert len(np.unique(tiny)) > 70


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(r.randrange(50), r.randrange(50)) for _ in range(35)] + [(7, 7), (None, 3), (60, 60)]
    comp = {}

    def find(x):
        while comp.setdefault(x, x) != x:
            x = comp[x]
        return x
    for u, v in edges:
        if u is not None and u != v:
            x, y = sorted((find(u), find(v)))
            comp[y] = x
    got = {x.node: x.comp for x in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: find(n) for n in comp}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import os

    import pytest

    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cols = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == cols, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() > 0
    packs = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    ids = {i for r in packs.select("doc_ids").collect() for i in r.doc_ids}
    assert ids == {r.doc_id for r in docs.collect()}


def test_texts_under_one_id(make_docs):
    """Different texts with one id are documents of their own, whatever the order of rows."""
    r = random.Random(12)
    a, b, c = (family(r, 90, 4, 1) for _ in range(3))
    rows = [(5, a[0]), (5, b[0]), (5, c[0])] + [(10 + i, t) for i, t in enumerate(a[1:])] + [(20 + i, t) for i, t in enumerate(b[1:])]
    rows += [(5, None), (5, ""), (5, b[0]), (3, c[1])]
    for order in (rows, rows[::-1]):
        docs = make_docs(order)
        kept = [(x.doc_id, x.text) for x in near_dedup.keep_one(docs).collect()]
        assert sorted(kept, key=str) == sorted([(5, a[0]), (5, b[0]), (3, c[1]), (5, None), (5, "")], key=str)
        got = sorted((x.doc_id, x.class_id) for x in near_dedup.near_classes(docs).collect())
        assert got == sorted([(i, 3 if t in (c[0], c[1]) else 5) for i, t in rows])


def test_clashing_columns(make_docs):
    rows = [(i, t) for i, t in enumerate(family(random.Random(3), 60, 5, 1))]
    docs = make_docs(rows).selectExpr("*", "1 as node", "2 as class_id", "3 as mark", "'x' as digest", "4 as `llm k1x`")
    out = near_dedup.keep_one(docs)
    assert out.columns == docs.columns and [x.doc_id for x in out.collect()] == [0]


def test_template_family(make_docs):
    """A hot family on one template, about half like its leader: links among stragglers only."""
    r = random.Random(21)
    template, rows = words(r, 120), []
    for g in range(12):  # groups alike inside, and 0.5 to 0.79 like each other
        own = list(template)
        for k in range(9):
            own[(g * 7 + k * 13) % 120] = f"group{g}x{k}"
        for m in range(8):
            t = list(own)
            t[r.randrange(120)] = f"m{m}g{g}"
            rows.append((len(rows), " ".join(t)))
    r.shuffle(rows)
    got = {x.doc_id: x.class_id for x in near_dedup.near_classes(make_docs(rows)).collect()}
    assert got == brute(rows)


def test_pipeline_drops_its_tables(spark):
    """run() gives the stages' rows and leaves the last stage's table only."""
    import os

    import pytest

    import corpus_pipeline
    from carelake.llm import base
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    before = set(base.stashes())
    out = corpus_pipeline.run(spark, sf)
    left = [p for p in base.stashes() if p not in before]
    assert len(left) == 1 and "stage-token_output" in left[0]
    assert out.count() > 0 and sum(len(r.doc_ids) for r in out.select("doc_ids").collect()) > 50
