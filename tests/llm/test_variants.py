"""Spelling variants against all pairs of words, in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import odd_rows

from carelake.llm import variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_words(rows):
    n = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(rows):
    n = brute_words(rows)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return out


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def garbled(seed, letters="abéÿ", n_words=60, n_docs=200):
    """Documents of words that are few edits apart, on a small alphabet: repeated bigrams, many ties."""
    rng = random.Random(seed)
    words = []
    for _ in range(n_words):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(4, 9)))
        words.append(w)
        for _ in range(3):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            words.append(w)
    return [(i, " ".join(rng.choices(words, k=40)).title() if i % 7 == 0 else "-".join(rng.choices(words, weights=range(1, len(words) + 1), k=40)))
            for i in range(n_docs)]


@pytest.mark.parametrize("hot", [0, 3, variants.HOT])
def test_equals_all_pairs(spark, make_docs, hot):
    for seed, letters in ((1, "ab"), (2, "abéÿ"), (3, "abcdefgh")):
        rows = garbled(seed, letters)
        assert result(variants.variants(make_docs(rows), hot=hot)) == brute(rows)


def test_odd_rows(spark, make_docs):
    rows = odd_rows() + [(1006, "Straße STRASSE strasse Strasse straße naïve naive NAÏVE Naïve naive naive ǅabc ſecret"),
                         (None, "naive naive strasse × abcde÷fgh abcde÷fgh abcde÷fgh")]
    assert result(variants.variants(make_docs(rows))) == brute(rows)


def test_no_words(spark, make_docs):
    assert variants.variants(make_docs([(1, None), (2, ""), (3, "ab 123")])).count() == 0
    assert variants.variants(make_docs([(1, "word")]).limit(0)).count() == 0


def test_clashing_columns(spark, make_docs):
    rows = garbled(4, "abc", n_docs=40)
    df = make_docs(rows).selectExpr("*", "1 as word", "2 as n", "'x' as form", "'y' as key", "3 as near")
    assert result(variants.variants(df)) == brute(rows)


def test_slip_rule(spark, make_docs):
    """Runs whose hash is divided lose just that letter, and a run of five falls out."""
    rows = [(i, f"wordnumber{'abcdefghij'[i % 10]} alpha beta gamma") for i in range(600)]
    got = {r.word: r.n for r in variants.vocabulary(make_docs(rows)).collect()}
    assert got == brute_words(rows)
    assert got["alpha"] < 600


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(5, 12)))
        types = sorted({word[i:i + 2] for i in range(len(word) - 1)}, key=lambda g: rng.random())
        order = {g: (k, rng.randint(1, 9) + k) for k, g in enumerate(types)}
        places, last = variants.prefix(word, order)
        assert len(places) >= 3
        i, j = variants.pivots(word, places, order)
        cost = {p: order[word[p:p + 2]][1] for p in places}
        assert j - i >= 2 and cost[i] + cost[j] == min(cost[a] + cost[b] for a in places for b in places if b - a >= 2)


def test_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(variants.op13_spelling_variants(spark, sf)) == brute(rows)
