"""Quality rules, decontamination, licences and token counts against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F
from conftest import DOCS, odd_rows

from carelake.llm import decontaminate, licenses, quality, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    ws = WORD.findall(text or "")
    tri = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    hit = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


@pytest.mark.parametrize("text", [None, "", " \t", "a", "a b c", "a b c a b c", "x x x x", "l1 a\nl1 a\n\n\n l1 a\nl1 a",
                                  "# <b>\n|é ï|\n# <b>", "a b c d a b c d e", "1 2 3 1 2 3 2 3 1 2"])
def test_base_counts(text):
    from carelake.llm import base
    assert quality.base_counts(text, base.word_hashes(base.words(text))) == brute_counts(text)


def test_quality_rules(spark, make_docs):
    good = [f"the {a} and the {b} of a {c} in some {d} place" for a, b, c, d in
            zip("abcdefghij", "klmnopqrst", "bdfhjlnprt", "acegikmoqs")]
    rows = []
    for i in range(80):
        words = " ".join(good[(i * 7 + k) % 10] + f" n{i}x{k}" for k in range(9))
        rows.append((i, words if i % 4 else " ".join(w + "***" for w in words.split())))
    docs = make_docs(rows + [r for r in odd_rows(5) if r[0] not in range(80)])
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(60)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.apply_rules(docs, labels).collect()}
    for i in range(80):  # 60 to 79 are unlabelled
        assert out[i].kept == bool(i % 4), out[i]
        assert tuple(out[i])[1:6] == brute_counts(rows[i][1])
    assert out[1000].n_words == 0 and out[1000].base_failed and not out[1000].kept
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in out.items() if r.kept}
    # without labels only the base rules reject; an empty table gives nothing
    none = labels.where("false")
    assert {r.doc_id for r in quality.keep_good(docs, none).collect()} == {k for k, r in out.items() if not r.base_failed}
    assert quality.apply_rules(spark.createDataFrame([], DOCS), labels).count() == 0


@pytest.mark.parametrize("n_good", [1, 2, 3])
def test_few_trusted_labels(spark, make_docs, n_good):
    """Trusted ids of which the hash draw takes none, and one that is in no document."""
    good = [f"the {a} and the {b} of a {c} in some {d} place" for a, b, c, d in
            zip("abcdefghij", "klmnopqrst", "bdfhjlnprt", "acegikmoqs")]
    rows = []
    for i in range(80):
        words = " ".join(good[(i * 7 + k) % 10] + f" n{i}x{k}" for k in range(9))
        rows.append((i, words if i % 4 else " ".join(w + "***" for w in words.split())))
    clean = spark.range(80).where("id % 4 > 0")
    missed = [r.id for r in clean.where(~quality.drawn("id", 0.5)).orderBy("id").limit(n_good).collect()]
    gone = spark.range(1000, 1100).where(~quality.drawn("id", 0.5)).first().id
    labels = spark.createDataFrame([(i, 1, 0) for i in [*missed, gone]] + [(i, 0, 0) for i in range(0, 40, 4)],
                                   "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.apply_rules(make_docs(rows), labels).collect()}
    assert len(missed) == n_good and all(out[i].kept for i in range(80) if i % 4)
    if n_good > 1:  # one is learned from, the others are held against the rejected ones
        assert not any(out[i].kept for i in range(0, 80, 4))
    only = labels.where(f"quality = 0 or doc_id = {gone}")  # nothing to learn from
    out = {r.doc_id: r for r in quality.apply_rules(make_docs(rows), only).collect()}
    assert all(r.kept != r.base_failed for r in out.values())


def test_ratio_and_threshold_by_counting(spark, make_docs):
    """Log-ratios from plain counters and the threshold from a scan of every edge, against the operator on random texts."""
    import math
    import random
    from collections import Counter

    from carelake.llm import base
    r = random.Random(3)
    rows = []
    for i in range(160):
        pool = ["good", "plain", "text", "words", "that", "read"] if i % 3 else ["spam", "click", "words", "text", "win", "now"]
        rows.append((i, " ".join(r.choice(pool) + str(r.randrange(30)) for _ in range(r.randint(45, 90)))))
    docs = make_docs(rows).selectExpr("*", "1 as n_words", "2 as llr", "'x' as l_id", "3 as quality")  # clashing names
    marks = {i: int(i % 3 > 0) for i in range(120)} | {7: 0, 9: 1}
    labels = spark.createDataFrame([(i, q, 0) for i, q in marks.items()], "doc_id long, quality int, toxic int")
    part = min(0.5, 50_000 / sum(marks.values()))
    inside = {x.id for x in spark.range(160).where(quality.drawn("id", part)).collect()}
    grams = {i: Counter(quality.grams(base.word_hashes(base.words(t))).tolist()) for i, t in rows}
    raw, target = Counter(), Counter()
    for i, c in grams.items():
        raw += c
        if marks.get(i) == 1 and i in inside:
            target += c
    n_raw, n_target = sum(raw.values()), sum(target.values())
    p_raw = lambda b: (raw[b] + 1) / (n_raw + quality.BUCKETS)
    prior = quality.PRIOR * n_target
    w = lambda b: math.log((target[b] + prior * p_raw(b)) / (n_target + prior) / p_raw(b))
    llr = {i: sum(n * w(b) for b, n in c.items()) / sum(c.values()) for i, c in grams.items()}
    failed = {i: brute_counts(t)[0] < 50 or 100 * brute_counts(t)[4] > 50 * brute_counts(t)[0] for i, t in rows}
    judged = [(llr[i], q) for i, q in marks.items() if not failed[i] and (q == 0 or i not in inside)]
    n = Counter(q for _, q in judged)
    edges = [k / quality.BINS_A_UNIT for k in range(-2000, 2003)]
    score = [sum(x < e for x, q in judged if q == 0) / n[0] + sum(x >= e for x, q in judged if q == 1) / n[1] for e in edges]
    best = [e for e, s in zip(edges, score) if s >= max(score) - 1e-12]
    threshold = best[len(best) // 2]
    got = {x.doc_id: x for x in quality.apply_rules(docs, labels).collect()}
    for i, _ in rows:
        assert got[i].llr == pytest.approx(llr[i], abs=1e-9)
        assert got[i].kept == (not failed[i] and got[i].llr >= threshold)
    assert {x.doc_id for x in quality.keep_good(docs, labels).collect()} == {i for i in got if got[i].kept}
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_ties_at_the_threshold(spark):
    """Equal ratios fall on one side: a score on the edge is kept; equal scores of both labels decide nothing."""
    import numpy as np
    model = quality.QualityModel(np.zeros(quality.BUCKETS), 0.0)
    schema = "doc_id long, n_words long, n_repeat_words long, llr double"
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    apart = spark.createDataFrame([(i, 100, 0, 0.5 if i % 2 else -0.5) for i in range(8)], schema)
    t = quality.fit_threshold(apart, labels, model)
    assert -0.5 < t <= 0.5
    edge = spark.createDataFrame([(i, 100, 0, 0.005 if i % 2 else 0.0) for i in range(8)], schema)
    assert quality.fit_threshold(edge, labels, model) == 0.005
    same = spark.createDataFrame([(i, 100, 0, 0.25) for i in range(8)], schema)
    assert quality.fit_threshold(same, labels, model) == float("-inf")


def ascii_lower(x):
    return "".join(c.lower() if c.isascii() else c for c in x)


def brute_hits(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))
    doc, hit, ids = words(text), set(), set()
    for i, t in items:
        ws = words(t)
        n = min(13, len(ws))
        for a in range(len(ws) - n + 1 if n else 0):
            for p in range(len(doc) - n + 1):
                if doc[p:p + n] == ws[a:a + n]:
                    hit |= set(range(p, p + n))
                    ids.add(i)
    return len(doc), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


@pytest.mark.parametrize("block", [1_000_000, 12])
def test_decontamination_report(spark, make_docs, block):
    a = " ".join(f"alpha{i}" for i in range(20))
    b = "Short one"
    c = " ".join(["rep"] * 30)
    items = [(1, a), (2, b), (3, c), (10, a + " tail"), (4, None), (5, ""), (6, "!!!"), (7, "ÉCOLE 42"), (8, "rep")]
    fill = " ".join(f"f{i}" for i in range(300))
    docs = [(0, a), (1, fill + " " + a[:-1] + fill), (2, "x SHORT, one! y"), (3, "short two one"), (4, "rep " * 40), (5, fill),
            (6, "ÉCOLE-42 école 42"), (7, None), (8, ""), (9, " ".join(a.split()[3:15])), (10, " ".join(a.split()[3:16])),
            (None, b), (11, "rep short one rep " + fill), (12, a + " " + a), (12, a + " " + a)]
    d = make_docs(docs)
    it = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.report(d, it, block_words=block).collect()), key=str)
    want = []
    for i, t in docs:
        n, h, k, sha = brute_hits(t, items)
        want.append((i, n, h, k, sha, h > 0 and 20 * h >= n))
    assert got == sorted(want, key=str)
    kept = decontaminate.clean(d, it, block_words=block)
    assert kept.columns == d.columns
    clean = {i for i, *_, bad in want if not bad}
    assert {r.doc_id for r in kept.collect()} == clean
    long = {r.doc_id: r for r in kept.collect()}
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in long.values())
    assert long[5].text == fill
    none = it.where("false")
    assert decontaminate.clean(d, none, block_words=block).count() == len(docs)
    assert decontaminate.report(d.where("false"), it, block_words=block).count() == 0


def test_decontamination_cuts_spans(spark, make_docs):
    item = " ".join(f"q{i}" for i in range(15))
    fill = " ".join(f"f{i}" for i in range(400))
    d = make_docs([(1, f"{fill}, {item}. {fill}")])
    out = decontaminate.clean(d, spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert out.text == f"{fill}, . {fill}"


def test_longest_matches_of_the_automaton():
    import random
    r = random.Random(3)
    items = [(str(k), [r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(1, 25))]) for k in range(8)]
    auto = decontaminate.ItemAutomaton(items, window=4)
    text = [r.choice([b"a", b"b", b"c", b"z"]) for _ in range(400)]
    subs = {tuple(ws[i:j]) for _, ws in items for i in range(len(ws)) for j in range(i + 1, len(ws) + 1)}
    want = [max((n for n in range(1, 26) if n <= i + 1 and tuple(text[i + 1 - n:i + 1]) in subs), default=0) for i in range(400)]
    assert auto.longest(text) == want


def test_license_scan(spark, make_docs):
    mit = next(t for i, t in licenses.KNOWN if t.startswith("Permission is hereby granted, free"))
    rows = [(1, mit), (2, "Copyright (c) 2020 Jane Doe\nAll rights reserved.\n\n" + mit.upper().replace(",", " ;")),
            (3, "Code here.\nReleased under the MIT Licence\nLicensed under CC BY-NC 4.0!"), (4, "Released under the MIT License today."),
            (5, None), (6, ""), (7, "***"), (None, "released under the mit license"), (8, "copyrighted text"), (3, "SPDX-License-Identifier: MIT")]
    rows += [(None, "no licence"), (None, None)]  # rows of one id, null included, are rows of their own
    got = sorted(((r.doc_id, r.license, r.notices) for r in licenses.scan(make_docs(rows).withColumn("row", F.lit(1))).collect()), key=str)
    assert got == sorted([(1, "MIT", ""), (2, "MIT", ""), (3, None, "CC-BY-NC-4.0,MIT"), (3, "MIT", "MIT"), (4, None, ""), (5, None, ""), (6, None, ""),
                          (7, None, ""), (None, "MIT", "MIT"), (None, None, ""), (None, None, ""), (8, None, "")], key=str)
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0


def reflowed(text, width):
    """The paragraphs of a text filled to a width; each on a line of its own for None."""
    import textwrap
    paras = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text.strip())]
    return "\n\n".join(p if width is None else textwrap.fill(p, width, break_on_hyphens=False) for p in paras)


HOLDERS = ["Copyright (c) 2020 Jane Doe\nAll rights reserved.", "© Jane Doe and others", "Copyright 1999-2004, The Foo Project",
           "(c) Jane Doe", "Copyright by the authors", "Copyright Jane Doe"]


def test_license_texts_in_any_wrapping(spark, make_docs):
    full = [(i, t) for i, t in licenses.KNOWN if len(t) > 400]
    rows, want = [], {}
    for i, t in full:
        for w in (24, 40, *range(60, 101, 3), 120, None):
            for head in ("", HOLDERS[len(rows) % len(HOLDERS)] + "\n\n"):
                want[len(rows)] = i
                rows.append((len(rows), head + reflowed(t, w)))
    got = {r.doc_id: r.license for r in licenses.scan(make_docs(rows)).collect()}
    assert {k: rows[k][1] for k in want if got[k] != want[k]} == {}


def test_license_full_texts(spark, make_docs):
    files = {f.stem: f.read_text(encoding="utf-8") for f in licenses.TEXTS.glob("*.txt")}
    assert {"Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "CC0-1.0", "Unlicense"} <= files.keys()
    bsd = licenses.BSD_HEAD.format("*", "*") + licenses.BSD_TAIL.format("COPYRIGHT HOLDERS", "COPYRIGHT OWNER")
    mit = next(t for i, t in licenses.KNOWN if t.startswith("Permission is hereby granted, free"))
    isc = next(t for i, t in licenses.KNOWN if i == "ISC")
    texts = [*files.items(), ("MIT", mit), ("MIT", "MIT License\n\n" + mit), ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 A\n\n" + mit),
             ("ISC", "ISC License\n\nCopyright (c) 2011, A\n\n" + isc), ("BSD-2-Clause", "BSD 2-Clause License\n\nCopyright (c) 2011, A\n\n" + bsd),
             ("Unlicense", "The Unlicense\n\n" + files["Unlicense"])]
    rows, want = [], {}
    for i, t in texts:
        for w in (50, 65, 72, 79, 100, None):
            if "Copyright (c) 2" in t or i in files and t == files[i]:
                forms = [reflowed(t, w)] if "Copyright (c) 2" in t else [t, reflowed(t, w)]
            else:
                forms = [reflowed(t, w), HOLDERS[w % 3 if w else 0] + "\n\n" + reflowed(t, w)]
            for x in forms:
                want[len(rows)] = i
                rows.append((len(rows), x))
    got = {r.doc_id: r.license for r in licenses.scan(make_docs(rows)).collect()}
    assert [(want[k], rows[k][1][:200]) for k in want if got[k] != want[k]] == []


def test_license_paragraphs(spark, make_docs):
    gpl = """# Copyright (C) 2020 Jane Doe
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
    apache = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law ...
 */
int main;"""
    rows = [(1, "code\n\n" + gpl + "\n#\n# This program is distributed\n\nmore code"), (2, apache), (3, gpl), (4, gpl + "\nmore"),
            (5, apache + "\n\n" + gpl), (6, "two\nlines\n\n\nof\nno licence")]
    got = {r.doc_id: (r.license, r.notices) for r in licenses.scan(make_docs(rows)).collect()}
    assert got == {1: (None, "GPL-3.0-or-later"), 2: (None, "Apache-2.0"), 3: ("GPL-3.0-or-later", "GPL-3.0-or-later"), 4: (None, ""),
                   5: (None, "Apache-2.0,GPL-3.0-or-later"), 6: (None, "")}


def test_token_counts_match_plain_recurrence(spark, make_docs, monkeypatch):
    scores = token_counts.read_scores()

    def brute(w):
        best = [(0.0, 0)]
        for i in range(1, len(w) + 1):
            n = len(w[i - 1].encode())
            c = (best[i - 1][0] + token_counts.BYTE_SCORE * n, best[i - 1][1] + n)
            for a in range(max(0, i - 40), i):
                s = scores.get(w[a:i])
                if s is not None and (best[a][0] + s, -best[a][1] - 1) > (c[0], -c[1]):
                    c = (best[a][0] + s, best[a][1] + 1)
            best.append(c)
        return best[-1][1]

    words = ["hello", "helloworld", "hellx", "Straße", "漢字", "e" * 200, "unbelievably", "x1y2", "\U0001f600", "the", "then", "them"]
    trie = token_counts.PieceTrie(scores)
    want = {"▁" + w: brute("▁" + w) for w in words}
    assert trie.counts(want) == want and trie.counts(want) == want
    small = token_counts.PieceTrie(scores, most=3)  # emptied again and again, counts stay
    for k in range(len(words)):
        assert small.counts(list(want)[:k]) == {w: want[w] for w in list(want)[:k]}
    docs = make_docs(odd_rows(8) + [(3000, " ".join(words))])
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, ["doc_id"]).collect()}
    assert got[1000].n_tokens == got[1001].n_pretokens == got[1002].n_tokens == 0
    assert got[3000].n_pretokens == len(words) and got[3000].n_tokens == sum(brute("▁" + w) for w in words)
    assert token_counts.count_tokens(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0
