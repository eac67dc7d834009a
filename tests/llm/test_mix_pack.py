"""Source mixing and token packing: SQL and brute force on odd rows, round trips."""

import duckdb
import numpy as np
import pytest
from conftest import DOCS, odd_rows

from carelake.llm import mixing, packing


def sql_rows(docs, sql):
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con.register("documents", documents)
    return con.execute(sql).fetchall()


def test_targets_reshare_the_excess():
    t = mixing.targets({"b": 10, "a": 1000, None: 100})
    assert [t[s][0] for s in ("a", "b", None)] == [0, 1, 2]
    assert t["b"][1] == 20.0 and t[None][1] == 200.0
    assert t["a"][1] == pytest.approx(1.5 * 1110 - 220)
    assert mixing.targets({}) == {} and mixing.targets({"a": 0})["a"] == (0, 0.0)


def test_mix_matches_sql_and_targets(spark, make_docs):
    docs = make_docs([r for r in odd_rows(90) if r[0] != 5])
    got = sorted((tuple(r) for r in mixing.taken(docs).collect()), key=str)
    want = sorted(sql_rows(docs, mixing.ORACLE), key=str)
    assert got == want
    assert sum(r[4] for r in got) <= sum(r[1] for r in got) * 3 // 2
    assert all(r[4] in (0, r[1], 2 * r[1]) for r in got)


def test_mix_emits_whole_copies(spark, make_docs):
    docs = make_docs(odd_rows(40))
    taken = mixing.taken(docs).selectExpr("sum(case when size > 0 then taken / size end)").first()[0]
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() == taken
    texts = {r.text for r in docs.collect()}
    assert {r.text for r in out.collect()} <= texts


def test_mix_zoom_agrees_with_one_pass(make_docs, monkeypatch):
    docs = make_docs([(i, "w " * (i % 17 + 1), "en", f"s{i % 5}") for i in range(400)])
    want = sorted(map(tuple, mixing.taken(docs).collect()))
    monkeypatch.setattr(mixing, "LAST_ROWS", 3)
    monkeypatch.setattr(mixing, "ZOOM_BINS", 4)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    assert sorted(map(tuple, mixing.taken(docs).collect())) == want


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert mixing.taken(none).count() == 0 and mixing.mix(none).count() == 0


@pytest.mark.parametrize("row", [1, 2, 7, 64, 100])
def test_best_fit_decreasing_is_best_fit(row):
    rng = np.random.default_rng(row)
    lengths = rng.integers(1, row + 1, 300).tolist()
    rows = packing.best_fit_decreasing(lengths, row)
    assert sorted(i for r in rows for i in r) == list(range(300))
    free = []  # the same rule by looking at every row
    for n in sorted(lengths, reverse=True):
        fits = [i for i, c in enumerate(free) if c >= n]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= n
        else:
            free.append(row - n)
    assert sorted(row - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def test_pack_round_trip(spark, make_docs):
    rows = odd_rows(30) + [(2000, " " * 30_000 + "y" * 70_000 + "\n" * 12_000)]
    docs = make_docs([(i, *r[1:]) for i, r in enumerate(rows)])
    packs = packing.pack(docs, row_tokens=256, block_tokens=5_000)
    ranks = packing.read_ranks()
    enc, back = packing.Encoder(ranks), {v: k for k, v in ranks.items()}
    got = {}
    for r in packing.unpack(packs).collect():
        got.setdefault(r.doc_id, {})[r.part] = r.ids
    for r in docs.collect():
        parts = got.pop(r.doc_id, {})
        assert sorted(parts) == list(range(len(parts)))
        ids = [x for k in sorted(parts) for x in parts[k]]
        assert ids == enc.ids(r.text).tolist()
        assert b"".join(back[x] for x in ids[:-1]).decode() == (r.text or "")
    assert not got
    for p in packs.collect():
        assert len(p.ids) == 512 and p.cu_seqlens[0] == 0 and p.cu_seqlens[-1] == p.n_tokens <= 256
        assert p.position_resets[:len(p.doc_ids)] == p.cu_seqlens[:-1]
        assert p.starts == [256 * k for k in p.parts]


def test_pack_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("text", ["abc1" * 6_000, "x" * 30_000 + "1" * 30_000, "漢" * 25_000 + "!?" * 9_000, "a  b" + " " * 6_000, " \n" * 4_000 + "end",
                                  "w" + "\t" * 7_000 + " it's" + "\u3000" * 5_001, "\x1f" * 6_000 + " \x1c " * 3_000 + "x", " " * 5_000 + "'s" + "\n" * 5_000])
def test_long_runs_keep_the_tokenizers_ids(text):
    import tiktoken
    ranks = packing.read_ranks()
    plain = tiktoken.Encoding("plain", pat_str=packing.SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text)
    enc = packing.Encoder(ranks)
    assert enc.ids(text).tolist() == [*plain, enc.end]


def test_blanks_beyond_the_splitters_depth():
    enc = packing.Encoder(packing.read_ranks())
    back = {v: k for k, v in packing.read_ranks().items()}
    text = "a" + " " * 3_000_000 + "b" + "\n" * 3_000_000
    assert b"".join(back[i] for i in enc.ids(text)[:-1].tolist()) == text.encode()


def test_null_ids_are_shuffled_by_text(spark, make_docs):
    """Rows without an id spread over the buckets; the result equals the plain cumulative sum in hash order."""
    rows = [(None, f"text {i} " + "w " * (i % 9), "en", f"s{i % 2}") for i in range(300)] + [(i, "t " * (i % 7), "en", "s0") for i in range(100)]
    docs = make_docs(rows)
    times, budget = mixing.finish_times(docs)
    got = times.collect()
    assert len({r.h for r in got}) > 390 and min(r.h for r in got) >= 0
    for si in (0, 1):
        total = 0
        for r in sorted((r for r in got if r.si == si), key=lambda r: r.h):
            total += r.size
            assert r.done == total
