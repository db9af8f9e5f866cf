"""Operators 11 to 13 against their plain restatements."""

import collections
import itertools
import random
import zlib

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from moorspark.llm import conversation, importance, lex, numbering, topk
from moorspark.llm.queries import load

VECTORS = "vec_id long, embedding array<float>, label int, position long, rank string, score string, query_id string, k string, v string"
TALK = "conv_id long, turn long, role string, text string, kind string, digest string, signature string, audit string, gone string, first string"


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


def vectors(n=700, d=40):
    g = np.random.default_rng(3)
    centres = g.normal(size=(5, d))
    rows = [(i, [float(x) for x in (centres[i % 5] + g.normal(size=d) * 0.5).astype(np.float32)]) for i in range(n)]
    same = rows[0][1]
    rows += [(n + i, same) for i in range(300)]  # ties of many equal vectors
    rows += [rows[50], rows[50], rows[7], (50, [0.0] * d), (100, None), (None, same), (150, [1.0] * (d - 1) + [None]), (200, [float("nan")] + [1.0] * (d - 1)), (250, [float("inf")] * d)]
    rows += [(2000 + i, [float(i)] * 3) for i in range(4)] + [(2050, [0.5, -0.25, 0.001]), (2100, []), (2101, []), (2150, [3e30] * d)]
    return rows


def test_top_k_equals_all_scores(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, 2, *["clash"] * 5) for r in rows], VECTORS).repartition(5)
    usable = [(i, None if v is not None and max(map(abs, (x or 0 for x in v)), default=0) > 1e20 else v) for i, v in rows]
    want = collections.Counter(brute.nearest(usable))
    assert counted(topk.top_k(df, df.where("vec_id % 50 = 0"))) == want
    # small blocks of queries, one pass each, give the same
    assert counted(topk.top_k(df, df.where("vec_id % 50 = 0"), block_bytes=8 * 40 * 4)) == want


@pytest.mark.parametrize("scale", [1, 1 << 12, 1 << 20])
def test_pruning_and_whole_numbers(scale, monkeypatch):
    g = np.random.default_rng(5)
    q, v = (np.floor(g.normal(size=(n, 70)) * 30 * np.geomspace(8, 0.01, 70)) * scale for n in (40, 3000))
    best = topk.Best(np.arange(40), q, 5)
    calls = []
    monkeypatch.setattr(topk.np, "einsum", lambda *a, f=np.einsum: calls.append(1) or f(*a))
    for a in range(0, 3000, 500):
        best.offer(np.arange(100 + a, 600 + a)[::-1].copy(), v[a : a + 500])
    exact = [[sum(int(x) * int(y) for x, y in zip(r, w)) for w in v] for r in q]
    ids = np.concatenate([np.arange(100 + a, 600 + a)[::-1] for a in range(0, 3000, 500)])
    for n in range(40):
        near = sorted(zip([-x for x in exact[n]], ids.tolist()))[:5]
        assert [(-int(s), int(i)) for s, i in zip(best.score[n], best.found[n])] == near
    assert bool(calls) == (scale < 1 << 20)  # long vectors take the path in whole numbers


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], VECTORS)
    assert topk.top_k(df, df).collect() == []
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, one).collect() == []


def test_spans_hash_and_intern():
    words = [b"a", b"abcd", b"abcdefgh", b"abcdefghi", b"x" * 31, b"x" * 32, b"y" * 100, "größe".encode(), b"abcdefgh", b"a", b"x" * 31]
    data = np.frombuffer(b" ".join(words), np.uint8)
    start = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])[:-1]
    spans = importance.Spans(data, start, np.array([len(w) for w in words]))
    assert spans.keys().tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    # all keys equal: the bytes alone tell spans apart
    for keys in (None, np.zeros(len(words), np.uint64)):
        t = importance.Interned(spans, keys)
        assert [t.count[s] for s in t.slot] == [words.count(w) for w in words]
        assert len(set(t.slot.tolist())) == len(set(words))
        assert [t.buckets(spans, 97)[s] for s in t.slot] == [zlib.crc32(w) % 97 for w in words]


@pytest.mark.parametrize("run", [1, 3])
def test_resampling_equals_brute_force(spark, run):
    rng = random.Random(4)
    vocabulary = ["alpha", "Beta", "gamma", "ÄRGER", "ärger", "x1", "tension", "w" * 40, "W" * 40, "delta"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 5, 19, 20, 60])))) for i in range(300)]
    docs += [docs[1], docs[1], (None, docs[2][1] + " alpha" * 30), (400, None), (401, "  ... "), (402, "alpha,beta--gamma " * 3000), (5, "alpha beta " * 20), (403, "")]
    items = [(1, "alpha beta gamma alpha"), (2, None), (3, "Delta x1 " * 9)]
    schema = "doc_id long, text string, bucket string, n string, score string, rank string, position string, __at string, n_words string"
    d = spark.createDataFrame([(*r, *["c"] * 7) for r in docs], schema).repartition(4)
    b = spark.createDataFrame([(*r, "c") for r in items], "item_id long, text string, bucket string")
    assert counted(importance.resample(d, b, run).drop("n_words")) == collections.Counter(brute.resampled(docs, items, run))


def test_resampling_of_nothing(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(d, b).collect() == []
    some = spark.createDataFrame([(i, "word " * (i + 15)) for i in range(10)], "doc_id long, text string")
    got = importance.resample(some, b).drop("n_words")
    assert counted(got) == collections.Counter(brute.resampled([(i, "word " * (i + 15)) for i in range(10)], []))


def test_positions_are_those_of_a_global_sort(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x")).repartition(7)
    got = {r.x: r.position for r in numbering.numbered(df, [F.col("x").desc()]).collect()}
    assert got == {x: i for i, x in enumerate(sorted(got, reverse=True))}


def test_audits_equal_an_exhaustive_search():
    trie = conversation.Suffixes()
    strings = sorted("".join(x)[::-1] for n in range(6) for x in itertools.product("xsuaUAo", repeat=n))
    for back in strings[::7] + ["a" * 9, "ua" * 5, "Oxsux"[::-1]]:
        rows = [(x.lower() if x.lower() in "sua" else "-", x == "x", x.isupper()) for x in back[::-1]]
        assert trie.read(back) == brute.mended(rows)[:2], back[::-1]


def test_long_conversations_share_suffixes():
    trie = conversation.Suffixes()
    a, b = "ua" * 200_000, "sU" + "ua" * 200_000
    for s in (a, b):
        cost, audit = trie.read(s[::-1])
        assert len(audit) >= len(s) and cost <= 9
    assert len(trie.classes) < 50 and len(trie.node) == len(b) + 1


def talk():
    rng = random.Random(9)
    texts = ["Hello there.", "No end", "", " \t", "Why?", "Again!", "trailing  \n", "x. \x0b", None, "Ünïcode…"]
    rows = []
    for c in range(150):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t + (t > 4) * rng.randint(0, 2), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "unknown"]), rng.choice(texts)))
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for c in (500, None) for t in range(7)]
    rows += [(501, None, "user", "Hi."), (501, None, "assistant", "Ho."), (501, 0, "user", "Hi."), (502, 3, "user", "tie."), (502, 3, "user", "tie."), (502, 3, "assistant", "other"), (503, -4, "user", "a."), (503, 9, "assistant", "b.")]
    rows += [(c, t, "user", "Once.") for c in range(600, 620) for t in range(90) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:20]  # nothing is left of them
    rows += [(504, t, "assistant", "same.") for t in range(400)]
    return rows


def test_conversations_equal_brute_force(spark):
    rows = talk()
    df = spark.createDataFrame([(*r, *["c"] * 6) for r in rows], TALK).repartition(5)
    want = collections.Counter(brute.conversations([r for r in rows if r[0] != 504]))
    got = conversation.repair(conversation.damaged(df))
    assert counted(got.where("conv_id IS NULL OR conv_id <> 504")) == want
    (long_,) = got.where("conv_id = 504").collect()
    assert long_.duplicate > 350 and len(long_.audit) >= 360 and long_.gaps > 5
    gone = {c for c, *_ in rows} - {c for c, t, *_ in rows if zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20}
    assert gone and all(r.audit == "" and r.cost == 0 for r in got.where(F.col("conv_id").isin(list(gone))).collect())


def test_repaired_rows_keep_to_the_grammar(spark):
    d = conversation.damaged(spark.createDataFrame(talk(), "conv_id long, turn long, role string, text string"))
    told = collections.defaultdict(str)
    for r in conversation.repaired(d, conversation.plan(d)).collect():
        told[r.conv_id] += r.role[:1]
    assert len(told) > 100 and all(brute.re.fullmatch("s?(ua)+", x) for x in told.values())


def test_no_conversations(spark):
    assert conversation.repair(conversation.damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).collect() == []


@pytest.mark.parametrize("name", ["op11_columnar_bound_topk", "op12_interned_importance_resampling", "op13_suffix_dawg_conversations"])
def test_queries_read_whole_tables(spark, tmp_path, name):
    docs = [(i, f"word{i} " * 25) for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "word3 word4")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    vecs = [(i, [float(i % 7), 0.5, -float(i % 3)]) for i in range(120)]
    spark.createDataFrame(vecs, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame(talk()[:300], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    want = {"op11": brute.nearest(vecs), "op12": brute.resampled(docs, [(1, "word3 word4")]), "op13": brute.conversations(talk()[:300])}[name.split("_")[0]]
    assert counted(load()[0][name](spark, str(tmp_path))) == collections.Counter(want)
