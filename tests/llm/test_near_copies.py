"""The near-duplicate stage against Jaccard similarity in plain Python."""

import itertools

import brute
import numpy as np

from moorspark.llm import jaccard, simhash

VOCABULARY = [f"w{i}" for i in range(4000)]


def _shingles(text):
    w = brute.BLACK.findall(brute.lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def _rows():
    rng = np.random.default_rng(5)
    out = []
    for _ in range(60):
        base = rng.choice(VOCABULARY, int(rng.integers(30, 300))).tolist()
        out.append(base)
        for share in (0.0, 0.005, 0.01, 0.02, 0.03, 0.05):
            copy = list(base)
            for i in rng.choice(len(copy), max(1, int(share * len(copy))), replace=False).tolist() if share else ():
                copy[i] = "edited"
            out.append(copy)
    chain = rng.choice(VOCABULARY, 100).tolist()  # each alike its neighbours alone
    out += [chain[i : i + 90] for i in range(10)] + [[], ["a"], ["A"], ["a", "b"]]
    return [(i, " ".join(w)) for i, w in enumerate(out)]


def test_stage_keeps_one_of_each_group_at_jaccard_08(spark):
    rows = _rows()
    sets = {i: _shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    far = 0
    for a, b in itertools.combinations(sets, 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
            far += (brute.fingerprint(rows[a][1]) ^ brute.fingerprint(rows[b][1])).bit_count() > 2
    assert far > 50  # links op6's limit of two bits does not see
    docs = spark.createDataFrame([*rows, rows[0], (None, rows[1][1])], "doc_id long, text string").repartition(3)
    kept = [r.doc_id for r in simhash.stage(spark, docs, "").collect()]
    assert sorted(x for x in kept if x is not None) == sorted({find(i) for i in sets}) and kept.count(None) == 1


def test_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(6)
    base = rng.choice(VOCABULARY, 200).tolist()
    rows = [(i, " ".join([*base[: i % 190], f"x{i}", *base[i % 190 + 1 :]])) for i in range(400)]
    rows += [(1000 + i, " ".join([*base[:120], *rng.choice(VOCABULARY, 80)])) for i in range(40)]  # a common passage, else different
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.stage(spark, docs, "").collect()) == [0, *range(1000, 1040)]


def test_sketches_lose_no_pair():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base[:n], n - n // 12, False), rng.integers(0, 2**63, n // 15, dtype=np.uint64)])) for n in (12, 60, 300, 4000) for _ in range(8)] + [base[:0]]
    ptr = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    words = jaccard.parities(np.concatenate(sets), ptr).view(np.uint64)
    told_apart = 0
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            differ, apart = int(np.bitwise_count(words[i] ^ words[j]).sum()), len(np.setxor1d(x, y))
            assert differ <= apart and (apart - differ) % 2 == 0
            told_apart += 9 * differ > len(x) + len(y)
    assert told_apart > len(sets)


def test_fingerprint_links_propose_close_copies(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(60):
        base = rng.choice(VOCABULARY, 800).tolist()
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:400], "edited", *base[401:]]))]
    docs = spark.createDataFrame([*rows, (500, "")], "doc_id long, text string").repartition(2)
    sets = {r.s: r for r in jaccard._signatures(docs).collect()}
    of = {r.doc_id: r for r in sets.values()}
    alike = {tuple(sorted((of[2 * i].s, of[2 * i + 1].s))) for i in range(60) if ((of[2 * i].fp ^ of[2 * i + 1].fp) & (2**64 - 1)).bit_count() <= 2}
    got = {(r.a, r.b) for r in jaccard._fingerprint_pairs(spark.createDataFrame(list(sets.values()))).collect()}
    assert len(alike) > 20 and alike <= got
    assert not any(of[500].s in pair for pair in got)
