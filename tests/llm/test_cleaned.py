"""The texts op7 leaves against plain Python."""

import collections

import brute
from pyspark.sql import functions as F
from test_operators import SCHEMA, _texts

from moorspark.llm import quality


def _norm(line):
    return " ".join(brute.BLACK.findall(brute.lower(line)))


def test_texts_lose_their_boilerplate_lines_and_no_other(spark):
    foot = "common footer line of this host"
    texts = [*_texts(), f"a\n\n{foot}", f"\n{foot}\n", f"{foot}\n\n\né {foot}\n{foot.upper()}  ", f"{foot}\n{foot}", f"{foot}\r\nend\n", f"own words\n{foot}\n\t\n"]
    rows = [(i, t, "h" if i % 7 else None) for i, t in enumerate(texts)]
    rows += [rows[-1], rows[-1], (None, f"x\n{foot}", "h"), (None, f"x\n{foot}", "h"), (900, foot, None), (901, None, foot)]
    held, size = collections.defaultdict(set), collections.defaultdict(set)
    for k, (i, t, host) in enumerate(rows):
        own = ("null", k) if i is None else i
        size[host].add(own)
        for line in (t or "").split("\n"):
            if _norm(line):
                held[host, _norm(line)].add(own)
    bad = {x for x, d in held.items() if len(d) > 20 and len(d) > 0.005 * len(size[x[0]])}
    want = collections.Counter((i, None if t is None else "\n".join(x for x in t.split("\n") if (host, _norm(x)) not in bad)) for i, t, host in rows)
    docs = spark.createDataFrame([(i, t, None, s, None, *["x"] * 12) for i, t, s in rows], SCHEMA).repartition(3)
    out = quality.cleaned(docs).collect()
    assert collections.Counter((r.doc_id, r.text) for r in out) == want
    assert sum(r.n_boilerplate_chars > 0 for r in out) > 25
    whole = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in out:
        if r.doc_id is not None:
            assert r.n_boilerplate_chars == sum(len("".join(brute.BLACK.findall(x))) * n for x, n in ((whole[r.doc_id], 1), (r.text or "", -1)))


def test_the_limit_of_a_line_does_not_grow_with_its_host(spark):
    """Line -1 is in 21 documents of a large and of a small host, line -2 in 20 of each."""
    i = F.col("id")
    host = F.when(i < 20_000, "large").otherwise("small")
    place = F.when(i < 20_000, i).otherwise(i - 20_000)
    lines = F.filter(F.array(i, F.when(place < 21, -1), F.when(place < 20, -2)), lambda x: x.isNotNull())
    rows = spark.range(20_030).select(i.alias("uid"), i.alias("content"), i.alias("doc_id"), host.alias("source"), lines.alias("lines"))
    assert sorted(tuple(r) for r in quality.boilerplate(rows).collect()) == [("=large", -1), ("=small", -1)]
