"""Pieces of a bucket's strings for the suffix arrays of operator 1."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from moorspark.llm import lex, repeats
from moorspark.session import materialize


@pytest.mark.parametrize("n", [1, 2, 50, 500])
def test_pieces_keep_equal_keys_together(monkeypatch, n):
    monkeypatch.setattr(repeats, "ARRAY", 200)
    rng = np.random.default_rng(n)
    key, size = np.sort(rng.integers(0, max(1, n // 3), n)), rng.integers(50, 77, n)
    out = repeats._pieces(key, size)
    assert out[0][0] == 0 and out[-1][1] == n
    assert all(a[1] == b[0] for a, b in zip(out, out[1:], strict=False))
    assert all(key[y - 1] != key[y] for _, y in out[:-1])
    assert all(size[x:y].sum() <= 200 or len(set(key[x:y])) == 1 for x, y in out)


@pytest.mark.parametrize("prefix", [1, 60, 1 << 10, 1 << 20])
def test_hashes_of_strings_do_not_depend_on_the_pieces(monkeypatch, prefix):
    monkeypatch.setattr(repeats, "PREFIX", prefix)
    rng = np.random.default_rng(prefix)
    length = rng.integers(50, 77, 300)
    text = rng.integers(0, 256, length.sum()).astype(np.uint8)
    place = rng.integers(0, 27, 300) % (length - repeats.K + 1)
    at = np.cumsum(length) - length
    sums = lex.byte_sums(text, False)
    mini, whole = repeats.hashes(text, length, place)
    assert (mini == sums.span(at + place, at + place + repeats.K)).all()
    assert (whole == sums.span(at, at + length)).all()


def test_hashes_of_a_large_bucket_take_little_memory():
    length = np.full(80_000, 60)
    text = np.zeros(length.sum(), np.uint8)
    repeats.hashes(text[:6000], length[:100], np.zeros(100, np.int64))  # fills the cache of powers
    tracemalloc.start()
    repeats.hashes(text, length, np.zeros(len(length), np.int64))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 4 * len(text)


def test_units_are_dealt_evenly(spark):
    units = spark.createDataFrame([(u,) for u in repeats.unit_numbers(spark, 13, 3)], "unit long")
    parts = units.repartition(13, "unit").groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert len(parts) == 13 and all(r["count"] == 3 for r in parts)


def test_lists_are_sent_by_units_of_many_shards(spark, monkeypatch):
    """40 shards of the same text lie in as many units as there are shuffle partitions: four lists and strings a bucket."""
    monkeypatch.setattr(repeats, "SHARD", 1 << 12)
    seen = {}
    for step in ("minimizers", "strings"):
        def counted(*args, real=getattr(repeats, step), step=step):
            out = materialize(real(*args), step)
            rows = out.where("bucket >= 0").groupBy("bucket").count()
            seen[step] = rows.agg(F.max("count")).first()[0]
            return out

        monkeypatch.setattr(repeats, step, counted)
    text = "".join(np.random.default_rng(5).choice(list("abcdefgh"), 4000))
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string").coalesce(1)
    out = repeats.clean(docs).collect()
    assert {(r.doc_id == 0, r.n_removed) for r in out} == {(True, 0), (False, 4000)} and len(out) == 40
    assert seen == {"minimizers": 4, "strings": 4}
