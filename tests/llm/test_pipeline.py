"""The pipeline's stages, each on all its predecessor kept, against plain restatements."""

import collections

import brute
import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_operators import DE, EN, PASSAGE, SCHEMA, _texts
from tokenizers import Tokenizer

from moorspark.llm import decontaminate, language, pii
from moorspark.llm.queries import load
from moorspark.session import materialize


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    texts = _texts()
    rows = [(i, t, None if i % 11 == 3 else "de" if t and "ü" in t else "en", "h" if i % 7 else None, None if t is None else len(t), *["x"] * 12) for i, t in enumerate(texts)]
    rows += [rows[40], rows[40], rows[3]]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE), (2, None), (3, EN[:90])], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        after = docs.collect()
        ids = collections.Counter(r.doc_id for r in after)
        if name == "language":
            kept = [r for r in before if any(c.isalpha() for c in r.text or "")]
            assert {r.doc_id for r in after} <= {r.doc_id for r in kept}
            prose = [r for r in kept if len(set(r.text.split()) & set((EN + " " + DE).split())) > 15]
            assert len(prose) > 30 and {r.doc_id for r in prose} <= set(ids)
            assert set(after) <= set(before)
        elif name == "near_duplicates":
            least = brute.alike([(r.doc_id, r.text) for r in before])
            assert ids == collections.Counter({c: 1 for c in least.values()}) and set(after) <= set(before)
        elif name == "decontamination":
            hit = {r[0] for r in brute.leaks([(r.doc_id, r.text) for r in before], items) if r[5]}
            assert hit and collections.Counter(r for r in before if r.doc_id not in hit) == collections.Counter(after)
        elif name == "pii":
            old = {r.doc_id: r for r in before}
            assert set(ids) == set(old) and any("[EMAIL]" in r.text for r in after) and any("[SECRET]" in r.text or "[CARD]" in r.text for r in after)
            for r in after:
                assert not any(brute.personal(r.text)[:4]), r.text
                same = r.text == old[r.doc_id].text
                assert same == (r == old[r.doc_id]) and (same or r.n_chars == len(r.text))
        else:
            coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            want = collections.Counter()
            for r in before:
                x = coder.encode(r.text, add_special_tokens=False).ids + [0]
                want.update((r.doc_id, a // 2048, a, len(x[a: a + 2048]), brute.crc_ids(x[a: a + 2048])) for a in range(0, len(x), 2048))
            assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after) == want
            break
        assert docs.columns == columns
        before = after


def test_run_equals_the_stages_and_every_query_is_registered(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 20
    names = set(load()[0])
    assert {n.split("_")[0] for n in names} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


def test_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0


def test_clashing_columns_survive(spark, sf_dir):
    rows = [(i, f"{EN} number {i}", "en", "s", None, "a", "b", "c") for i in range(6)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _language string, _contaminated string, _base string")
    for stage in (language.stage, decontaminate.stage, pii.stage):
        out = stage(spark, d, sf_dir)
        assert out.columns == d.columns
        assert {(r._language, r._contaminated, r._base) for r in out.collect()} <= {("a", "b", "c")}
    assert d.where(F.col("lang") == "en").count() == 6
