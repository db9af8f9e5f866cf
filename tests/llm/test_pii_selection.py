"""Credentials without digits, and chains of overlapping spans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from moorspark.llm import pii


def test_a_credential_of_letters_needs_no_digit_elsewhere(spark):
    d = spark.createDataFrame([(i, f"words here token = {'abcdefghij' * 2}{chr(97 + i % 26) * 12} end") for i in range(60)], "doc_id long, text string")
    assert all(r.n == 1 for r in d.select(F.size(pii.candidates(F.col("text"))).alias("n")).collect())
    out = pii.all_spans(d, pii.fit(d), "text", "base", "found").select(pii._joined("found").alias("s")).collect()
    assert all(r.s == "secret:19:51" for r in out)


@pytest.mark.parametrize("n", [1, 3, 5])
def test_a_rare_credential_is_found_like_a_common_one(spark, n):
    d = spark.createDataFrame([(i, f"words here token = {'abcdefghij' * 2}{chr(97 + i) * 12} end") for i in range(n)] + [(9, "a plain text")], "doc_id long, text string")
    out = pii.stage(spark, d, "").orderBy("doc_id").collect()
    assert [r.text for r in out] == ["words here token = [SECRET] end"] * n + ["a plain text"]


def test_a_rare_combination_undoes_no_threshold():
    """Numbers with the bits 1 are personal data 40 times of 40; one with the bits 3, which score as high or higher, is not."""
    common = [("number", 1, 40, 40), ("number", 0, 60, 0)]
    low = pii.Boosted(common).threshold["number"]
    model = pii.Boosted([*common, ("number", 3, 1, 0)])
    assert model.threshold.keys() == {"number"} and abs(model.threshold["number"] - low) < 1
    assert "number" not in pii.Boosted([("number", 1, 3, 1), ("number", 0, 2, 0)]).threshold


class _Scores:
    """Higher for an address than for a number, between them for a secret: A (number) < B (secret) < C (address)."""

    threshold = {"any": 0.0}

    def score(self, code, kind):
        return F.when(kind == "number", 0.1).when(kind == "secret", 0.2).otherwise(0.3)

    def selected(self, code, kind, score):
        return F.lit(True)


def test_a_beaten_span_suppresses_none(spark):
    # number 0:12 overlaps secret 7:30, which overlaps address 29:32; number and address do not overlap
    spans = [(0, 4, "number", 12), (7, 5, "secret", 30), (29, 6, "address", 32), (40, 4, "number", 50)]
    d = spark.createDataFrame([(1, "x" * 60)], "doc_id long, text string")
    made = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(o).alias("ord"), F.lit(k).alias("kind"), F.lit(b).alias("end"), F.lit(0).alias("code"), F.lit(True).alias("good")) for a, o, k, b in spans])
    real, pii.candidates = pii.candidates, lambda text: made
    try:
        out = pii.all_spans(d, _Scores(), "text", "base", "found").select(pii._joined("found").alias("s")).first().s
    finally:
        pii.candidates = real
    assert out == "number:0:12,address:29:32,number:40:50"


def test_texts_are_searched_once_for_training_and_selection(spark, monkeypatch):
    calls = []
    real = pii.candidates
    monkeypatch.setattr(pii, "candidates", lambda text: calls.append(text) or real(text))
    out = pii.op8(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1 and not any("documents.parquet" in x for x in out.inputFiles())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    twice = pii.all_spans(docs, pii.fit(docs), "text", "base", "found").select("doc_id", pii._joined("found").alias("spans"))
    assert sorted(map(tuple, out.select("doc_id", "spans").collect())) == sorted(map(tuple, twice.collect()))


def test_no_text_with_a_match_is_passed_over(spark):
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(list(alphabet), 60)) for alphabet in ("0123456789 -", "01.a ", "ab1+-_/ \n", "a@.b ", "+1 ()-.", "aé_-/\t ", "4 1 ") for _ in range(60)]
    texts += ["x" * 20, "x" * 19, "é" * 30, "a\n" + "k" * 25 + "\tb", "ü" + "k" * 20, "1.2.3.4", "4111 1111 1111 1111", "(030) 1234", ""]
    d = spark.createDataFrame([(x,) for x in texts], "text string")
    for kind, pattern in [*pii.BASE.items(), *pii.GENERATORS.items()]:
        every = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        if kind == "card":
            every = F.filter(every, lambda x: pii._passes("card", x))
        found = F.transform(F.filter(pii._matches(F.col("text"), kind, 0, pattern), lambda x: (F.lit(kind) != "card") | pii._passes("card", x["text"])), lambda x: x["text"])
        rows = d.select(every.alias("a"), found.alias("b")).collect()
        assert all(r.a == r.b for r in rows) and any(r.a for r in rows), kind
