"""Training-data pipeline over ``documents``: language ID, near-duplicates, decontamination, PII, packing."""

from __future__ import annotations

from moorspark.llm import decontaminate, language, packing, pii, simhash
from moorspark.llm.registry import bounded
from moorspark.session import materialize


def _bounded(stage):
    def run(spark, docs, sf_dir):
        return stage(bounded(spark), docs, sf_dir)

    return run


STAGES = [
    ("language", _bounded(language.stage)),
    ("near_duplicates", _bounded(simhash.stage)),
    ("decontamination", _bounded(decontaminate.stage)),
    ("pii", _bounded(pii.stage)),
    ("packing", _bounded(packing.stage)),
]

#: numpy stages, iteration and a trained model have no SQL form; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to the documents table; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
