"""Registry of the queries of this folder and their SQL restatements."""

from __future__ import annotations

import importlib

from moorspark.llm.registry import ORACLES, QUERIES

_MODULES = ["shard", "simhash", "language", "tokenfile", "packing", "decontaminate", "quality", "licence", "pii", "repeats", "topk", "importance", "conversation"]


def load():
    """Import every operator module; returns ``(queries, oracles)``."""
    for m in _MODULES:
        importlib.import_module(f"moorspark.llm.{m}")
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
    return QUERIES, ORACLES
