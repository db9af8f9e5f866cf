"""SimHash near-duplicates by deletion variants (:mod:`moorspark.llm.variants`), and the pipeline's stage.

Defined cases: a null, empty or blank text has fingerprint 0 and links like any other; repeated rows give repeated
result rows; a null doc_id keeps its row and never becomes a component's id unless nothing else is there; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.llm import jaccard, lex
from moorspark.llm.components import connected_components
from moorspark.llm.registry import documents, query
from moorspark.llm.variants import DENSE, fingerprints, links
from moorspark.session import materialize

SHINGLE = 3
SEED = 42

_BLANK = bytes(0x20 if i in (0x20, *range(0x09, 0x0E)) else int(lex.lower_bytes(np.array([i], np.uint8))[0]) for i in range(256))


def shingle_hashes(buf: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every word shingle of a block and the first shingle of each document (and the end)."""
    w = lex.Words(buf, off, lex.BLACK)
    text = buf.tobytes().translate(_BLANK)
    per = np.where(w.counts >= size, w.counts - size + 1, np.minimum(w.counts, 1))
    ptr = np.concatenate([[0], np.cumsum(per)])
    first = np.arange(ptr[-1]) - np.repeat(ptr[:-1], per) + np.repeat(w.ptr[:-1], per)
    last = np.repeat(np.where(w.counts >= size, size, w.counts), per) + first - 1
    a, b = w.start[first], w.end[last]
    hash_ = xxhash.xxh64_intdigest
    out = np.fromiter((hash_(text[i:j], SEED) for i, j in zip(a.tolist(), b.tolist(), strict=True)), np.uint64, len(a))
    # a blank run longer than one character inside a shingle: join its words by single blanks
    wide = np.concatenate([[0], np.cumsum(w.start[1:] - w.end[:-1] > 1)]) if len(w.start) else np.zeros(1, np.int64)
    for i in np.flatnonzero(wide[last] > wide[first]).tolist() if len(first) else ():
        out[i] = hash_(b" ".join(text[a[i] : b[i]].split()), SEED)
    return out, ptr


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) per row."""
    def run(batches):
        for batch in batches:
            for rows, buf, off in lex.blocks(batch):
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(fingerprints(*shingle_hashes(buf, off)).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {dict(docs.dtypes)[key]}, fp long")


def group(prints: DataFrame, dense: int = DENSE) -> DataFrame:
    """``doc_id, fp, component_id`` per row of ``doc_id, fp`` (a stored table: it is read three times)."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = connected_components(links(distinct.select("fp"), dense))
    member = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(member.join(of_root, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, dense: int = DENSE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint and component of every document."""
    return group(materialize(fingerprint(docs, key, text), "simhash"), dense)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the least doc_id; of repeated rows with that id one stays.

    Groups are those of :mod:`moorspark.llm.jaccard` (five words, similarity 0.8, fingerprint links first); op6's contract values bind op6 alone. Rows with a null doc_id cannot be told apart by id and stay.
    """
    found = materialize(jaccard.near_copies(docs), "groups")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    many = materialize(found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    once = docs.join(gone.unionByName(many), "doc_id", "left_anti")
    if not many.isEmpty():
        once = once.unionByName(docs.join(many, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return once.select(*docs.columns)


@query("op6_deletion_variant_simhash")
def op6(spark, sf_dir):
    """Fingerprint and component of all documents."""
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
