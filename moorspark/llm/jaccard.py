"""Near copies by Jaccard similarity of word shingles: SimHash links and MinHash bands propose, the shingle sets decide.

Two texts are linked if their sets of ``SHINGLE``-word shingles have a Jaccard similarity of ``ALIKE`` at least; groups are
the components of these links. Equal sets are one set from the start. Each distinct set has a SimHash fingerprint; the least
sets of fingerprints that deletion variants link (:mod:`moorspark.llm.variants`), and sets of one fingerprint with the least
of them, are pairs to verify. Two bits see most close copies but few pairs near 0.8 (they differ in some ten bits), so
MinHash bands propose the rest. Each distinct set is put under ``BANDS`` keys of
``ROWS`` minima each; a pair at 0.8 shares no key with probability (1 - 0.8^4)^28 = 4e-7. Within a key all sets are
compared with its least and greatest one; then, with the components of these links, only sets of different components,
so that a large group of near copies costs few comparisons per member and no pair that could join two groups is left out.
A pair is made only if its parity sketches allow it: each shingle flips one of ``BITS`` bits, so two sketches differ in no
more bits than the sets in shingles, and a pair at 0.8 differs in a ninth of both sizes at most. The test loses no pair, and
what passes it is nearly always a link. Shingles are 64-bit hashes; apart from their collisions every link is verified exactly.

Defined cases: a text of fewer words is one shingle; null, empty and blank texts have the same, empty set; rows with a
null doc_id belong to no group; repeated rows give repeated result rows; an empty table gives no rows.
"""

from __future__ import annotations

import operator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorspark.llm import lex
from moorspark.llm.components import connected_components
from moorspark.llm.variants import fingerprints, links
from moorspark.session import materialize

SHINGLE = 5
#: similarity as a fraction of whole numbers, so that comparisons are exact
ALIKE = (4, 5)
BANDS = 28
ROWS = 4
#: bits of a parity sketch
BITS = 512

_G = np.random.default_rng(20240611)
_XOR = _G.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_MUL = _G.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(buf: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document of a block, in order, and the first of each (and the end)."""
    w = lex.Words(buf, off, lex.BLACK)
    per = np.where(w.counts >= size, w.counts - size + 1, np.minimum(w.counts, 1))
    ptr = np.concatenate([[0], np.cumsum(per)])
    first = np.arange(ptr[-1]) - np.repeat(ptr[:-1], per) + np.repeat(w.ptr[:-1], per)
    end = first + np.repeat(np.minimum(w.counts, size), per)
    h = lex.Sums(lex.byte_sums(buf, True).span(w.start, w.end)).span(first, end)
    doc = np.repeat(np.arange(len(per)), per)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(per) + 1))


def set_ids(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lex.mix(h ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return lex.mix(c[ptr[1:]] - c[ptr[:-1]] + np.diff(ptr).astype(np.uint64))


def band_keys(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A row of ``BANDS`` keys per document; zeros for an empty set."""
    full = np.flatnonzero(np.diff(ptr))
    out = np.zeros((len(ptr) - 1, BANDS), np.uint64)
    for band in range(BANDS if len(full) else 0):
        key = np.zeros(len(full), np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = lex.mix(key + np.minimum.reduceat((h ^ _XOR[k]) * _MUL[k], ptr[full]))
        out[full, band] = key
    return out


def parities(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A row of ``BITS / 64`` words per document: bit b is the parity of its shingles that fall on b."""
    docs = len(ptr) - 1
    at = (lex.mix(h ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BITS)).astype(np.int64) + np.repeat(np.arange(docs), np.diff(ptr)) * BITS
    odd = np.bincount(at, minlength=docs * BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(docs, BITS), axis=1, bitorder="little").view(np.int64)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))


def _signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, s, n, fp, keys, odd``: set, its size, its fingerprint, its band keys and its parity sketch per row."""
    def run(batches):
        for batch in batches:
            for rows, buf, off in lex.blocks(batch):
                h, ptr = shingle_sets(buf, off)
                fp = fingerprints(lex.mix(h), ptr).view(np.int64)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(set_ids(h, ptr).view(np.int64)), pa.array(np.diff(ptr)), pa.array(fp), _lists(band_keys(h, ptr).view(np.int64)), _lists(parities(h, ptr))],
                                                 ["doc_id", "s", "n", "fp", "keys", "odd"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, s long, n long, fp long, keys array<long>, odd array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """``s, h``: set and its shingle hashes per row."""
    def run(batches):
        for batch in batches:
            for _, buf, off in lex.blocks(batch):
                h, ptr = shingle_sets(buf, off)
                yield pa.RecordBatch.from_arrays([pa.array(set_ids(h, ptr).view(np.int64)), pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(h.view(np.int64)))], ["s", "h"])

    return docs.select("text").mapInArrow(run, "s long, h array<long>")


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * ALIKE[1] >= F.greatest(a, b) * ALIKE[0]


def _parities_allow(x: str, y: str, sizes: Column) -> Column:
    """Whether sets with sketches ``x`` and ``y`` may be similar enough; ``sizes`` is the sum of their sizes."""
    differ = reduce(operator.add, [F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(BITS // 64)])
    return differ * sum(ALIKE) <= sizes * (ALIKE[1] - ALIKE[0])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough."""
    both = pairs.join(sets.select(F.col("s").alias("a"), F.col("h").alias("ha")), "a").join(sets.select(F.col("s").alias("b"), F.col("h").alias("hb")), "b")
    common = F.size(F.array_intersect("ha", "hb"))
    # common / (a + b - common) >= ALIKE
    return both.where(common * sum(ALIKE) >= (F.size("ha") + F.size("hb")) * ALIKE[0]).select("a", "b")


def _fingerprint_pairs(distinct: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of sets to verify: the least sets of linked fingerprints, and each set with the least one of its fingerprint."""
    full = distinct.where("n > 0").select("s", "fp")
    least = materialize(full.groupBy("fp").agg(F.min("s").alias("t")), "prints")
    same = full.join(least, "fp").where("s <> t").select("s", "t")
    near = links(least.select("fp")).join(least.select(F.col("fp").alias("a"), F.col("t").alias("s")), "a").join(least.select(F.col("fp").alias("b"), "t"), "b")
    return same.unionByName(near.select("s", "t")).select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """``doc_id, component_id`` of every row with a doc_id."""
    docs = docs.where("doc_id IS NOT NULL")
    rows = materialize(_signatures(docs), "signatures")
    distinct = materialize(rows.groupBy("s").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.max("fp").alias("fp"), F.max("keys").alias("keys"), F.max("odd").alias("odd")), "distinct")
    proposed = materialize(_fingerprint_pairs(distinct), "proposed")
    # size estimates do not see what explode adds, so the joins of exploded rows name their strategy
    bands = distinct.where("n > 0").select("s", "n", F.posexplode("keys").alias("slot", "key")).withColumn("slot", F.col("slot").cast("byte"))
    one = F.struct("s", "n")
    shared = bands.groupBy("slot", "key").agg(F.min(one).alias("lo"), F.max(one).alias("hi")).where("lo.s <> hi.s")
    met = materialize(bands.join(shared.hint("merge"), ["slot", "key"]), "bands")
    members = materialize(met.select("s").unionByName(proposed.select(F.explode(F.array("a", "b")).alias("s"))).distinct(), "members")
    wanted = materialize(members.join(distinct.select("s", "least"), "s").select(F.col("least").alias("doc_id")).distinct(), "wanted")
    sets = materialize(_sets(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")).join(members, "s", "left_semi").dropDuplicates(["s"]), "sets")
    pair = [F.least("s", "t.s").alias("a"), F.greatest("s", "t.s").alias("b")]
    sketch = materialize(distinct.select("s", "n", "odd").join(members, "s", "left_semi"), "sketches")
    stars = met.select("s", "n", F.explode(F.array("lo", "hi")).alias("t")).where(F.col("s") != F.col("t.s")).where(_sizes_allow(F.col("n"), F.col("t.n"))).select(*pair).unionByName(proposed).distinct()
    stars = stars.join(sketch.select(F.col("s").alias("a"), F.col("n").alias("na"), F.col("odd").alias("oa")), "a").join(sketch.select(F.col("s").alias("b"), F.col("n").alias("nb"), F.col("odd").alias("ob")), "b")
    stars = materialize(stars.where(_sizes_allow(F.col("na"), F.col("nb")) & _parities_allow("oa", "ob", F.col("na") + F.col("nb"))).select("a", "b"), "stars")
    near = materialize(_verified(stars, sets), "near")
    roots = connected_components(near)
    held = met.select("s", "n", "slot", "key").join(roots.withColumnRenamed("u", "s"), "s", "left").withColumn("root", F.coalesce("root", "s"))
    held = materialize(held, "held")
    mixed = held.groupBy("slot", "key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("c")).where("r0 <> r1 AND c > 2").select("slot", "key")
    open_ = materialize(held.join(mixed.hint("merge"), ["slot", "key"]).join(sketch.select("s", "odd"), "s"), "mixed")
    x, y = (open_.select("slot", "key", F.col("s").alias(a), F.col("n").alias(f"n{a}"), F.col("root").alias(f"r{a}"), F.col("odd").alias(f"o{a}")) for a in "ab")
    alike = _sizes_allow(F.col("na"), F.col("nb")) & _parities_allow("oa", "ob", F.col("na") + F.col("nb"))
    across = x.join(y.hint("merge"), ["slot", "key"]).where(F.col("a") < F.col("b")).where("ra <> rb").where(alike).select("a", "b").distinct()
    more = materialize(_verified(materialize(across.join(stars, ["a", "b"], "left_anti"), "across"), sets), "more")
    if not more.isEmpty():
        roots = connected_components(near.unionByName(more))
    member = distinct.select("s", "least").join(roots.withColumnRenamed("u", "s"), "s", "left").select("s", "least", F.coalesce("root", "s").alias("root"))
    named = materialize(member.join(member.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("s", "component_id"), "components")
    return rows.select("doc_id", "s").join(named, "s").select("doc_id", "component_id")
