"""SimHash fingerprints and their links by deletion variants.

Fingerprints within two bits agree, in one of two 32-bit segments, up to one bit. So each distinct fingerprint is
indexed under 64 variants: either segment with one of its 32 bits wildcarded. Equal variants are joined and the whole
fingerprints verified. A variant that more than ``DENSE`` distinct fingerprints share is not expanded into pairs; there
each fingerprint and its 64 one-bit neighbours meet at equal points instead: two fingerprints are within two bits if and
only if they share such a point, and everyone at a point is linked to the least one. Both ways are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.session import materialize

#: distinct fingerprints under one variant up to which they are compared pairwise
DENSE = 16


def fingerprints(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Per document the bits set in over half its hashes."""
    out = np.zeros(len(ptr) - 1, np.uint64)
    n = np.diff(ptr)
    full = np.flatnonzero(n)
    step = 1 << 16  # bounds the table of bits
    ones = np.zeros((len(n), 64), np.int64)
    for a in range(0, len(hashes), step):
        part = hashes[a : a + step]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        lo, hi = np.searchsorted(ptr[full + 1], a, "right"), np.searchsorted(ptr[full], a + len(part), "left")
        own = full[lo:hi]
        ones[own] += np.add.reduceat(bits, np.maximum(ptr[own] - a, 0), axis=0, dtype=np.int64)
    if len(full):
        out[full] = np.packbits(2 * ones[full] > n[full, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _variants(fps: DataFrame) -> DataFrame:
    """``fp, seg, bit, rest`` for either segment and each wildcarded bit."""
    cut = F.explode(F.array(*[F.struct(F.lit(s).alias("seg"), (F.shiftrightunsigned("fp", 32 * s).bitwiseAND(F.lit(0xFFFFFFFF))).alias("value")) for s in (0, 1)]))
    one = fps.select("fp", cut.alias("s")).select("fp", "s.seg", "s.value", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit"))
    return one.select("fp", F.expr("seg * 32 + bit").cast("byte").alias("slot"), F.expr("value & ~shiftleft(1L, bit)").alias("rest"))


def links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """``a, b``: links of distinct fingerprints whose components are those of all links within two bits."""
    # size estimates do not see what explode adds, so the joins of exploded rows name their strategy
    v = _variants(fps)
    shared = v.groupBy("slot", "rest").agg(F.count("*").alias("n")).where("n > 1")
    met = materialize(v.join(shared.hint("merge"), ["slot", "rest"]), "variants")
    few = met.where(F.col("n") <= dense)
    pairs = (few.select("slot", "rest", F.col("fp").alias("a")).join(few.select("slot", "rest", F.col("fp").alias("b")), ["slot", "rest"])
             .where("a < b AND bit_count(a ^ b) <= 2").select("a", "b").distinct())
    crowd = met.where(F.col("n") > dense).select("fp").distinct()
    points = crowd.select("fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("m"), F.count("*").alias("n")).where("n > 1").select("point", "m")
    hubs = points.join(least.hint("merge"), "point").where("fp <> m").select(F.col("m").alias("a"), F.col("fp").alias("b")).distinct()
    return pairs.unionByName(hubs)
