"""Connected components of an edge table by alternating star contraction; no neighbour list is ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.session import materialize


def _least(sym: DataFrame) -> DataFrame:
    return sym.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour goes to the least of the node and its neighbours."""
    sym = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = _least(sym).select("u", F.least("u", "m").alias("m"))
    return sym.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Every smaller neighbour and the node itself go to the least of them; ``u > v`` in every row of ``e``."""
    m = _least(e)
    joined = e.join(m, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(m.select("u", F.col("m").alias("v")))
            .where("u > v"))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``u, root`` for every node that is not the least of its component.

    ``edges`` has integer columns ``a, b`` (any order, repeats and loops allowed). Each round is written to the shared
    folder, so lineage stays short and a lost executor costs one round. Raises if ``rounds`` do not suffice; a
    component of n nodes takes about log2(n) squared at most.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        e = materialize(_small_star(_large_star(e).distinct()).distinct(), "edges")
        mark = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 24))).first()
        if mark == before:
            return e.select("u", F.col("v").alias("root"))
        before = mark
    raise RuntimeError("components did not settle")
