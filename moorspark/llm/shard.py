"""Sharding by a hierarchical weighted hash tree (law ``key``).

A tree of regions, racks and shards carries a weight per shard; a node weighs the sum of its shards. A row descends the
three levels; at each it draws ``-ln(u) / weight`` per child from a hash of the key and the child's name, and goes to the
smallest draw. A draw depends on that child alone, so a changed weight moves rows only into or out of the subtrees whose
weights changed. ``grow`` hangs a further shard below a region of its own: no old node changes its weight, hence rows move
into the new shard alone.

Everything is a column expression: one narrow pass places rows, only slots need a shuffle (of ids and counters, not texts).
Defined cases: a null key is a key like any other, repeated keys stay together, a null text has size 1 and checksum 0,
an empty table gives no row, further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorspark.llm.registry import documents, query

SHARDS = 16
#: rows of one slot-numbering group are at most this many ids wide
CHUNK = 1 << 16


@dataclass(frozen=True)
class Node:
    """A shard (leaf with its number) or an inner node with children."""

    name: str
    weight: float = 1.0
    shard: int | None = None
    children: tuple[Node, ...] = ()

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight


def tree(shards: int = SHARDS, racks: int = 2, per_rack: int = 4, weights: dict[int, float] | None = None) -> Node:
    """Shards in numerical order in racks of ``per_rack`` and regions of ``racks`` racks."""
    w = weights or {}
    leaves = [Node(f"shard-{i}", w.get(i, 1.0), i) for i in range(shards)]
    rack = [Node(f"rack-{i // per_rack}", children=tuple(leaves[i : i + per_rack])) for i in range(0, shards, per_rack)]
    region = [Node(f"region-{i // racks}", children=tuple(rack[i : i + racks])) for i in range(0, len(rack), racks)]
    return Node("root", children=tuple(region))


def grow(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard in a new region and rack."""
    leaf = Node(f"shard-{shard}", weight, shard)
    return Node(root.name, children=(*root.children, Node(f"region-of-{shard}", children=(Node(f"rack-of-{shard}", children=(leaf,)),))))


def _draw(key: Column, node: Node) -> Column:
    # 53 bits of a hash of (key, name) as a number in (0, 1); a null key hashes as its absence
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.ln(u) / F.lit(float(node.total))


def place(key: Column, node: Node) -> Column:
    """Shard number of a key."""
    if node.shard is not None:
        return F.lit(node.shard)
    live = [c for c in node.children if c.total > 0]
    if not live:
        raise ValueError(f"no weight below {node.name}")
    if len(live) == 1:
        return place(key, live[0])
    draws = [_draw(key, c) for c in live]
    least = F.least(*draws)
    out = place(key, live[-1])
    for c, d in list(zip(live, draws, strict=True))[-2::-1]:
        out = F.when(d == least, place(key, c)).otherwise(out)
    return out


def assign(docs: DataFrame, root: Node, larger: Node | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, grown_shard, slot`` per row.

    Slots count from 0 within a shard in order of (key range, key): rows per (shard, key range) are counted first, the
    running sum over ranges is the base, so no task sorts a shard.
    """
    k = F.col(key)
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(k.alias("doc_id"), (F.length(body).cast("long") + 1).alias("size"), F.crc32(body).cast("long").alias("text_crc32"),
                       place(k, root).cast("int").alias("shard"),
                       (place(k, larger) if larger else F.lit(None)).cast("int").alias("grown_shard"),
                       F.floor(F.coalesce(k, F.lit(0)) / CHUNK).cast("long").alias("range"))
    counts = rows.groupBy("shard", "range").count()
    base = counts.select("shard", "range", (F.sum("count").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count")).alias("base"))
    own = rows.withColumn("at", F.row_number().over(Window.partitionBy("shard", "range").orderBy("doc_id", "size", "text_crc32")))
    return own.join(base, ["shard", "range"]).select("doc_id", "size", "text_crc32", "shard", "grown_shard", (F.col("base") + F.col("at") - 1).alias("slot"))


@query("op2_hash_tree_shards")
def op2(spark, sf_dir):
    """All documents in shards 0 to 15 and, grown, 0 to 16."""
    root = tree()
    return assign(documents(spark, sf_dir), root, grow(root, SHARDS)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
