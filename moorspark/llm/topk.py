"""Exact top-k inner products by columnar branch-and-bound.

Vectors become integers, ``floor(scale * x)``. A task turns its candidates into tiles in vertical layout (one row per
dimension, one column per candidate) and adds up the products of a block of queries dimension block by dimension block. What the other
dimensions can still add is at most the product of the remaining lengths of both vectors (Cauchy-Schwarz); a candidate
below the query's k-th best score so far by that bound leaves. While many pairs live, a block of dimensions is one matrix
product over the columns that some query still wants; when few do, they are compacted to a list of pairs. Dimensions go
by falling weight in the queries, so that the bound falls early.

Queries are stored in order and go to the tasks in blocks of at most ``QUERY_BYTES``, one after the other; a block's
broadcast ends before the next begins. Each task returns at most k rows per query, its best ones with ties in order of
vec_id; these are ranked together. Sums are of integers below 2^53 in doubles, hence exact.

Defined cases: vectors that are null or hold a null, NaN or infinity take no part, nor do rows without vec_id, nor vectors whose
scaled length reaches 2^30.5, since a score might leave the range of a long; vectors of different dimensions are not
compared; all rows with the query's vec_id are its own; a repeated candidate counts as often as it occurs, a repeated
query once, the same id with another vector is another query; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorspark.llm.numbering import numbered
from moorspark.llm.registry import bounded, query
from moorspark.session import materialize

SCALE = 256
TOP = 5
#: dimensions added between two cuts
DIMS = 16
#: candidates of a tile and queries of a pass over it
TILE = 4096
PASS = 256
#: bytes of one broadcast block of queries
QUERY_BYTES = 16 << 20
#: share of living pairs below which they are listed
SPARSE = 1 / 16
_LIMIT = 2.0**61
_NONE = -(1 << 62)
#: products of lengths below this bound are exact in doubles, also with the column's place below the score
_EXACT = 2.0**50


def integers(ids: pa.Array, vectors: pa.Array, scale: int = SCALE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """``dimension -> (ids, matrix)`` of the rows that take part."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors, ids = vectors.combine_chunks(), ids.combine_chunks()
    here = pc.and_(pc.is_valid(ids), pc.is_valid(vectors))
    ids, vectors = ids.filter(here), vectors.filter(here)
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    x = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ids = ids.to_numpy(zero_copy_only=False)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    out = {}
    for d in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == d)
        v = x[first[own][:, None] + np.arange(d)] if d else np.zeros((len(own), 0))
        with np.errstate(over="ignore", invalid="ignore"):
            v = np.floor(scale * v)
            ok = np.isfinite(v).all(axis=1) & ((v * v).sum(axis=1) < _LIMIT)
        if ok.any():
            out[d] = (ids[own][ok], v[ok])
    return out


def _rest(squares: np.ndarray) -> np.ndarray:
    """Row b: length of what is left of each vector from dimension block b on."""
    cuts = range(0, squares.shape[0], DIMS)
    tail = [squares[a : a + DIMS].sum(axis=0) for a in cuts]
    out = np.zeros((len(tail) + 1, squares.shape[1]))
    out[:-1] = np.cumsum(np.array(tail)[::-1], axis=0)[::-1] if tail else 0
    return np.sqrt(out) * (1 + 1e-9)


class Best:
    """The best ``k`` candidates per query so far, ties to smaller ids."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.k, self.ids = k, ids
        self.order = np.argsort(-(matrix * matrix).sum(axis=0), kind="stable")
        self.q = matrix[:, self.order]
        self.qrest = _rest((self.q * self.q).T)
        self.score = np.full((len(ids), k), _NONE)
        self.found = np.zeros((len(ids), k), np.int64)

    def offer(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        """Compare a tile of candidates with all queries."""
        by_id = np.argsort(ids, kind="stable")
        ids = ids[by_id]
        v = np.ascontiguousarray(matrix[by_id][:, self.order].T)
        vrest = _rest(v * v)
        exact = float(self.qrest[0].max(initial=0) * vrest[0].max(initial=0)) < _EXACT
        for a in range(0, len(self.ids), PASS):
            b = min(a + PASS, len(self.ids))
            self._merge(a, ids, *(self._bounded(a, b, ids, v, vrest) if exact else self._plain(a, b, ids, v)))

    def _plain(self, a, b, ids, v):
        """All scores in whole numbers, for vectors too long for doubles."""
        s = self.q[a:b].astype(np.int64) @ v.astype(np.int64)
        i, j = np.nonzero((self.ids[a:b, None] != ids[None, :]) & (s >= self.score[a:b, -1:]))
        return i, j, s[i, j]

    def _bounded(self, a, b, ids, v, vrest):
        q, qrest, least = self.q[a:b], self.qrest[:, a:b], self.score[a:b, -1] - 0.5
        cols = np.arange(len(ids))
        s = np.zeros((b - a, len(ids)))
        live = self.ids[a:b, None] != ids[None, :]
        cut = 0
        for cut, at in enumerate(range(0, v.shape[0], DIMS), 1):
            s += q[:, at : at + DIMS] @ v[at : at + DIMS, cols]
            live &= s + qrest[cut][:, None] * vrest[cut, cols] >= least[:, None]
            some = live.any(axis=0)
            if not some.all():  # columns that no query wants leave the tile
                cols, s, live = cols[some], s[:, some], live[:, some]
            if live.sum() < SPARSE * (b - a) * len(ids):
                break
        if cut * DIMS >= v.shape[0] and len(cols) > 4 * self.k:  # whole scores: k a query, the column's place decides ties
            key = np.where(live, s.astype(np.int64) * len(cols) - np.arange(len(cols)), np.int64(-(1 << 63)))
            top = np.argpartition(key, len(cols) - self.k, axis=1)[:, len(cols) - self.k :]
            i, j = np.repeat(np.arange(b - a), self.k), top.ravel()
            here = live[i, j]
            i, j = i[here], j[here]
        else:
            i, j = np.nonzero(live)
        part, j = s[i, j], cols[j]
        for cut, at in enumerate(range(cut * DIMS, v.shape[0], DIMS), cut + 1):
            part = part + np.einsum("ij,ji->i", q[i, at : at + DIMS], v[at : at + DIMS, j])
            ok = part + qrest[cut][i] * vrest[cut][j] >= least[i]
            i, j, part = i[ok], j[ok], part[ok]
        return i, j, part.astype(np.int64)

    def _merge(self, a, ids, i, j, s):
        """Take over pairs of query ``a + i`` and column ``j``; columns are in order of their ids."""
        if not len(i):
            return
        order = np.lexsort((j, -s, i))
        i, j, s = i[order], j[order], s[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        top = place < self.k
        i, j, s, place = i[top], j[top], s[top], place[top]
        own = np.unique(i)
        at = np.searchsorted(own, i)
        score = np.full((len(own), 2 * self.k), _NONE)
        found = np.zeros((len(own), 2 * self.k), np.int64)
        score[:, : self.k], found[:, : self.k] = self.score[a + own], self.found[a + own]
        score[at, self.k + place], found[at, self.k + place] = s, ids[j]
        best = np.lexsort((found, -score), axis=1)[:, : self.k]
        self.score[a + own] = np.take_along_axis(score, best, 1)
        self.found[a + own] = np.take_along_axis(found, best, 1)


def _queries(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``query_id, dim, v`` (bytes of doubles) of distinct queries, with their position (a stored table)."""
    def run(batches):
        for batch in batches:
            for d, (ids, m) in integers(batch.column(0), batch.column(1), scale).items():
                yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(np.full(len(ids), d, np.int64)), pa.array([x.tobytes() for x in m], pa.binary())], ["query_id", "dim", "v"])

    found = rows.select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v")).mapInArrow(run, "query_id long, dim long, v binary").distinct()
    return numbered(found, [F.col("dim"), F.col("query_id"), F.col("v")])


def _near(rows: DataFrame, block, k: int, scale: int) -> DataFrame:
    """The best candidates of each task for a broadcast block of queries."""
    def run(batches):
        best: dict[int, Best] = {}
        held: dict[int, list] = {}

        def compare(d, least):
            if sum(len(i) for i, _ in held.get(d, [])) > least:
                ids, m = (np.concatenate(x) for x in zip(*held.pop(d), strict=True))
                for a in range(0, len(ids), TILE):
                    best[d].offer(ids[a : a + TILE], m[a : a + TILE])

        for d, (_, ids, m) in block.value.items():
            best[d] = Best(ids, m, k)
        for batch in batches:
            for d, x in integers(batch.column(0), batch.column(1), scale).items():
                if d in best:
                    held.setdefault(d, []).append(x)
                    compare(d, TILE - 1)
        for d, b in best.items():
            compare(d, 0)
            i, j = np.nonzero(b.score > _NONE)
            position = block.value[d][0]
            for a in range(0, len(i), 10_000):
                x, y = i[a : a + 10_000], j[a : a + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(position[x]), pa.array(b.ids[x]), pa.array(b.found[x, y]), pa.array(b.score[x, y])], ["position", "query_id", "vec_id", "score"])

    return rows.mapInArrow(run, "position long, query_id long, vec_id long, score long")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = TOP, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, block_bytes: int = QUERY_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of every query."""
    spark = candidates.sparkSession
    stored = materialize(_queries(queries, key, vector, scale), "queries")
    n, dim = stored.agg(F.count("*"), F.max("dim")).first()
    per = max(1, block_bytes // (8 * max(1, dim or 0)))
    rows = candidates.select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v"))
    ranked = Window.partitionBy("position").orderBy(F.col("score").desc(), "vec_id")
    parts = []
    for a in range(0, max(n, 1), per):
        # at most ``per`` vectors, that is ``block_bytes``
        t = stored.where((F.col("position") >= a) & (F.col("position") < a + per)).orderBy("position").toArrow()
        dims, block = t.column("dim").to_numpy(), {}
        for d in np.unique(dims).tolist():
            own = np.flatnonzero(dims == d)
            m = np.array([np.frombuffer(x, np.float64) for x in t.column("v").take(own).to_pylist()]).reshape(len(own), d)
            block[d] = (t.column("position").to_numpy()[own], t.column("query_id").to_numpy()[own], m)
        sent = spark.sparkContext.broadcast(block)
        near = _near(rows, sent, k, scale).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        parts.append(materialize(near.select("query_id", "rank", "vec_id", "score"), "top"))
        sent.destroy()
    return reduce(DataFrame.unionByName, parts)


@query("op11_columnar_bound_topk", sql="""
WITH v AS (
  SELECT vec_id, len(embedding) AS d, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND c.d = q.d),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op11(spark, sf_dir):
    """The five best candidates of every fiftieth vector over all others."""
    rows = bounded(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(rows, rows.where("vec_id % 50 = 0"))
