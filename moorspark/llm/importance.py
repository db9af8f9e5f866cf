"""Importance resampling towards a target distribution over hashed n-grams.

Features are the runs of 1 to ``n`` consecutive words, joined by one blank. In each block of texts the words are laid out
with single blanks between them, so that a feature is a span of bytes; its XXH64 is its key in an open-addressed numpy
table (linear probing, load of a half at most). A slot keeps a representative span, to which every occurrence with the
same key is compared byte by byte, the bucket (crc32 modulo ``buckets``, taken once per distinct feature) and a count. A
first pass sums counts per bucket over the corpus, tables of ``buckets`` numbers per task; the second looks up each
occurrence's gain by its slot. Only per-document numbers are shuffled, and the draw is a position in a global order.

Defined cases: a null text has no words; a null doc_id draws with the text ``2024:`` and stands after all ids in ties;
repeated rows count and draw once each, equal ones in any order; an empty benchmark has T = 0; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.llm import lex
from moorspark.llm.numbering import numbered
from moorspark.llm.registry import LOWER_SQL, documents, query
from moorspark.session import materialize

RUN = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: bytes of text that one table covers
TABLE = 1 << 18

_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))  # constants of the published XXH64


def _turn(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


class Spans:
    """Spans of a byte buffer that can be hashed and compared eight bytes at a time."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        n = len(self.data) - 7
        self.eight = np.ndarray((n,), "<u8", self.data.data, 0, (1,))
        self.four = np.ndarray((n,), "<u4", self.data.data, 0, (1,))
        self.start, self.length = start, length

    def keys(self) -> np.ndarray:
        """XXH64 with seed 0 of each span."""
        n = self.length
        h = _P5 + n.astype(np.uint64)
        at, left = self.start.copy(), n.copy()
        live = np.flatnonzero((left >= 8) & (n < 32))
        while len(live):
            x = _turn(self.eight[at[live]] * _P2, 31) * _P1
            h[live] = _turn(h[live] ^ x, 27) * _P1 + _P4
            at[live] += 8
            left[live] -= 8
            live = live[left[live] >= 8]
        i = np.flatnonzero((left >= 4) & (n < 32))
        h[i] = _turn(h[i] ^ self.four[at[i]].astype(np.uint64) * _P1, 23) * _P2 + _P3
        at[i] += 4
        left[i] -= 4
        live = np.flatnonzero((left > 0) & (n < 32))
        while len(live):
            h[live] = _turn(h[live] ^ self.data[at[live]].astype(np.uint64) * _P5, 11) * _P1
            at[live] += 1
            left[live] -= 1
            live = live[left[live] > 0]
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(n >= 32).tolist():
            h[i] = xxhash.xxh64_intdigest(self.bytes(i))
        return h

    def bytes(self, i: int) -> bytes:
        return self.data[self.start[i] : self.start[i] + self.length[i]].tobytes()

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans ``a[i]`` and ``b[i]`` hold the same bytes."""
        out = self.length[a] == self.length[b]
        live, at = np.flatnonzero(out), 0
        while len(live):
            left = self.length[a[live]] - at
            keep = np.where(left >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (np.uint64(8) * np.minimum(left, 7).astype(np.uint64))) - np.uint64(1))
            x = (self.eight[self.start[a[live]] + at] ^ self.eight[self.start[b[live]] + at]) & keep
            out[live[x != 0]] = False
            live, at = live[(x == 0) & (left > 8)], at + 8
        return out


class Interned:
    """Distinct spans in an open-addressed table: ``slot`` of each span; ``owner`` (a span or -1) and ``count`` of each slot."""

    def __init__(self, spans: Spans, keys: np.ndarray | None = None):
        n = len(spans.start)
        keys = spans.keys() if keys is None else keys
        size = 1 << max(4, (2 * n - 1).bit_length())
        self.owner = np.full(size, -1, np.int64)
        self.slot = (keys & np.uint64(size - 1)).astype(np.int64)
        todo = np.arange(n)
        while len(todo):
            s = self.slot[todo]
            free = self.owner[s] < 0
            self.owner[s[free]] = todo[free]  # of several spans at one free slot one stays; the others look again
            own = self.owner[s]
            same = keys[own] == keys[todo]
            same[same] = spans.equal(own[same], todo[same])
            todo = todo[~same]
            self.slot[todo] = (self.slot[todo] + 1) & (size - 1)
        self.count = np.bincount(self.slot, minlength=size)

    def buckets(self, spans: Spans, buckets: int) -> np.ndarray:
        out = np.zeros(len(self.owner), np.int64)
        used = np.flatnonzero(self.owner >= 0)
        out[used] = [zlib.crc32(spans.bytes(i)) % buckets for i in self.owner[used].tolist()]
        return out


def features(buf: np.ndarray, off: np.ndarray, run: int = RUN) -> tuple[Spans, np.ndarray, np.ndarray]:
    """Feature spans of a block, the document of each, and the number of words per document."""
    w = lex.Words(buf, off, lex.ALNUM)
    size = w.end - w.start
    start = np.concatenate([[0], np.cumsum(size + 1)])[: len(size)]
    total = int(start[-1] + size[-1]) if len(size) else 0
    data = np.full(total, 0x20, np.uint8)
    to = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)
    data[to] = lex.lower_bytes(buf)[to - np.repeat(start - w.start, size)]
    doc, n = w.doc, len(size)
    starts, lengths, docs = [], [], []
    for k in range(1, run + 1):
        a = np.arange(max(0, n - k + 1))
        a = a[doc[a] == doc[a + k - 1]]
        starts.append(start[a])
        lengths.append(start[a + k - 1] + size[a + k - 1] - start[a])
        docs.append(doc[a])
    return Spans(data, np.concatenate(starts), np.concatenate(lengths)), np.concatenate(docs), w.counts


def bucket_counts(docs: DataFrame, run: int = RUN, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """``bucket, n``: features per bucket over all rows."""
    def count(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, buf, off in lex.blocks(batch, limit=TABLE):
                spans, _, _ = features(buf, off, run)
                table = Interned(spans)
                np.add.at(sums, table.buckets(spans, buckets), table.count)
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], ["bucket", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket; two tables of at most ``buckets`` rows come to the driver."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for out, df in ((s, docs), (t, target)):
        for r in bucket_counts(df, run, buckets).collect():
            out[r.bucket] = r.n
    big_s, big_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log(((b + 1.0) * big_s) / ((a + 1.0) * big_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def noise(key: str) -> int:
    """Gumbel draw of a document in thousandths."""
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, run: int = RUN, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` per row."""
    def weigh(batches):
        for batch in batches:
            for rows, buf, off in lex.blocks(batch, limit=TABLE):
                spans, doc, words = features(buf, off, run)
                table = Interned(spans)
                of_slot = gain[table.buckets(spans, len(gain))]
                n = np.bincount(doc, minlength=len(words))
                order = np.argsort(doc, kind="stable")
                weight = lex.per_doc(of_slot[table.slot[order]], np.concatenate([[0], np.cumsum(n)]))
                drawn = np.array([noise(f"{seed}:{'' if i is None else i}") for i in rows.column("doc_id").to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *[pa.array(x.astype(np.int64)) for x in (words, n, weight, weight + drawn)]], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select("doc_id", "text").mapInArrow(weigh, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``; the rank of rows that are not drawn is null."""
    rows = materialize(weighed(docs, gains(docs, target, run, buckets), run, seed), "weights")
    able = rows.where(F.col("n_words") >= least_words)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features"), F.col("n_words")]
    placed = numbered(able, order)
    drawn = able.count() * percent // 100
    rank = F.when(F.col("position") < drawn, F.col("position") + 1)
    rest = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).drop("position").unionByName(rest)


def _words_sql(table: str, key: str) -> str:
    return f"""SELECT r, {key}, unnest(regexp_extract_all({LOWER_SQL.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM {table}"""


#: the query's constants, restated
SQL = f"""WITH RECURSIVE dr AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents), br AS (SELECT 0 AS r, item_id, text FROM benchmark),
 dw AS MATERIALIZED ({_words_sql('dr', 'doc_id')}), bw AS MATERIALIZED ({_words_sql('br', 'item_id')}),
 step(n, c, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL SELECT n, xor(c >> 1, (c & 1) * 3988292384), k + 1 FROM step WHERE k < 8),
 tab AS (SELECT list(c ORDER BY n) AS t FROM step WHERE k = 8),
 hx AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
 bs AS (SELECT w, list_transform(range(1, length(h) // 2 + 1), lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT)) AS b FROM hx),
 cr AS MATERIALIZED (SELECT w, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 10000 AS k FROM bs, tab),
 sk AS (SELECT k, count(*) AS s FROM dw JOIN cr USING (w) GROUP BY 1), tk AS (SELECT k, count(*) AS t FROM bw JOIN cr USING (w) GROUP BY 1),
 al AS (SELECT (SELECT coalesce(sum(s), 0) FROM sk)::DOUBLE AS big_s, (SELECT coalesce(sum(t), 0) FROM tk)::DOUBLE AS big_t),
 ga AS MATERIALIZED (SELECT k, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (big_s + 10000)) / ((s + 1)::DOUBLE * (big_t + 10000)))) AS BIGINT) AS g
  FROM sk LEFT JOIN tk USING (k), al),
 fe AS (SELECT r, count(*) AS n, sum(g) AS weight FROM dw JOIN cr USING (w) JOIN ga USING (k) GROUP BY 1),
 sc AS (SELECT r, doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) AS h FROM dr LEFT JOIN fe USING (r)),
 so AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM sc),
 ra AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, count(*) OVER () AS able FROM so WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= able * 10 // 100 THEN rank END AS rank FROM so LEFT JOIN ra USING (r)"""


@query("op12_interned_importance_resampling", SQL)
def op12(spark, sf_dir):
    """Weights and draw of all documents towards the benchmark."""
    docs = documents(spark, sf_dir)
    return resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("n_words")
