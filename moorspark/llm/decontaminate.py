"""Benchmark decontamination with an FM-index per training shard.

A shard is a block of documents. Its words become numbers of the benchmark's vocabulary; stretches that no benchmark
window can lie in (words outside the vocabulary, document borders) shrink to one separator, which loses no occurrence.
The shard's sequence is suffix-sorted, its Burrows-Wheeler transform stored as a wavelet matrix. All test windows are
searched backward at once; a window whose interval empties drops out. Occurrences are located by walking to the nearest
sampled suffix position, and their spans are merged per document.

The benchmark travels in blocks of at most ``BLOCK_WORDS`` words (a longer item is a block of its own), each a broadcast of
that bounded size; a task takes one block after the other. Words are compared by 64-bit hashes.

Defined cases: a null or wordless text has no hits; a null or wordless item has no window, an item without id counts
under the empty name; items that share an id count once; repeated rows are scanned each; empty tables give no rows or no
hits; further columns are ignored or carried on request.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.llm import lex
from moorspark.llm.registry import LOWER_SQL, documents, query

WINDOW = 10
BLOCK_WORDS = 1 << 20
SAMPLE = 8


class WaveletMatrix:
    """Access and rank over a sequence of small numbers."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ranks, self.planes, self.zeros = bits, [], [], []
        v = values
        for b in range(bits - 1, -1, -1):
            one = (v >> b & 1).astype(bool)
            self.planes.append(one)
            self.ranks.append(np.concatenate([[0], np.cumsum(one)]).astype(np.int64))
            self.zeros.append(len(v) - int(self.ranks[-1][-1]))
            v = np.concatenate([v[~one], v[one]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at``."""
        lo = np.zeros(len(at), np.int64)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            one = symbol >> b & 1 == 1
            r = self.ranks[level]
            a, z = r[at], r[lo]
            at = np.where(one, self.zeros[level] + a, at - a)
            lo = np.where(one, self.zeros[level] + z, lo - z)
        return at - lo

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for level in range(self.bits):
            one = self.planes[level][at]
            out = out << 1 | one
            a = self.ranks[level][at]
            at = np.where(one, self.zeros[level] + a, at - a)
        return out


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Full suffix order by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(s)
    sa = np.argsort(s, kind="stable")
    head = np.concatenate([[True], s[sa][1:] != s[sa][:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.flatnonzero(head)[np.cumsum(head) - 1]
    h = 1
    while True:
        size = np.diff(np.append(np.flatnonzero(head), n))
        tied = np.flatnonzero(np.repeat(size > 1, size))  # places in sa
        if not len(tied):
            return sa
        pos = sa[tied]
        after = np.where(pos + h < n, rank[np.minimum(pos + h, n - 1)] + 1, 0)
        order = np.lexsort((after, rank[pos]))
        sa[tied] = pos[order]
        g, a = rank[pos][order], after[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (a[1:] != a[:-1])])
        head[tied] = new
        rank[sa[tied]] = tied[new][np.cumsum(new) - 1]
        h *= 2


class FMIndex:
    """Backward search and locate over a sequence of numbers from 1."""

    def __init__(self, values: np.ndarray, symbols: int, sample: int = SAMPLE):
        s = np.append(values, 0)
        sa = suffix_array(s)
        bwt = s[sa - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols))])
        self.wavelet = WaveletMatrix(bwt, max(1, int(symbols).bit_length()))
        self.n = len(s)
        self.sampled = sa % sample == 0
        self.at = np.cumsum(self.sampled) - 1
        self.positions = sa[self.sampled]

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval of each phrase; row i holds ``length[i]`` symbols, right-aligned."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(1, phrases.shape[1] + 1):
            live = live[(hi[live] > lo[live]) & (length[live] >= j)]
            if not len(live):
                break
            c = phrases[live, -j]
            both = self.wavelet.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            lo[live] = self.before[c] + both[: len(live)]
            hi[live] = self.before[c] + both[len(live) :]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            found = self.sampled[rows[open_]]
            hit = open_[found]
            out[hit] = self.positions[self.at[rows[hit]]] + steps[hit]
            open_ = open_[~found]
            r = rows[open_]
            c = self.wavelet.access(r)
            rows[open_] = self.before[c] + self.wavelet.rank(c, r)
            steps[open_] += 1
        return out


class Phrases:
    """The windows of some benchmark items over the vocabulary of those items."""

    def __init__(self, names: list[str], vocabulary: np.ndarray, rows: np.ndarray, length: np.ndarray, item: np.ndarray):
        self.names, self.vocabulary, self.rows, self.length, self.item = names, vocabulary, rows, length, item
        self.least = int(length.min()) if len(length) else 0

    @staticmethod
    def plain(ids: list[str], texts: list[str], window: int = WINDOW) -> tuple:
        """The constructor's arguments for some items."""
        column = pa.array(texts, pa.string())
        buf, off = lex.text_buffers(column)
        w = lex.Words(buf, off, lex.ALNUM)
        hashes = lex.byte_sums(buf, True).span(w.start, w.end)
        vocabulary, word = np.unique(hashes, return_inverse=True)
        rows, length, item = [], [], []
        for i, (a, b) in enumerate(zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist(), strict=True)):
            k = min(window, b - a)
            for s in range(a, b - k + 1) if k else ():
                rows.append(np.concatenate([np.zeros(window - k, np.int64), word[s : s + k] + 2]))
                length.append(k)
                item.append(i)
        return ids, vocabulary, np.array(rows, np.int64).reshape(-1, window), np.array(length, np.int64), np.array(item, np.int64)

    def occurrences(self, hashes: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrase number and first word (in the block) of every occurrence."""
        none = np.zeros(0, np.int64)
        if not len(self.rows) or not len(hashes):
            return none, none
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == hashes
        # a separator before each document and each unknown word; then only stretches long enough for a window
        edge = ~known
        start = np.zeros(len(hashes) + 1, bool)
        start[ptr] = True
        first = known & (start[:-1] | np.concatenate([[True], edge[:-1]]))
        stretch = np.cumsum(first) - 1
        keep = known & (np.bincount(stretch[known], minlength=max(1, first.sum()))[stretch] >= self.least)
        word = np.flatnonzero(keep)
        if not len(word):
            return none, none
        lead = first[word]
        place = np.arange(len(word)) + np.cumsum(lead)
        text = np.ones(place[-1] + 1, np.int64)
        text[place] = at[word] + 2
        source = np.zeros(len(text), np.int64)
        source[place] = word
        index = FMIndex(text, len(self.vocabulary) + 2)
        lo, hi = index.search(self.rows, self.length)
        n = np.maximum(hi - lo, 0)
        which = np.repeat(np.arange(len(n)), n)
        rows = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return which, source[index.locate(rows)]


def phrase_blocks(spark, benchmark: DataFrame, window: int = WINDOW) -> list:
    """Broadcasts of at most ``BLOCK_WORDS`` words of items each; the driver holds one block at a time."""
    out, ids, texts, size = [], [], [], 0
    for r in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.col("text")).where("text IS NOT NULL").toLocalIterator():
        n = len(r.text) // 2 + 1  # words at most
        if texts and size + n > BLOCK_WORDS:
            out.append(spark.sparkContext.broadcast(Phrases.plain(ids, texts, window)))
            ids, texts, size = [], [], 0
        ids.append(r.id)
        texts.append(r.text)
        size += n
    if texts:
        out.append(spark.sparkContext.broadcast(Phrases.plain(ids, texts, window)))
    return out


_NEW = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("spans", pa.list_(pa.list_(pa.int32())))]


def scan(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str = "text", prefix: str = "", window: int = WINDOW) -> DataFrame:
    """Per row the ``carry`` columns and ``n_words, n_hit, n_items, items_sha256, contaminated, spans``.

    ``spans`` are the merged ``[start, end)`` byte ranges of hit words, blanks between them included.
    """
    shared = phrase_blocks(docs.sparkSession, benchmark, window)
    columns = list(dict.fromkeys([*carry, text]))

    def run(batches):
        for batch in batches:
            for rows, buf, off in lex.blocks(batch, text):
                w = lex.Words(buf, off, lex.ALNUM)
                hashes = lex.byte_sums(buf, True).span(w.start, w.end)
                hit = np.zeros(len(hashes), bool)
                found: list[set[str]] = [set() for _ in range(rows.num_rows)]
                for b in shared:
                    phrases = Phrases(*b.value)
                    which, at = phrases.occurrences(hashes, w.ptr)
                    if len(at):
                        delta = np.bincount(at, minlength=len(hit) + 1) - np.bincount(at + phrases.length[which], minlength=len(hit) + 1)[: len(hit) + 1]
                        hit |= np.cumsum(delta)[: len(hit)] > 0
                        doc = np.searchsorted(w.ptr, at, "right") - 1
                        pairs = np.unique(np.stack([doc, phrases.item[which]], 1), axis=0)
                        for d, i in pairs.tolist():
                            found[d].add(phrases.names[i])
                n_hit = lex.per_doc(hit.astype(np.int64), w.ptr)
                spans: list = [[] for _ in found]
                for d in np.flatnonzero(n_hit).tolist():
                    a, b = lex.runs(hit[w.ptr[d] : w.ptr[d + 1]])
                    spans[d] = [[int(w.start[w.ptr[d] + x] - off[d]), int(w.end[w.ptr[d] + y - 1] - off[d])] for x, y in zip(a, b, strict=True)]
                new = [w.counts, n_hit, [len(f) for f in found], [hashlib.sha256(",".join(sorted(f)).encode()).hexdigest() for f in found], n_hit > 0, spans]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in carry), *(pa.array(x, t) for x, (_, t) in zip(new, _NEW, strict=True))], [*carry, *(prefix + n for n, _ in _NEW)])

    if {prefix + n for n, _ in _NEW} & set(carry):
        raise ValueError("carried columns clash; give a prefix")
    kinds = dict(zip([n for n, _ in _NEW], ["long", "long", "long", "string", "boolean", "array<array<int>>"], strict=True))
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry), *(f"`{prefix}{n}` {t}" for n, t in kinds.items())])
    return docs.select(columns).mapInArrow(run, schema)


def cut(text: str | None, spans) -> str | None:
    """The text without the merged spans."""
    if text is None:
        return None
    raw, out, at = text.encode(), [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode()


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go whole, so that no rest of a test item is left."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    return scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), docs.columns, prefix=prefix).where(~F.col(f"{prefix}contaminated")).select(*docs.columns)


_WORDS = "regexp_extract_all(" + LOWER_SQL.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
 i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
 iw AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS k, array_to_string(w[s : s + least(len(w), {WINDOW}) - 1], ' ') AS win FROM i, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) u(s) WHERE len(w) > 0),
 dw AS (SELECT doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS win FROM d, (SELECT DISTINCT k FROM iw) kk, unnest(range(1, len(w) - k + 2)) u(s)),
 hit AS (SELECT doc_id, s, dw.k, item FROM dw JOIN iw ON iw.k = dw.k AND iw.win = dw.win),
 n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + k)) u(p) GROUP BY 1),
 it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id"""


@query("op9_fm_index_decontamination", SQL)
def op9(spark, sf_dir):
    """Hits of all benchmark items in all documents."""
    return scan(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"]).drop("spans")
