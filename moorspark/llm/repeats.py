"""Removal of strings of ``SIZE`` bytes that also start in a document with a smaller doc_id.

Equal windows have equal minimizers (the least hashed ``K`` bytes inside, the leftmost of ties), and consecutive windows with the
same minimizer occurrence form one string of at most 2 ``SIZE`` - ``K`` bytes. So the suffixes to sort shrink to those
strings, and the work to the minimizers that more than one document holds:

1. documents are packed into shards of ``SHARD`` bytes, stored once, compressed, in a table bucketed by unit (some ``UNIT`` bytes
   of shards), so that later steps bring their lists to the units and never move a text;
2. every unit sends its sorted minimizers to buckets by their leading bits; the sorted runs of all units are merged, and the
   shared ones return to the units;
3. every unit sends its distinct strings with a shared minimizer to the buckets. A bucket is the shard of the suffix
   sort: a suffix array by Larsson-Sadakane refinement (prefixes double, only groups that still tie are sorted again) and
   the common prefixes of neighbours in text order (Kasai) give the classes of equal windows and the smallest doc_id of
   each. A minimizer with a single string needs no sorting;
4. the minima return to the units, which mark the bytes of their shards and hash what is left.

A list is sent per unit and bucket, so lists grow with units times buckets: units are many shards, and the buckets of step 2,
which hold hashes alone, are larger than those of step 3.
Nothing is sent per document or per occurrence across units: repeats within a unit are merged before every exchange, so
a passage in a third of all documents costs one string per unit. Windows are compared by their bytes in step 3; equal
strings of different units are recognised by two 64-bit hashes, of the minimizer and of the string.

Defined cases: a null text is empty; a null doc_id counts as larger than any other and its rows never remove each other's
bytes; rows with the same doc_id are one document here, each with a result row; texts below ``SIZE`` bytes lose nothing; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorspark.llm import lex
from moorspark.llm.registry import documents, query
from moorspark.session import materialize, scratch_path

SIZE = 50
K = 24
#: bytes of text per shard, at most per unit of shards, per bucket of minimizers and per bucket of strings
SHARD = 1 << 20
UNIT = 1 << 25
LISTS = 1 << 23
BUCKET = 1 << 21
#: bytes of strings in one suffix array, which takes about 60 times as much
ARRAY = 1 << 16
#: bytes of text or strings under one prefix sum, whose arrays then stay in the processor's cache
PREFIX = 1 << 18
_LAST = np.iinfo(np.int64).max


def squeeze(*arrays: np.ndarray, level: int = 3) -> bytes:
    """Compressed bytes of some arrays, each with its length before it."""
    raw = b"".join(np.int64(a.nbytes).tobytes() + a.tobytes() for a in arrays)
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def spread(data: bytes, *kinds: str) -> list[np.ndarray]:
    """The arrays of ``squeeze``."""
    raw = pa.decompress(data[8:], int(np.frombuffer(data, np.int64, 1)[0]), "zstd", asbytes=True)
    out, at = [], 0
    for k in kinds:
        n = int(np.frombuffer(raw, np.int64, 1, at)[0])
        out.append(np.frombuffer(raw, k, n // np.dtype(k).itemsize, at + 8))
        at += 8 + n
    return out


def unit_numbers(spark: SparkSession, n: int, each: int) -> list[int]:
    """``each`` numbers out of every one of ``n`` hash partitions, so that units are dealt evenly."""
    part = F.pmod(F.hash("id"), F.lit(n)).alias("part")
    ids = F.slice(F.sort_array(F.collect_list("id")), 1, each).alias("ids")
    return sorted(i for r in spark.range(n * (20 + 4 * each)).groupBy(part).agg(ids).collect() for i in r.ids)


def shards(docs: DataFrame, units: list[int]) -> DataFrame:
    """One row per shard: ``unit``, ``shard``, ``ids`` (null: the largest number), ``known``, ``sizes``, compressed ``data``; to be stored."""
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        first = int(np.random.default_rng(part).integers(len(units)))  # the same if the task runs again
        for batch in batches:
            for rows, buf, off in lex.blocks(batch, limit=SHARD):
                ids = rows.column("doc_id").cast(pa.int64())
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                data = squeeze(ids.fill_null(_LAST).to_numpy(), known.astype(np.uint8), off, buf, level=5)
                unit = units[(first + number) % len(units)]
                yield pa.RecordBatch.from_arrays([pa.array([unit], pa.int64()), pa.array([part << 32 | number], pa.int64()), pa.array([data], pa.binary())], ["unit", "shard", "data"])
                number += 1

    return docs.select("doc_id", "text").mapInArrow(run, "unit long, shard long, data binary")


def _least(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours."""
    s = 1
    x = a
    while 2 * s <= w:
        x = np.minimum(x[:-s], x[s:])
        s *= 2
    return np.minimum(x[: len(x) - (w - s)], x[w - s :]) if w > s else x


class Strings:
    """The strings of a shard: first window ``start``, number of ``windows``, ``minimizer`` hash and its place ``at`` in the string, ``doc``."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.sums = lex.byte_sums(buf, False)
        n = len(buf)
        none = np.zeros(0, np.int64)
        self.start, self.windows, self.minimizer, self.at, self.doc = none, none, np.zeros(0, np.uint64), none, none
        if n < SIZE:
            return
        key = self.sums.every(K)
        key &= np.uint64(0xFFFFFFFF00000000)
        key |= np.arange(len(key), dtype=np.uint64)
        best = (_least(key, SIZE - K + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        del key
        first = np.zeros(n - SIZE + 1, bool)
        first[0] = True
        first[1:] = best[1:] != best[:-1]
        first[off[:-1][off[:-1] <= n - SIZE]] = True
        whole = np.ones(n + 1, bool)  # windows that end inside their document
        sizes = np.diff(off)
        tail = np.zeros(n + 1, np.int32)
        np.add.at(tail, np.maximum(off[1:] - SIZE + 1, off[:-1]), 1)
        np.add.at(tail, off[1:], -1)
        whole = np.cumsum(tail)[: n - SIZE + 1] <= 0
        group = np.cumsum(first) - 1
        start = np.flatnonzero(first)
        count = np.bincount(group[whole], minlength=len(start))
        keep = (count > 0) & whole[start]
        self.start, self.windows = start[keep], count[keep]
        self.at = best[self.start] - self.start
        self.minimizer = self.sums.span(best[self.start], best[self.start] + K)
        self.doc = np.searchsorted(off, self.start, "right") - 1
        assert (sizes[self.doc] >= SIZE).all()


def _shard(data: bytes):
    ids, known, off, buf = spread(data, "<i8", "u1", "<i8", "u1")
    return ids, known.astype(bool), off, buf


def _pieces_of(off: np.ndarray, buf: np.ndarray) -> Iterator[tuple[int, "Strings"]]:
    """The strings of a shard, ``PREFIX`` bytes of whole documents at a time, with the first document of each piece."""
    a = 0
    while a < len(off) - 1:
        b = max(a + 1, int(np.searchsorted(off, off[a] + PREFIX, "right")) - 1)
        yield a, Strings(buf[off[a] : off[b]], off[a : b + 1] - off[a])
        a = b


def _by_bucket(h: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of a hash from its leading bits."""
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _cuts(key: np.ndarray) -> list[tuple[int, int, int]]:
    """``(value, begin, end)`` of the runs of a sorted key."""
    edge = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
    return [(int(key[a]), int(a), int(b)) for a, b in zip(edge[:-1], edge[1:], strict=True) if b > a]


def _heads(*keys: np.ndarray) -> np.ndarray:
    """True at the first of equal neighbours."""
    head = np.ones(len(keys[0]), bool)
    head[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return head


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """True for the values that are in the sorted ``some``."""
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values if len(some) else np.zeros(len(values), bool)


def minimizers(stored: DataFrame, bits: int) -> DataFrame:
    """``bucket, unit, run``: each unit's distinct minimizers (the bucket's bits and 32 more, sorted) and whether two of its documents hold them."""
    def run(table: pa.Table) -> pa.Table:
        keys, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for data in table.column("data"):
            ids, _, off, buf = _shard(data.as_py())
            for first, s in _pieces_of(off, buf):
                keys.append(s.minimizer >> np.uint64(32 - bits))
                docs.append(ids[first + s.doc])
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key)
        key, doc = key[order], doc[order]
        begin = np.flatnonzero(_heads(key))
        many = np.minimum.reduceat(doc, begin) != np.maximum.reduceat(doc, begin) if len(key) else np.zeros(0, bool)
        key = key[begin]
        out = [(b, squeeze((key[x:y] & np.uint64(0xFFFFFFFF)).astype("<u4"), np.packbits(many[x:y]))) for b, x, y in _cuts((key >> np.uint64(32)).astype(np.int64))]
        return pa.table([pa.array([b for b, _ in out], pa.int32()), pa.array([table.column("unit")[0].as_py()] * len(out), pa.int64()), pa.array([x for _, x in out], pa.binary())], ["bucket", "unit", "run"])

    return stored.select("unit", "data").groupBy("unit").applyInArrow(run, "bucket int, unit long, run binary")


def shared(runs: DataFrame) -> DataFrame:
    """``unit, found``: per unit and bucket the minimizers that two documents hold, of whatever units."""
    def merge(table: pa.Table) -> pa.Table:
        keys, several = [], []
        for data in table.column("run"):
            low, many = spread(data.as_py(), "<u4", "u1")
            keys.append(low)
            several.append(np.unpackbits(many)[: len(low)].astype(bool))
        end = np.cumsum([len(k) for k in keys])
        key = np.concatenate(keys)
        every = np.sort(key)
        hit = np.concatenate(several) | _among(key, np.unique(every[1:][every[1:] == every[:-1]]))
        # what two documents of one unit hold is shared in the others as well
        hit = _among(key, np.unique(key[hit]))
        bucket, names = np.array([table.column("bucket")[0].as_py()], "<i8"), table.column("unit").to_pylist()
        found = [(unit, squeeze(bucket, k[hit[b - len(k) : b]])) for unit, k, b in zip(names, keys, end.tolist(), strict=True) if hit[b - len(k) : b].any()]
        return pa.table([pa.array([u for u, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())], ["unit", "found"])

    return runs.groupBy("bucket").applyInArrow(merge, "unit long, found binary")


def strings(stored: DataFrame, found: DataFrame, list_bits: int, bits: int) -> DataFrame:
    """``bucket, unit, shard, part``: the distinct strings of each unit with a shared minimizer; under bucket -1 where they stand in a shard."""
    def run(table: pa.Table, lists: pa.Table) -> pa.Table:
        pairs = [spread(x.as_py(), "<i8", "<u4") for x in lists.column("found")]
        hot = np.sort(np.concatenate([np.zeros(0, np.uint64), *(np.uint64(b[0]) << np.uint64(32) | v.astype(np.uint64) for b, v in pairs)]))
        names, texts, columns, held, base = table.column("shard").to_pylist(), [], [[np.zeros(0, np.int64)] * 6], [], 0
        for data in table.column("data") if len(hot) else []:
            ids, _, off, buf = _shard(data.as_py())
            n = 0
            for first, s in _pieces_of(off, buf):
                keep = _among(s.minimizer >> np.uint64(32 - list_bits), hot)
                start, windows = s.start[keep], s.windows[keep]
                whole = s.sums.span(start, start + windows + SIZE - 1)
                columns.append([base + off[first] + start, windows, s.at[keep], ids[first + s.doc[keep]], s.minimizer[keep], whole])
                n += len(start)
            held.append((base, n))
            base += len(buf)
            texts.append(buf)
        start, windows, at, doc = (np.concatenate([c[i] for c in columns]) for i in range(4))
        mini, whole = (np.concatenate([c[i].astype(np.uint64) for c in columns]) for i in (4, 5))
        rows = []
        if len(start):
            text, length = np.concatenate(texts), windows + SIZE - 1
            order = np.lexsort((whole, mini))
            head = _heads(mini[order], whole[order])
            begin = np.flatnonzero(head)
            number = np.empty(len(order), np.int64)
            number[order] = np.cumsum(head) - 1
            low, high = np.minimum.reduceat(doc[order], begin), np.maximum.reduceat(doc[order], begin)
            lead = order[begin]
            b = 0
            for name, (base, n) in zip(names, held, strict=True):
                a, b = b, b + n
                if n:
                    rows.append((-1, name, squeeze(np.diff(start[a:b] - base, prepend=0).astype("<u4"), windows[a:b].astype("u1"), number[a:b].astype("<i4"))))
            for k, x, y in _cuts(_by_bucket(mini[lead], bits)):
                p, n = start[lead[x:y]], length[lead[x:y]]
                body = text[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(p, n)]
                # hashes are made again from the text, which compresses better
                rows.append((k, None, squeeze(np.array([x], "<i8"), windows[lead[x:y]].astype("u1"), at[lead[x:y]].astype("u1"), low[x:y], high[x:y] - low[x:y], body)))
        unit = table.column("unit")[0].as_py()
        return pa.table([pa.array([k for k, _, _ in rows], pa.int32()), pa.array([unit] * len(rows), pa.int64()), pa.array([s for _, s, _ in rows], pa.int64()), pa.array([x for _, _, x in rows], pa.binary())], ["bucket", "unit", "shard", "part"])

    return stored.groupBy("unit").cogroup(found.groupBy("unit")).applyInArrow(run, "bucket int, unit long, shard long, part binary")


def suffix_array(text: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Positions in order of their next ``size`` bytes (zeros beyond the end) by Larsson-Sadakane refinement from eight bytes."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key |= padded[i : n + i].astype(np.uint64) << np.uint64(8 * (7 - i))
    sa = np.argsort(key, kind="stable")
    k = key[sa]
    head = np.ones(n, bool)
    head[1:] = k[1:] != k[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.flatnonzero(head)[np.cumsum(head) - 1]
    h = 8
    while h < size:
        step = min(h, size - h)  # prefixes may overlap: h + step bytes are covered
        width = np.diff(np.append(np.flatnonzero(head), n))
        tied = np.flatnonzero(np.repeat(width > 1, width))
        if not len(tied):
            break
        pos = sa[tied]
        after = rank[np.minimum(pos + step, n)]
        order = np.lexsort((after, rank[pos]))
        pos = pos[order]
        sa[tied] = pos
        g, a = rank[pos], after[order]
        new = np.ones(len(pos), bool)
        new[1:] = (g[1:] != g[:-1]) | (a[1:] != a[:-1])
        head[tied] = new
        rank[pos] = tied[new][np.cumsum(new) - 1]
        h += step
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, limit: int = SIZE) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in order, up to ``limit``.

    In Kasai's way the suffixes are taken in text order with their predecessor; eight bytes are compared at a time and
    pairs that differ drop out.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([text, np.zeros(limit + 8, np.uint8)])
    shared_ = np.zeros(n, np.int64)
    live = np.flatnonzero(before >= 0)
    done = 0
    word = np.lib.stride_tricks.sliding_window_view(padded, 8)
    while done < limit and len(live):
        a, b = word[live + done], word[before[live] + done]
        equal = np.ascontiguousarray(a).view(np.uint64)[:, 0] == np.ascontiguousarray(b).view(np.uint64)[:, 0]
        part = live[~equal]
        if len(part):
            shared_[part] = done + np.argmin(a[~equal] == b[~equal], axis=1)
        live = live[equal]
        done += 8
        shared_[live] = done
    return np.minimum(shared_, np.minimum(limit, n - np.arange(n)))[sa]


def smallest(text: np.ndarray, start: np.ndarray, windows: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Smallest ``doc`` of every window of the strings at ``start``, in their order."""
    sa = suffix_array(text)
    head = common_prefixes(text, sa) < SIZE
    head[0] = True
    owner = np.full(len(text), _LAST)
    w = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(start, windows)
    owner[w] = np.repeat(doc, windows)  # other places are no windows
    least = np.minimum.reduceat(owner[sa], np.flatnonzero(head))
    out = np.empty(len(text), np.int64)
    out[sa] = least[np.cumsum(head) - 1]
    return out[w]


def _pieces(key: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of about ``ARRAY`` bytes that keep equal keys (sorted) together: windows with other minimizers differ anyway."""
    edge = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key))
    total = np.concatenate([[0], np.cumsum(size)])[edge]
    out, a = [], 0
    while a < len(edge) - 1:
        b = max(a + 1, int(np.searchsorted(total, total[a] + ARRAY, "right")) - 1)
        out.append((int(edge[a]), int(edge[b])))
        a = b
    return out


def hashes(text: np.ndarray, length: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the minimizer at ``place`` and of the whole of strings that stand one behind the other.

    Prefix sums take some 30 times the bytes they cover, so they cover ``PREFIX`` bytes of whole strings at a time.
    """
    end = np.cumsum(length)
    mini, whole = np.empty(len(length), np.uint64), np.empty(len(length), np.uint64)
    a = base = 0
    while a < len(length):
        b = max(a + 1, int(np.searchsorted(end, base + PREFIX, "right")))
        sums = lex.byte_sums(text[base : end[b - 1]], False)
        at = end[a:b] - length[a:b] - base
        mini[a:b] = sums.span(at + place[a:b], at + place[a:b] + K)
        whole[a:b] = sums.span(at, at + length[a:b])
        a, base = b, int(end[b - 1])
    return mini, whole


def minima(parts: DataFrame) -> DataFrame:
    """``unit, least``: per unit and bucket the smallest doc_id of the windows of its strings, where it is below one of its documents."""
    def merge(table: pa.Table) -> pa.Table:
        cols = [spread(x.as_py(), "<i8", "u1", "u1", "<i8", "<i8", "u1") for x in table.column("part")]
        size = np.array([len(c[1]) for c in cols])
        number = np.concatenate([int(c[0][0]) + np.arange(n, dtype=np.int32) for c, n in zip(cols, size, strict=True)])
        windows, place, low, more, text = (np.concatenate([c[i] for c in cols]) for i in range(1, 6))
        high = low + more
        windows = windows.astype(np.int64)
        length = windows + SIZE - 1
        at = np.cumsum(length) - length
        del cols
        mini, whole = hashes(text, length, place)
        order = np.lexsort((whole, mini))
        a, b = mini[order], whole[order]
        head = np.ones(len(a), bool)
        head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        begin = np.flatnonzero(head)
        kind = np.empty(len(a), np.int64)
        kind[order] = np.cumsum(head) - 1
        lead = order[begin]
        least = np.minimum.reduceat(low[order], begin)
        # minimizers with several strings: their windows are sorted
        m = mini[lead]
        same = np.zeros(len(m) + 1, bool)
        same[1:-1] = m[1:] == m[:-1]
        multi = np.flatnonzero(same[1:] | same[:-1])
        where = np.full(len(lead), -1, np.int64)
        detail = np.zeros(0, np.int64)
        if len(multi):
            found = []
            for x, y in _pieces(m[multi], length[lead[multi]]):
                own = multi[x:y]
                n = length[lead[own]]
                first = np.cumsum(n) - n
                body = text[np.arange(n.sum()) - np.repeat(first, n) + np.repeat(at[lead[own]], n)]
                found.append(smallest(body, first, windows[lead[own]], least[own]))
            detail = np.concatenate(found)
            where[multi] = np.cumsum(windows[lead[multi]]) - windows[lead[multi]]
            # strings whose windows all have one minimum need that number alone
            n = windows[lead[multi]]
            first = where[multi]
            lo, hi = np.minimum.reduceat(detail, first), np.maximum.reduceat(detail, first)
            least[multi], where[multi] = lo, np.where(lo == hi, -1, first)
        unit, out = [], []
        names = table.column("unit").to_pylist()
        for i, (x, y) in enumerate(zip(np.cumsum(size) - size, np.cumsum(size), strict=True)):
            k = kind[x:y]
            one = (where[k] < 0) & (least[k] < high[x:y])
            many = (where[k] >= 0) & (least[k] < high[x:y])
            w = np.where(many, windows[x:y], 0)
            values = detail[np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(where[k], w)]
            if one.any() or many.any():
                unit.append(names[i])
                out.append(squeeze(number[x:y][one], least[k][one], number[x:y][many], w[many].astype("u1"), values))
        return pa.table([pa.array(unit, pa.int64()), pa.array(out, pa.binary())], ["unit", "least"])

    return parts.where("bucket >= 0").groupBy("bucket").applyInArrow(merge, "unit long, least binary")


class Minima:
    """The minima of a unit's strings by their number: one for all windows of a string, or a place in ``detail`` with one for each."""

    def __init__(self, least: list[bytes], top: int):
        self.whole, self.place, table, at = np.full(top, _LAST), np.full(top, -1, np.int64), [np.zeros(0, np.int64)], 0
        for data in least:
            a, v, b, w, values = spread(data, "<i4", "<i8", "<i4", "u1", "<i8")
            self.whole[a] = v
            w = w.astype(np.int64)
            self.place[b] = at + np.cumsum(w) - w
            at += len(values)
            table.append(values)
        self.detail = np.concatenate(table)


def removed(buf: np.ndarray, off: np.ndarray, ids: np.ndarray, start: np.ndarray, windows: np.ndarray, number: np.ndarray, least: Minima) -> np.ndarray:
    """Bytes of a shard's documents to remove."""
    start = np.cumsum(start.astype(np.int64))
    windows = windows.astype(np.int64)
    doc = ids[np.searchsorted(off, start, "right") - 1]
    change = np.zeros(len(buf) + 1, np.int64)
    own = least.whole[number] < doc
    change += np.bincount(start[own], minlength=len(change))
    change -= np.bincount(start[own] + windows[own] + SIZE - 1, minlength=len(change))
    many = least.place[number] >= 0
    w, n = windows[many], windows[many].sum()
    step = np.arange(n) - np.repeat(np.cumsum(w) - w, w)
    hit = least.detail[step + np.repeat(least.place[number[many]], w)] < np.repeat(doc[many], w)
    p = (step + np.repeat(start[many], w))[hit]
    change += np.bincount(p, minlength=len(change))
    change -= np.bincount(p + SIZE, minlength=len(change))
    return np.cumsum(change)[:-1] > 0


class Stored:
    """The shards as a table bucketed by ``unit`` in the scratch folder, dropped with its files at the end of the block."""

    def __init__(self, made: DataFrame):
        self.made, self.spark = made, made.sparkSession
        self.name = f"shards_{uuid.uuid4().hex}"
        self.path = scratch_path(self.spark, "shards")

    def __enter__(self) -> DataFrame:
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))  # as the lists' exchanges, so that joins find equal partitions
        # dealt before the write: one file per bucket, however many tasks made the shards
        self.made.repartition(n, "unit").write.format("parquet").bucketBy(n, "unit").option("path", self.path).saveAsTable(self.name)
        return self.spark.table(self.name)

    def __exit__(self, *_):
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def clean(docs: DataFrame, texts: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row and, on request, the remaining bytes as ``kept``; a stored table."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if texts else [])]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")

    def finish(rows: pa.Table, lists: pa.Table) -> pa.Table:
        both = list(zip(lists.column("shard").to_pylist(), lists.column("part").to_pylist(), strict=True))
        places = {shard: spread(x, "<u4", "u1", "<i4") for shard, x in both if shard is not None}
        least = Minima([x for shard, x in both if shard is None], max((int(p[2].max()) + 1 for p in places.values()), default=0))
        out = []
        for shard, data in zip(rows.column("shard").to_pylist(), rows.column("data"), strict=True):
            ids, known, off, buf = _shard(data.as_py())
            gone = removed(buf, off, ids, *places[shard], least) if shard in places else np.zeros(len(buf), bool)
            n_removed = lex.per_doc(gone.astype(np.int64), off)
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            head = off[:-1][off[:-1] < len(buf)]
            first[head] = gone[head]
            left = [buf[a:b] if not r else buf[a:b][~gone[a:b]] for a, b, r in zip(off[:-1].tolist(), off[1:].tolist(), n_removed.tolist(), strict=True)]
            columns = [pa.array(ids, mask=~known), pa.array(np.diff(off)), pa.array(n_removed), pa.array(lex.per_doc(first.astype(np.int64), off)), pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())]
            out.append(pa.table([*columns, *([pa.array([x.tobytes() for x in left], pa.binary())] if texts else [])], names))
        return pa.concat_tables(out)

    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units = unit_numbers(spark, n, math.ceil(total / UNIT / n) or 1)
    with Stored(shards(docs, units)) as stored:
        list_bits, bits = (max(2, (total // size).bit_length()) for size in (LISTS, BUCKET))
        parts = materialize(strings(stored, shared(minimizers(stored, list_bits)), list_bits, bits), "strings")
        # to one exchange: the places of each shard's strings and, without a shard, the minima of a unit's strings
        lists = parts.where("bucket = -1").select("unit", "shard", "part").unionByName(minima(parts).select("unit", F.lit(None).cast("long").alias("shard"), F.col("least").alias("part")))
        return materialize(stored.groupBy("unit").cogroup(lists.groupBy("unit")).applyInArrow(finish, schema), "repeats")


@query("op1_suffix_array_repeats")
def op1(spark, sf_dir):
    """Repeated strings of all documents."""
    return clean(documents(spark, sf_dir))
