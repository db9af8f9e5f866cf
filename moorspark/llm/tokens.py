"""Encoding of whole texts by the tokenizers library, with each distinct word encoded once per worker and cache filling.

A plain text (ASCII without apostrophes, Latin letters and signs that no normalisation touches, single blanks and single
newlines) consists of parts between which the pre-tokenizer rules of both files always cut: letters, digits, signs, each with
the blank before it, and newlines. They are found and hashed (64 bits) in numpy, and only distinct parts are encoded. Any other text is cut at single blanks where neither
rule nor merge can reach across (a piece and the blank before it encode alike alone and in place); that fails only where
blanks meet other blanks, where it is cut at blanks between two non-blank characters. A text that holds a special token's
string goes to the library whole. The cache is emptied at ``CACHE`` strings; that bounds memory and changes no result.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.llm import lex

CACHE = 1 << 21
#: bytes of text encoded at once
BLOCK = 1 << 18
#: new parts that one text carries to the library
TOGETHER = 256
#: such texts in one call; the library's results take some hundred bytes an id
CALL = 8

_BAD, _LETTER, _DIGIT, _SIGN, _BLANK, _LINE = range(6)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte below 128, and of the two-byte characters from U+0080 to U+017F by code point less 128."""
    one = np.full(256, _BAD, np.uint8)
    one[0x21:0x7F] = _SIGN
    one[0x30:0x3A] = _DIGIT
    one[0x41:0x5B] = one[0x61:0x7B] = _LETTER
    one[[0x20, 0x0A, 0x27]] = _BLANK, _LINE, _BAD
    two = np.full(256, _LETTER, np.uint8)  # Latin letters from U+00C0
    two[:0x21] = _BAD
    two[0x21:0x40] = _SIGN
    two[[0xD7 - 128, 0xF7 - 128]] = _SIGN
    # letters and numbers among the signs, and the one letter whose lower case is two characters
    two[[x - 128 for x in (0xAA, 0xBA, 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE, 0x130)]] = _BAD
    return one, two


_ONE, _TWO = _classes()
_ODD_BLANK = re.compile(r"[^\S\n ]")
_INNER_BLANK = re.compile(r"(?<=\S) (?=\S)")
_coders: dict[str, Coder] = {}


class Coder:
    """A tokenizer file with a bounded cache of encoded strings.

    Many parts are encoded in one text: behind newlines where a newline is an id of its own, or between blanks where
    the ids that end words are known. Pieces are encoded one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self):
        self.size = 0
        self.index: dict[str, int] = {}  # pieces of other texts
        self.known = np.zeros(0, np.uint64)  # hashes of parts, ascending, with the strings they stand for in ``row``
        self.row = np.zeros(0, np.int64)
        self.begin = np.zeros(1 << 12, np.int64)  # of string i; the next one's is its end
        self.flat = np.zeros(1 << 12, np.uint32)

    def _add(self, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Store encoded strings; their numbers."""
        n, self.size = self.size, self.size + len(lengths)
        end = int(self.begin[n])
        if self.size >= len(self.begin):
            self.begin = np.resize(self.begin, 2 * self.size)
        if end + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (end + len(ids)))
        self.begin[n + 1 : self.size + 1] = end + np.cumsum(lengths)
        self.flat[end : end + len(ids)] = ids
        return np.arange(n, self.size)

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[int] = []
        lengths = []
        for a in range(0, len(texts), 8192):
            for e in self.tokenizer.encode_batch_fast(texts[a : a + 8192], add_special_tokens=False):
                ids += (x := e.ids)
                lengths.append(len(x))
        return np.array(lengths, np.int64), np.array(ids, np.uint32)

    def _together(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of the parts ``buf[begin:end]`` from few texts; where the cuts do not come out as they must, one by one."""
        def singly():
            return self._one_by_one([bytes(buf[x:y]).decode() for x, y in zip(begin.tolist(), end.tolist(), strict=True)])

        if self.line is None and not self.ends.any():
            return singly()
        size = end - begin
        stop = np.cumsum(size + 1)  # each part behind its newline or blank
        joined = np.full(stop[-1], 10 if self.line is not None else 32, np.uint8)
        gap = np.zeros(stop[-1], bool)
        gap[stop - size - 1] = True
        joined[~gap] = buf[np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)]
        raw, skip = joined.tobytes(), int(self.line is None)
        edges = [*(stop[TOGETHER - 1 :: TOGETHER]).tolist()]
        edges = [0, *edges] if edges and edges[-1] == stop[-1] else [0, *edges, int(stop[-1])]
        found = []
        for i in range(0, len(edges) - 1, CALL):
            texts = [raw[x + skip : y].decode() for x, y in zip(edges[i : i + CALL], edges[i + 1 : i + CALL + 1])]  # the last edge is an end alone
            found += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(found)
        if self.line is not None:
            cut = np.flatnonzero(ids == self.line)
            if len(cut) != len(size) or cut[0]:
                return singly()
            return np.diff(np.append(cut, len(ids))) - 1, ids[ids != self.line]
        # letters or signs are one word, digits one each
        last = buf[end - 1]
        words = np.where((last >= 0x30) & (last < 0x3A), size - (buf[begin] == 32), 1)
        done = np.flatnonzero(self.ends[ids]) + 1
        if len(done) != words.sum() or done[-1] != len(ids):
            return singly()
        return np.diff(np.concatenate([[0], done[np.cumsum(words) - 1]])), ids

    def _plain(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all bytes, and which documents are plain."""
        kind = _ONE[buf]
        lead = np.flatnonzero((buf >= 0xC2) & (buf <= 0xC5))
        kind[lead] = kind[lead + 1] = _TWO[(buf[lead].astype(np.int64) - 0xC2) * 64 + buf[lead + 1] - 0x80]
        gap = kind >= _BLANK
        bad = kind == _BAD
        bad[1:] |= gap[1:] & gap[:-1]
        full = np.diff(off) > 0
        bad[off[:-1][full]] |= gap[off[:-1][full]]
        bad[off[1:][full] - 1] |= gap[off[1:][full] - 1]
        return kind, lex.per_doc(bad.astype(np.int64), off) == 0

    def _parts(self, buf: np.ndarray, kind: np.ndarray, off: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cache rows of all parts of the plain documents and the number of parts per document."""
        start = np.ones(len(buf), bool)
        a, b = kind[1:], kind[:-1]
        start[1:] = (a >= _BLANK) | (b == _LINE) | ((b != _BLANK) & (a != b))
        start[off[:-1][off[:-1] < len(buf)]] = True
        inside = np.repeat(plain, np.diff(off))
        begin = np.flatnonzero(start & inside)
        stop = np.append(np.flatnonzero(start), len(buf))
        end = stop[np.searchsorted(stop, begin) + 1]
        counts = np.diff(np.searchsorted(begin, off))
        codes, keys = pd.factorize(lex.byte_sums(buf, False).span(begin, end))
        first = np.empty(len(keys), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        order = np.argsort(keys)
        keys = keys[order]
        at = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), bool)
        inner = at < len(self.known)
        new[inner] = self.known[at[inner]] != keys[inner]
        rows = np.empty(len(keys), np.int64)
        rows[~new] = self.row[at[~new]]
        a, b = begin[first[order[new]]], end[first[order[new]]]
        if len(a):
            line = buf[a] == 10
            fresh = np.empty(len(a), np.int64)
            if line.any():
                fresh[line] = self._add(*self._one_by_one(["\n"]))
            if not line.all():
                fresh[~line] = self._add(*self._together(buf, a[~line], b[~line]))
            rows[new] = fresh
            self.known, self.row = np.insert(self.known, at[new], keys[new]), np.insert(self.row, at[new], fresh)
        back = np.empty(len(keys), np.int64)
        back[order] = rows
        return back[codes], counts

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cache rows of all pieces of other texts and the number of pieces per text."""
        keys, counts = [], []
        for t in texts:
            odd = "  " in t or "\n " in t or " \n" in t or _ODD_BLANK.search(t)
            p = _INNER_BLANK.split(t) if odd else t.split(" ")
            p[0] = " " + p[0]  # a key that begins with a blank is a text's first piece and has none before it
            keys += p
            counts.append(len(p))
        new = [k for k in set(keys) if k not in self.index]
        if new:
            more = self._add(*self._one_by_one([k[1:] if k[:1] == " " else " " + k for k in new]))
            self.index.update(zip(new, more.tolist(), strict=True))
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys)), np.array(counts, np.int64)

    def encode(self, buf: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, each followed by ``end``, and the offsets of the texts."""
        if self.size > CACHE:
            self.clear()
        n = len(off) - 1
        raw = buf.tobytes()
        whole: dict[int, list[int]] = {}
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                d = int(np.searchsorted(off, at, "right")) - 1
                if at + len(s) <= off[d + 1]:
                    whole[d] = []
                at = raw.find(s, at + 1)
        for d in whole:
            whole[d] = self.tokenizer.encode(raw[off[d] : off[d + 1]].decode(), add_special_tokens=False).ids
        kind, plain = self._plain(buf, off)
        plain[list(whole)] = False
        other = [d for d in np.flatnonzero(~plain).tolist() if d not in whole]
        rows, counts = self._parts(buf, kind, off, plain)
        more, each = self._pieces([raw[off[d] : off[d + 1]].decode() for d in other])
        counts[other] = each
        order = np.argsort(np.concatenate([np.repeat(np.arange(n)[plain], counts[plain]), np.repeat(np.array(other, np.int64), each)]), kind="stable") if other else slice(None)
        at = np.concatenate([rows, more])[order]
        length = self.begin[at + 1] - self.begin[at]
        ends = np.cumsum(length)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[at] - (ends - length), length)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        size = np.diff(bounds)
        for d, x in whole.items():
            size[d] = len(x)
        offsets = np.concatenate([[0], np.cumsum(size + 1)])
        out = np.full(offsets[-1], end, np.uint32)
        place = np.ones(offsets[-1], bool)
        place[offsets[1:] - 1] = False
        for d, x in whole.items():
            place[offsets[d] : offsets[d + 1]] = False
            out[offsets[d] : offsets[d + 1] - 1] = x
        out[place] = ids
        return out, offsets


def coder(path: str) -> Coder:
    """The worker's coder for a file."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encode_blocks(batches, path: str, end: int):
    """``(rows, ids, offsets)`` per block of whole documents; a null text is empty."""
    c = coder(path)
    for batch in batches:
        for rows, buf, off in lex.blocks(batch, limit=BLOCK):
            yield rows, *c.encode(buf, off, end)


def binaries(data: np.ndarray, off: np.ndarray) -> pa.Array:
    """A binary column of the spans of ``data`` between neighbouring ``off``."""
    w = data.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer((off * w).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def crc_spans(ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of little-endian unsigned 32-bit ids per span."""
    raw = memoryview(ids.astype("<u4").tobytes())
    return np.fromiter((zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.int64, len(start))


def encoded(docs: DataFrame, path: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` with the ids of each whole text and ``end`` as little-endian 16-bit numbers."""
    def run(batches):
        for rows, ids, off in encode_blocks(batches, path, end):
            if len(ids) and ids.max() > 0xFFFF:
                raise ValueError("ids beyond 16 bits")
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), binaries(ids.astype("<u2"), off)], ["doc_id", "ids"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {dict(docs.dtypes)[key]}, ids binary")
