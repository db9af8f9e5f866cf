"""Language identification by bit-sliced Bloom filters over byte n-grams.

Each n-gram (4 lower-cased bytes of a letter run with its borders) sets one bit per language in ``HASHES`` rows of one
table; row r holds a bit for every language, so the AND of an n-gram's rows is the mask of all languages that contain it.
A document's count per language, less the share expected from false positives, decides. A language owns an n-gram if its
rate there is at least ``SHARE`` of its highest rate in any language; the ``PER_LANGUAGE`` most frequent ones of each
language go into the filter, which bounds the model whatever the corpus.

The counts behind the model come from all learning rows (those with crc32 of the id modulo 5 not 0 and a label); they are
summed per task before they are shuffled. Defined cases: a null or letterless text is ``und`` with score 0, ties between
languages go to the first name, with nothing to learn from every text is ``und``; repeated rows are scored alike; an empty
table gives no rows; further columns are ignored. More than 64 labels raise an error.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorspark.llm import lex
from moorspark.llm.registry import documents, query

#: documented bounds of the model
PER_LANGUAGE = 1 << 13
SLOTS = 1 << 18
HASHES = 2
SHARE = 0.2
#: the pipeline keeps a document whose best language holds at least this share of its n-grams
KEEP = 0.2

_LETTER = lex.byte_class([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


def grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte n-grams (non-letters as blanks, at least two letters bytes inside) and the first of each document."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    table = np.where(_LETTER, lex.lower_bytes(np.arange(256, dtype=np.uint8)), 32).astype(np.uint32)
    c = np.full(n + 3, 32, np.uint32)
    c[1 : n + 1] = table[buf]
    g = c[:n] | c[1 : n + 1] << np.uint32(8) | c[2 : n + 2] << np.uint32(16) | c[3 : n + 3] << np.uint32(24)
    # gram i holds bytes i-1..i+2; bytes of other documents count as blanks
    head = off[:-1][off[:-1] < n]
    g[head] &= np.uint32(0xFFFFFF00)
    g[head] |= np.uint32(32)
    for back, mask, blank in ((1, 0x0000FFFF, 0x20200000), (2, 0x00FFFFFF, 0x20000000)):
        tail = off[1:] - back
        tail = tail[tail >= off[:-1]]
        g[tail] = g[tail] & np.uint32(mask) | np.uint32(blank)
    keep = (c[1 : n + 1] != 32) & (c[2 : n + 2] != 32)
    keep[off[1:][off[1:] > off[:-1]] - 1] = False
    at = np.concatenate([[0], np.cumsum(keep)])
    return g[keep], at[off]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _slots(g: np.ndarray) -> list[np.ndarray]:
    h = g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return [(h >> np.uint64(64 - 18 - 20 * i) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]


def learning(key: str = "doc_id") -> F.Column:
    """Rows that the model may learn from."""
    return (F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 0) & F.col("lang").isNotNull()


def count_grams(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all learning rows; each task sums before it emits."""
    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            for lang, (g, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for rows, buf, off in lex.blocks(batch):
                g, ptr = grams(buf, off)
                langs = np.array(rows.column("lang").to_pylist(), dtype=object)
                of = np.repeat(np.arange(len(langs)), np.diff(ptr))
                for lang in sorted(set(langs)):
                    own = g[np.isin(of, np.flatnonzero(langs == lang))]
                    u, n = np.unique(own, return_counts=True)
                    if lang in held:
                        both, at = np.unique(np.concatenate([held[lang][0], u]), return_inverse=True)
                        u, n = both, np.bincount(at, np.concatenate([held[lang][1], n])).astype(np.int64)
                    held[lang] = (u, n.astype(np.int64))
                if sum(len(x[0]) for x in held.values()) > 1 << 20:
                    yield from flush()
        yield from flush()

    rows = docs.where(learning()).select("text", "lang")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Languages, the filter's rows of language bits and the false-positive rate per language."""

    def __init__(self, languages: list[str], owned: dict[str, np.ndarray]):
        self.languages = languages
        self.table = np.zeros(SLOTS, np.uint64)
        for i, lang in enumerate(languages):
            for s in _slots(owned[lang].astype(np.uint32)):
                np.bitwise_or.at(self.table, s, np.uint64(1 << i))
        fill = [np.count_nonzero(self.table >> np.uint64(i) & np.uint64(1)) / SLOTS for i in range(len(languages))]
        self.wrong = np.array([f**HASHES for f in fill])

    def shares(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Corrected share of each document's n-grams in each language."""
        g, ptr = grams(buf, off)
        mask = np.full(len(g), np.uint64(2**64 - 1))
        for s in _slots(g):
            mask &= self.table[s]
        n = np.maximum(np.diff(ptr), 1)
        out = np.zeros((len(off) - 1, len(self.languages)))
        for i in range(len(self.languages)):
            hit = lex.per_doc((mask >> np.uint64(i) & np.uint64(1)).astype(np.int64), ptr) / n
            out[:, i] = np.clip((hit - self.wrong[i]) / (1 - self.wrong[i]), 0, 1)
        return out


def fit(docs: DataFrame) -> Model:
    """Learn the filter; at most languages times ``PER_LANGUAGE`` n-grams reach the driver."""
    counts = count_grams(docs)
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    rate = counts.join(F.broadcast(total), "lang").select("lang", "gram", "n", (F.col("n") / F.col("total")).alias("rate"))
    best = rate.groupBy("gram").agg(F.collect_list(F.struct("lang", "n", "rate")).alias("all"), F.max("rate").alias("best"))  # one entry per label
    own = best.select("gram", "best", F.explode("all").alias("x")).where(F.col("x.rate") >= F.col("best") * SHARE).select("gram", "x.lang", "x.n")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))  # cut per task before the shuffle
    top = own.select("lang", "gram", rank.alias("rank")).where(F.col("rank") <= PER_LANGUAGE).groupBy("lang").agg(F.collect_list("gram").alias("grams")).collect()
    if len(top) > 64:
        raise ValueError("more than 64 languages")
    owned = {r["lang"]: np.array(r["grams"], np.int64) for r in top}
    return Model(sorted(owned), owned)


def identify(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The rows with a language and a score in 0 to 1 (share of n-grams in it) appended; only ``text`` is looked at."""
    def run(batches):
        for batch in batches:
            for rows, buf, off in lex.blocks(batch, text):
                share = model.shares(buf, off)
                ascii_letters = lex.per_doc(lex.byte_class([(0x41, 0x5A), (0x61, 0x7A)])[buf].astype(np.int64), off)
                sure = ascii_letters > 0
                for i in np.flatnonzero(~sure & (np.diff(off) > 0)).tolist():
                    sure[i] = has_letter(bytes(buf[off[i] : off[i + 1]]).decode())
                if model.languages:
                    at = share.argmax(1)
                    pred = np.where(sure, np.array(model.languages, object)[at], "und")
                    score = np.where(sure, share[np.arange(len(at)), at], 0.0)
                else:
                    pred, score = np.full(len(off) - 1, "und", object), np.zeros(len(off) - 1)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(pred.tolist(), pa.string()), pa.array(score)], [*rows.schema.names, *names])

    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken; name others")
    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{names[0]}` string", f"`{names[1]}` double"]))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay; letterless ones and those whose n-grams hardly fit any language go."""
    names = ("_language", "_language_score")
    while set(names) & set(docs.columns):
        names = tuple(f"_{n}" for n in names)
    return identify(docs, fit(docs), names=names).where((F.col(names[0]) != "und") & (F.col(names[1]) >= KEEP)).select(*docs.columns)


def held_out(doc_id) -> bool:
    """The fold that the model never sees."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@query("op10_bitmask_language")
def op10(spark, sf_dir):
    """Language of all documents, learned from the rows outside the held-out fold."""
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", "text", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False)).alias("held_out"))
    return identify(rows, fit(docs)).drop("text")
