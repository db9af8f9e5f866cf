"""Quality rules with cross-document line frequency.

Lines are normalised (words lower-cased, joined by single blanks) and hashed; per host (``source``) the distinct documents
of each line are counted. A line is boilerplate if more than ``MOST`` documents of its host hold it, however many the host
has. Boilerplate lines are removed, and a document left with less than ``DEPLETED`` of its word characters is rejected.

A first pass over the texts gives each document's distinct lines; from then on only hashes move: distinct (host, line,
document) rows, counted with partial sums, and the few boilerplate lines per document. A second pass gets these joined to
the texts, removes them (:func:`cleaned`) and counts; the verdict rests on what is left. The text left is the other lines,
blank ones too, joined by newlines.

Defined cases: a null or blank text has no words and fails the base rules; a null host is a host; rows that share a
doc_id count once in a line's documents but get a row each; lines without words are never boilerplate; an empty table
gives no rows; further columns are ignored; a null text stays null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorspark.llm import lex
from moorspark.llm.registry import LOWER_SQL, documents, query
from moorspark.session import materialize

MOST = 20
DEPLETED = 0.3
WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of equal keys and, in that order, whether a key equals the one before."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k), bool)
    same[1:] = k[1:] == k[:-1]
    return order, same


def in_doc(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within a document."""
    return lex.mix(h + lex.mix(doc.astype(np.uint64) + np.uint64(0x51ED2701)))


def word_chars(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Code points in words per document of a block."""
    return lex.per_doc(((buf & 0xC0) != 0x80) & lex.BLACK[buf], off)


def measure(buf: np.ndarray, off: np.ndarray, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Rule counts and normalised lines of a block of documents."""
    n = len(off) - 1
    w = lex.Words(buf, off, lex.BLACK)
    point = (buf & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(point)])
    chars = points[w.end] - points[w.start]
    word = lex.byte_sums(buf, True).span(w.start, w.end)
    exact = lex.byte_sums(buf, False)
    # windows of words found twice in a document; case counts, so they use the exact words
    case = exact.span(w.start, w.end)
    doc = w.doc
    repeat = np.zeros(len(word), bool)
    if len(word) >= window:
        ok = doc[window - 1 :] == doc[: len(doc) - window + 1]
        first = np.flatnonzero(ok)
        s = lex.Sums(case)
        order, same = repeats(in_doc(s.span(first, first + window), doc[first]))
        twice = same.copy()
        twice[:-1] |= same[1:]
        repeat = lex.cover(first[order[twice]], window, len(word))
    # lines: ends at newlines and document ends
    new = np.flatnonzero(buf == 10)
    start = np.sort(np.concatenate([off[:-1], new + 1]), kind="stable")
    end = np.sort(np.concatenate([off[1:], new]), kind="stable")
    line_doc = np.searchsorted(off[1:], end, "left") if len(buf) else np.zeros(len(end), np.int64)
    a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    full = b > a
    start, end, line_doc, a, b = start[full], end[full], line_doc[full], a[full], b[full]
    line_doc = doc[a] if len(a) else line_doc
    order, same = repeats(in_doc(exact.span(start, end), line_doc))
    dup = np.bincount(line_doc[order[same]], minlength=n)
    return {"n_words": w.counts, "word_chars": lex.per_doc(chars, w.ptr), "n_symbols": lex.per_doc(_SYMBOL[buf].astype(np.int64), off), "n_dup_lines": dup,
            "n_repeat_words": lex.per_doc(repeat.astype(np.int64), w.ptr), "line": lex.Sums(word).span(a, b), "line_doc": line_doc, "line_start": start, "line_end": end}


def without(buf: np.ndarray, off: np.ndarray, m: dict[str, np.ndarray], gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a block without the lines ``gone`` of its measure ``m``."""
    n = len(buf)
    start, end, doc = (m[c][gone] for c in ("line_start", "line_end", "line_doc"))
    last = end == off[doc + 1]
    keep = ~lex.cover(start, np.where(last, end, end + 1) - start, n)
    # without its last line a text ends where the last kept line does, before that line's newline
    kept = np.concatenate([[0], np.cumsum(keep)])
    at = np.flatnonzero(keep)
    short = doc[last]
    short = short[kept[off[short + 1]] > kept[off[short]]]
    keep[at[kept[off[short + 1]] - 1]] = False
    return buf[keep], np.concatenate([[0], np.cumsum(keep)])[off]


def _content() -> Column:
    """Equal for rows that have the same lines to lose."""
    return F.xxhash64("doc_id", "source", F.isnull("source"), "text").alias("content")


def _read(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.col("source").cast("string").alias("source")).select("*", _content())


def measured(docs: DataFrame) -> DataFrame:
    """``uid, content, doc_id, source`` and the hashes of the distinct ``lines`` per row; to be stored."""
    def run(batches):
        rng = np.random.default_rng()
        for batch in batches:
            for rows, buf, off in lex.blocks(batch):
                m = measure(buf, off)
                order, same = repeats(in_doc(m["line"], m["line_doc"]))
                lead = order[~same]
                lead = lead[np.argsort(m["line_doc"][lead], kind="stable")]
                ptr = np.searchsorted(m["line_doc"][lead], np.arange(rows.num_rows + 1))
                lines = pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(m["line"][lead].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(rng.integers(-(2**63), 2**63 - 1, rows.num_rows)), rows.column("content"), rows.column("doc_id"), rows.column("source"), lines],
                                                 ["uid", "content", "doc_id", "source", "lines"])

    return _read(docs).mapInArrow(run, f"uid long, content long, doc_id {dict(docs.dtypes)['doc_id']}, source string, lines array<long>")


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def boilerplate(rows: DataFrame) -> DataFrame:
    """``host, line`` of the lines above the limit."""
    host = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("host")
    return (rows.select(host, F.coalesce("doc_id", "uid").alias("d"), F.explode("lines").alias("line")).distinct()
            .groupBy("host", "line").agg(F.count("*").alias("held")).where(F.col("held") > MOST).select("host", "line"))


def cleaned(docs: DataFrame) -> DataFrame:
    """``doc_id, source, text``, the text without its boilerplate lines, with the rule counts of the whole text and ``n_boilerplate_chars``, per row."""
    rows = materialize(measured(docs), "lines")
    bad = materialize(boilerplate(rows), "boilerplate")
    host = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("host")
    lost = materialize(rows.select("content", host, F.explode("lines").alias("line")).join(bad, ["host", "line"]).groupBy("content").agg(F.collect_set("line").alias("bad")), "lost")

    def run(batches):
        for batch in batches:
            for rows, buf, off in lex.blocks(batch):
                m = measure(buf, off)
                bad = rows.column("bad")
                owner = pc.list_parent_indices(bad).to_numpy(zero_copy_only=False).astype(np.int64)
                gone = np.isin(in_doc(m["line"], m["line_doc"]), in_doc(bad.flatten().to_numpy(zero_copy_only=False).view(np.uint64), owner))
                left, at = without(buf, off, m, gone)
                text = pa.LargeStringArray.from_buffers(rows.num_rows, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(left)).cast(pa.string())
                text = pc.if_else(pc.is_valid(rows.column("text")), text, pa.scalar(None, pa.string()))
                lost = m["word_chars"] - word_chars(left, at)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("source"), text, *(pa.array(m[c].astype(np.int64)) for c in COUNTS), pa.array(lost.astype(np.int64))],
                                                 ["doc_id", "source", "text", *COUNTS, "n_boilerplate_chars"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, source string, text string, {', '.join(f'{c} long' for c in COUNTS)}, n_boilerplate_chars long"
    # one plan at every size: the lost lines grow with the texts, so they are merged with them and never broadcast
    return _read(docs).join(lost.hint("merge"), "content", "left").select("doc_id", "source", "text", "bad").mapInArrow(run, schema)


def judge(docs: DataFrame) -> DataFrame:
    """Rule counts, ``n_boilerplate_chars`` and verdicts per row, from the cleaned texts."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    left = F.col("word_chars") - F.col("n_boilerplate_chars")
    return cleaned(docs).withColumn("base_failed", failed).withColumn("kept", ~failed & (left >= DEPLETED * F.col("word_chars"))).select("doc_id", *COUNTS, "n_boilerplate_chars", "base_failed", "kept")


_BLACK = r"'[^\x20\x09-\x0D]+'"
SQL = f"""WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_BLACK}) AS w FROM documents),
 l AS (SELECT doc_id, host, line, array_to_string(regexp_extract_all({LOWER_SQL.format('line')}, {_BLACK}), ' ') AS norm, list_sum(list_transform(regexp_extract_all(line, {_BLACK}), lambda x: length(x))) AS chars
  FROM (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, {_BLACK})),
 bad AS (SELECT host, norm FROM l GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > {MOST}),
 lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN bad.norm IS NOT NULL THEN chars ELSE 0 END) AS lost FROM l LEFT JOIN bad ON bad.host = l.host AND bad.norm = l.norm GROUP BY 1),
 win AS (SELECT doc_id, s, array_to_string(w[s : s + {WINDOW - 1}], ' ') AS x FROM d, unnest(range(1, len(w) - {WINDOW - 2})) u(s)),
 rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS c FROM win) , unnest(range(s, s + {WINDOW})) u(p) WHERE c > 1 GROUP BY 1),
 m AS (SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
 NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND word_chars - lost >= {DEPLETED} * word_chars AS kept FROM m"""


@query("op7_line_frequency_quality", SQL)
def op7(spark, sf_dir):
    """Rules for all documents."""
    return judge(documents(spark, sf_dir)).drop("n_boilerplate_chars")
