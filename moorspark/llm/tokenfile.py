"""Token-ID output: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Ids are replaced by their rank in corpus frequency, so the commonest 256 take one byte. A block holds whole documents in
ascending doc_id order: a header, document ids and lengths, then control bytes (two bits a value: bytes minus one, four
values a byte), then the values' bytes. Blocks are the rows of Parquet files, numbered by file and place; the rank table
(one row per id of the vocabulary) is stored beside them. Decoding looks up lengths in a 256-row table per control byte.

The pass that encodes the texts counts the ids too, so the ids are read once more only, to be sorted by document and written.

Defined cases: a null or empty text has the end id alone; rows with a null doc_id come first; repeated ids stand side by
side in order of a hash of their ids; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from moorspark.llm import tokens
from moorspark.llm.registry import documents, query
from moorspark.session import materialize, scratch_path

TOKENIZER = "byte_bpe_50k.json"
END = 2
#: values of a block after which it is closed (a longer document is a block of its own)
BLOCK = 1 << 18

_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> bytes:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = values.astype("<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[: len(v)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    stop = np.cumsum(size, dtype=np.int32)
    at = stop - size
    data = np.empty(int(stop[-1]) if len(v) else 0, np.uint8)
    data[at] = v.astype(np.uint8)
    for i in range(1, int(size.max(initial=0))):
        long = np.flatnonzero(size > i)
        data[at[long] + i] = v[long] >> np.uint32(8 * i)
    return control.tobytes() + data.tobytes()


def unpack(data: bytes | memoryview, n: int) -> tuple[np.ndarray, int]:
    """``n`` values and the number of bytes read."""
    raw = np.frombuffer(data, np.uint8)
    controls = -(-n // 4)
    size = _LENGTHS[raw[:controls]].reshape(-1)[:n]
    stop = np.cumsum(size, dtype=np.int32) + np.int32(controls)
    at = stop - size
    out = raw[at].astype(np.uint32)
    for i in range(1, int(size.max(initial=0))):
        long = np.flatnonzero(size > i)
        out[long] |= raw[at[long] + i].astype(np.uint32) << np.uint32(8 * i)
    return out, int(stop[-1]) if n else controls


def encode_block(doc_ids: list, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    """Bytes of a block; a null doc_id is kept by a bit."""
    known = np.array([d is not None for d in doc_ids], np.uint8)
    ids = np.array([d or 0 for d in doc_ids], "<i8")
    return struct.pack("<4sIQ", b"TKB1", len(doc_ids), len(ranks)) + np.packbits(known).tobytes() + ids.tobytes() + pack(counts) + pack(ranks)


def decode_block(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, counts and ranks of a block."""
    magic, n, total = struct.unpack_from("<4sIQ", data)
    if magic != b"TKB1":
        raise ValueError("not a token block")
    at = 16
    known = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at))[:n]
    at += -(-n // 8)
    ids = np.frombuffer(data, "<i8", n, at)
    at += 8 * n
    view = memoryview(data)
    counts, used = unpack(view[at:], n)
    ranks, _ = unpack(view[at + used :], total)
    return [int(i) if k else None for i, k in zip(ids, known, strict=True)], counts.astype(np.int64), ranks


def counted(docs: DataFrame, path: str, end: int, vocabulary: int) -> DataFrame:
    """``doc_id, ids`` as :func:`tokens.encoded` gives them, and per task one more row with its counts per id in ``seen``; to be stored."""
    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for rows, ids, off in tokens.encode_blocks(batches, path, end):
            if ids.max() > 0xFFFF:
                raise ValueError("ids beyond 16 bits")
            total += np.bincount(ids, minlength=vocabulary)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), tokens.binaries(ids.astype("<u2"), off), pa.nulls(rows.num_rows, pa.binary())], ["doc_id", "ids", "seen"])
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], ["doc_id", "ids", "seen"])

    name = dict(docs.dtypes)["doc_id"]
    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {name}, ids binary, seen binary")


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """16-bit ids of a binary column and their offsets per row."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[off[0] : off[-1]].view("<u2") if data is not None else np.zeros(0, "<u2")
    return flat, (off - off[0]) // 2


def rank_table(ids: DataFrame, vocabulary: int) -> np.ndarray:
    """Rank of each id by falling corpus frequency, ties by id. Its size is the vocabulary's, whatever the corpus.

    Counts of :func:`counted` are summed; without them the ids are counted.
    """
    has = "seen" in ids.columns

    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            if has:
                for x in batch.column("seen"):
                    total += np.frombuffer(x.as_buffer(), "<i8")
            elif batch.num_rows:
                total += np.bincount(_spans(batch.column("ids"))[0], minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["id", "n"])

    rows = ids.where("seen IS NOT NULL").select("seen") if has else ids.select("ids")
    got = rows.mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(vocabulary, np.int64)
    n[[r["id"] for r in got]] = [r["n"] for r in got]
    rank = np.empty(vocabulary, np.uint32)
    rank[np.lexsort((np.arange(vocabulary), -n))] = np.arange(vocabulary)
    return rank


def in_blocks(rows, limit: int):
    """``(doc_ids, counts, ids)`` per block, from ``(doc_ids, ids, offsets)`` in order."""
    held, counts, values = [], [], []
    size = 0
    for docs, ids, off in rows:
        a = 0
        while a < len(docs):
            # as many whole documents as fit, at least one in an empty block
            b = int(np.searchsorted(off, off[a] + limit - size, "right")) - 1
            if b <= a and held:
                yield held, np.array(counts, np.int64), np.concatenate(values)
                held, counts, values = [], [], []
                size = 0
                continue
            b = max(b, a + 1)
            held += docs[a:b]
            counts += np.diff(off[a : b + 1]).tolist()
            values.append(ids[off[a] : off[b]])
            size += int(off[b] - off[a])
            a = b
    if held:
        yield held, np.array(counts, np.int64), np.concatenate(values)


def write(spark: SparkSession, ids: DataFrame, path: str, vocabulary: int) -> None:
    """Write the blocks below ``path``/blocks in ascending doc_id order and the rank table below ``path``/ranks.

    ``ids`` is a stored table of :func:`counted` or :func:`tokens.encoded`.
    """
    rank = rank_table(ids, vocabulary)
    spark.createDataFrame([(int(r), i) for i, r in enumerate(rank.tolist())], "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")

    def run(batches):
        part = TaskContext.get().partitionId()
        rows = ((batch.column("doc_id").to_pylist(), *_spans(batch.column("ids"))) for batch in batches if batch.num_rows)
        for block, (held, counts, flat) in enumerate(in_blocks(rows, BLOCK)):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(flat)], pa.int64()),
                                              pa.array([encode_block(held, counts, rank[flat])], pa.binary())], ["part", "block", "tokens", "payload"])

    rows = ids.where("seen IS NULL") if "seen" in ids.columns else ids
    sorted_ = rows.select("doc_id", "ids", F.xxhash64("ids").alias("tie")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    sorted_.select("doc_id", "ids").mapInArrow(run, "part int, block int, tokens long, payload binary").write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document from the files alone."""
    table = {r["rank"]: r["id"] for r in spark.read.parquet(f"{path}/ranks").collect()}  # one row per id of the vocabulary
    ids = np.array([table[i] for i in range(len(table))], np.uint32)
    blocks = spark.read.parquet(f"{path}/blocks")

    def run(batches):
        for batch in batches:
            for part, block, data in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "payload")), strict=True):
                doc, n, ranks = decode_block(data)
                end = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(doc), pa.int32()), pa.array([block] * len(doc), pa.int32()), pa.array(doc, pa.int64()), pa.array(end - n),
                                                  pa.array(n), pa.array(tokens.crc_spans(ids[ranks], end - n, end))], ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = blocks.mapInArrow(run, "part int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")
    size = blocks.select("part", "block", "tokens")
    before = lambda w: F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")
    files = size.groupBy("part").agg(F.sum("tokens").alias("tokens"))  # one row per file
    base = size.select("part", "block", before(Window.partitionBy("part").orderBy("block")).alias("base")).join(
        files.select("part", before(Window.orderBy("part")).alias("first")), "part")
    return rows.join(base, ["part", "block"]).select("doc_id", (F.col("first") + F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


@query("op5_ranked_vbyte_tokens")
def op5(spark, sf_dir):
    """Encode all documents, write the files, read them back."""
    path = public_tokenizers.path(TOKENIZER)
    vocabulary = tokens.coder(path).tokenizer.get_vocab_size()
    ids = materialize(counted(documents(spark, sf_dir), path, END, vocabulary), "ids")
    out = scratch_path(spark, "tokens")
    write(spark, ids, out, vocabulary)
    return read(spark, out)
