"""Best-fit packing by a grouping genetic algorithm.

A solution assigns pieces to sequences. Crossover injects whole well-filled sequences of one parent into the other,
removes the sequences there that hold any of the same pieces, and best-fits the displaced pieces. Pieces are dealt by a
hash into groups of about ``GROUP``; each group is solved by ``ISLANDS`` populations in tasks of their own, whose elites
migrate around a ring between epochs; the best island's solution wins. Sequences below ``LOOSE`` of the limit are taken
apart and packed once more across groups. Only lengths travel; texts are read once.

A piece of the full length is a sequence by itself. Defined cases: a null or empty text is one piece with the end id
alone; repeated rows are packed each; a null doc_id is carried along; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.llm import tokens
from moorspark.llm.registry import documents, query
from moorspark.session import materialize

TOKENIZER = "word_bpe_49k.json"
END = 0
LIMIT = 2048
GROUP = 4096
ISLANDS = 3
POPULATION = 4
EPOCHS = 2
GENERATIONS = 4
LOOSE = 0.98


def pieces(docs: DataFrame, path: str, end: int = END, limit: int = LIMIT) -> DataFrame:
    """``uid, doc_id, piece, start, length, ids_crc32`` of every document cut at ``limit``; ``uid`` is random and must be stored."""
    def run(batches):
        rng = np.random.default_rng()
        for rows, ids, off in tokens.encode_blocks(batches, path, end):
            n = -(-np.diff(off) // limit)
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            a = off[doc] + piece * limit
            b = np.minimum(a + limit, off[doc + 1])
            yield pa.RecordBatch.from_arrays([pa.array(rng.integers(0, 2**62, len(doc))), rows.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                                              pa.array(piece.astype(np.int64) * limit), pa.array(b - a), pa.array(tokens.crc_spans(ids, a, b))], ["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, f"uid long, doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long")


def best_fit(length: np.ndarray, order: np.ndarray, bins: np.ndarray, room: list[int], limit: int) -> np.ndarray:
    """Put the pieces of ``order`` into the fullest sequence that has room, else a new one; ``bins`` is changed and returned."""
    space = sorted((r, i) for i, r in enumerate(room))
    n = len(room)
    for p in order.tolist():
        x = int(length[p])
        at = bisect.bisect_left(space, (x, -1))
        if at < len(space):
            r, b = space.pop(at)
        else:
            r, b = limit, n
            n += 1
        bins[p] = b
        if r > x:
            bisect.insort(space, (r - x, b))
    return bins


def fitness(length: np.ndarray, bins: np.ndarray, limit: int) -> float:
    """Few and full sequences score high."""
    fill = np.bincount(bins, length)
    return float(np.mean((fill[fill > 0] / limit) ** 2)) if len(bins) else 0.0


def crossover(length: np.ndarray, a: np.ndarray, b: np.ndarray, rng: np.random.Generator, limit: int) -> np.ndarray:
    """A child of ``a`` with some of the fullest sequences of ``b``."""
    fill = np.bincount(b, length)
    full = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 2)]
    give = full[rng.random(len(full)) < 0.5]
    taken = np.isin(b, give)
    hit = np.zeros(a.max() + 1, bool)
    hit[a[taken]] = True
    stay = ~taken & ~hit[a]
    loose = np.flatnonzero(~taken & hit[a])
    child = np.full(len(a), -1, np.int64)
    _, child[stay] = np.unique(a[stay], return_inverse=True)
    n = child.max(initial=-1) + 1
    _, own = np.unique(b[taken], return_inverse=True)
    child[taken] = own + n
    kept = child >= 0
    room = (limit - np.bincount(child[kept], length[kept])).astype(int).tolist() if kept.any() else []
    return best_fit(length, loose[np.argsort(-length[loose], kind="stable")], child, room, limit)


def seed(length: np.ndarray, rng: np.random.Generator, limit: int, population: int = POPULATION) -> list[np.ndarray]:
    """Best-fit decreasing and variants of it with disturbed order."""
    out = []
    for i in range(population):
        noise = length * (1 + 0.1 * i * (rng.random(len(length)) - 0.5))
        out.append(best_fit(length, np.argsort(-noise, kind="stable"), np.zeros(len(length), np.int64), [], limit))
    return out


def evolve(length: np.ndarray, people: list[np.ndarray], rng: np.random.Generator, limit: int, generations: int = GENERATIONS) -> list[np.ndarray]:
    """Steady state: each child replaces the worst if it is better; best first."""
    people = sorted(people, key=lambda p: -fitness(length, p, limit))
    least = -(-int(length.sum()) // limit)
    for _ in range(generations * len(people)):
        if people[0].max(initial=-1) + 1 <= least or len(people) < 2:
            break
        i, j = rng.choice(len(people), 2, replace=False)
        child = crossover(length, people[i], people[j], rng, limit)
        if fitness(length, child, limit) > fitness(length, people[-1], limit):
            people = sorted([*people[:-1], child], key=lambda p: -fitness(length, p, limit))
    return people


_STATE = "grp long, island int, uids binary, lengths binary, people binary, elite binary, fit double"


def _row(grp, island, uids, lengths, people, limit):
    return {"grp": grp, "island": island, "uids": uids.astype("<i8").tobytes(), "lengths": lengths.astype("<i4").tobytes(), "people": np.stack(people).astype("<i4").tobytes(),
            "elite": people[0].astype("<i4").tobytes(), "fit": fitness(lengths, people[0], limit)}


def _solve(rest: DataFrame, limit: int, groups: int, level: int) -> DataFrame:
    """``uid, seq, at`` of pieces shorter than the limit."""
    def start(key, pdf):
        grp, island = int(key[0]), int(key[1])
        pdf = pdf.sort_values("uid", kind="stable")
        length = pdf["length"].to_numpy(np.int64)
        rng = np.random.default_rng([grp, island, level])
        return pd.DataFrame([_row(grp, island, pdf["uid"].to_numpy(), length, evolve(length, seed(length, rng, limit), rng, limit), limit)])

    def epoch(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                length = np.frombuffer(r.lengths, "<i4").astype(np.int64)
                people = list(np.frombuffer(r.people, "<i4").astype(np.int64).reshape(-1, len(length)))
                people[-1] = np.frombuffer(r.guest, "<i4").astype(np.int64)
                rng = np.random.default_rng([r.grp, r.island, level, r.epoch])
                out.append(_row(r.grp, r.island, np.frombuffer(r.uids, "<i8"), length, evolve(length, people, rng, limit), limit))
            yield pd.DataFrame(out)

    def spread(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                length, bins = np.frombuffer(r.lengths, "<i4").astype(np.int64), np.frombuffer(r.elite, "<i4").astype(np.int64)
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(length[order]) - length[order]
                first = np.concatenate([[True], np.diff(bins[order]) != 0])
                at = before - before[first][np.cumsum(first) - 1]
                yield pd.DataFrame({"uid": np.frombuffer(r.uids, "<i8")[order], "seq": ((r.grp * 64 + level) << 24) + bins[order], "at": at, "fill": np.bincount(bins, length)[bins[order]].astype(np.int64)})

    dealt = rest.select("uid", "length", F.expr(f"pmod(xxhash64(uid, {level}), {groups})").alias("grp"), F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"))
    state = materialize(dealt.groupBy("grp", "island").applyInPandas(start, _STATE), "islands")
    for e in range(1, EPOCHS):
        guests = state.select("grp", ((F.col("island") + 1) % ISLANDS).cast("int").alias("island"), F.col("elite").alias("guest"))
        state = materialize(state.join(guests, ["grp", "island"]).withColumn("epoch", F.lit(e)).mapInPandas(epoch, _STATE), "islands")
    best = state.groupBy("grp").agg(F.expr("max_by(struct(uids, lengths, elite), struct(fit, -island))").alias("b")).select("grp", "b.*")
    return materialize(best.mapInPandas(spread, "uid long, seq long, at long, fill long"), "packed")


def pack(cut: DataFrame, limit: int = LIMIT, group: int = GROUP) -> DataFrame:
    """``sequence_id, offset`` for every row of a stored table of ``uid, length``; other columns stay."""
    n = cut.where(F.col("length") < limit).count()
    small = cut.where(F.col("length") < limit).select("uid", "length")
    first = _solve(small, limit, max(1, -(-n // group)), 0)
    loose = materialize(small.join(first.where(F.col("fill") < LOOSE * limit).select("uid"), "uid"), "loose")
    again = _solve(loose, limit, max(1, -(-loose.count() // group)), 1)
    places = first.where(F.col("fill") >= LOOSE * limit).unionByName(again).select("uid", F.col("seq").alias("sequence_id"), F.col("at").alias("offset"))
    own = cut.where(F.col("length") == limit).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    return cut.where(F.col("length") < limit).join(places, "uid").unionByName(own)


def pack_documents(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Cut and pack all documents."""
    cut = materialize(pieces(docs, path or public_tokenizers.path(TOKENIZER), limit=limit), "pieces")
    return pack(cut, limit).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of everything that the stages before kept."""
    return pack_documents(docs)


@query("op3_grouping_genetic_packing")
def op3(spark, sf_dir):
    """Pack all documents."""
    return pack_documents(documents(spark, sf_dir))
