"""Repair of conversation structure over a suffix-shared automaton.

A conversation becomes a string of symbols, one per row: what must be deleted (blank, duplicate), else the class of the
role's initial, and whether the text is truncated. Distinct strings are read from their ends: sorted by their reverse and
dealt by ranges of it, so that strings with a common suffix are neighbours and each shared suffix is one node that is
worked out once. A node holds, for each state of the grammar ``(s?(ua)+)?``, the cost to go and the first letter of the
best audit; the letter leads to the node and state that hold the rest, so a best suffix is stored once however long it is.
The four moves have different letters, hence the ASCII-least of equally cheap audits is decided by the first one. Nodes
whose costs differ by a constant only are one class, and there are few classes: a step is a look-up.

Rows meet their conversation twice, both times as a sorted stream: first without texts (a digest stands for them), then,
below a header with the audit, with texts. A task holds one letter per row of a conversation, never its texts. A hash over
a whole conversation is one chain by nature, so the query's digest of a very long one is one task's stream.

Defined cases: a null anywhere is one space; a null conv_id is a conversation of its own; rows with equal turns are
ordered by role and digest of the text after damage; a turn that is null comes first; other roles than system, user and
assistant count by their initial, none at all by a symbol that can only be reroled or deleted; a conversation without
rows left has zeros and an empty audit; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.llm.registry import bounded, query
from moorspark.session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: bytes of text in one Arrow batch of repaired rows
BATCH = 1 << 20
_WHITE = " \t\n\x0b\x0c\r"

# states: nothing yet, system, user, assistant
_AFTER = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone`` after planted damage; a dropped row stays with ``gone`` true, for its conv_id."""
    text = F.coalesce("text", F.lit(" "))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.col("__kind")
    d = rows.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("__kind"))
    return d.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("__copy")).drop("__copy")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _sorted(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def signatures(rows: DataFrame) -> DataFrame:
    """Per conversation of ``conv_id, turn, role, text, gone``: its symbols and counts of faults, gaps and illegal neighbours."""
    body = F.rtrim("text", F.lit(_WHITE))
    slim = _keyed(rows).select("conv_id", "turn", "role", "digest", "gone", (body == "").alias("blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))
    slim = materialize(slim, "slim")
    own = ["conv_id", "role", "digest"]
    # few texts occur twice; only those come back as a table of first turns
    first = (slim.where("NOT gone").groupBy(*own).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(*[F.col(c).alias(f"f_{c}") for c in own], "first"))
    same = F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    later = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
    slim = slim.join(first, same, "left").select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "role", "digest", "gone", "blank", "cut", later.alias("later"))

    def run(batches):
        ids, cols = [], [[] for _ in range(6)]
        now, live = None, False

        def close():
            ids.append(now)
            for c, v in zip(cols, ("".join(sig), gaps(), *faults, illegal), strict=True):
                c.append(v)

        def gaps():
            return last - low + 1 - distinct if distinct else 0

        def flush(typ):
            out = pa.RecordBatch.from_arrays([pa.array(ids, typ), *[pa.array(c, t) for c, t in zip(cols, [pa.string(), *[pa.int64()] * 5], strict=True)]],
                                             ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"])
            ids.clear()
            for c in cols:
                c.clear()
            return out

        typ = None
        for b in batches:
            typ = b.schema.field("conv_id").type
            for c, turn, initial, role, digest, gone, blank, cut, later in zip(*[b.column(i).to_pylist() for i in range(9)], strict=True):
                if not live or c != now:
                    if live:
                        close()
                    if len(ids) >= 1000:
                        yield flush(typ)
                    now, live = c, True
                    sig, faults, illegal, distinct, low, last, before, seen = [], [0, 0, 0], 0, 0, None, None, None, None
                if gone:
                    continue
                if turn is not None and turn != last:
                    distinct, low, last = distinct + 1, turn if low is None else low, turn
                dup = later or (turn, role, digest) == seen
                faults[0] += blank
                faults[1] += dup and not blank
                faults[2] += cut and not dup and not blank
                kind = initial if initial in ("s", "u", "a") else "o"
                illegal += before is not None and before + kind not in ("su", "ua", "au")
                before, seen = kind, (turn, role, digest)
                sig.append("x" if blank or dup else kind.upper() if cut else kind)
        if live:
            close()
        if typ is not None:
            yield flush(typ)

    typ = dict(rows.dtypes)["conv_id"]
    stream = _sorted(slim, "turn", "role", "digest").select("conv_id", "turn", "initial", "role", "digest", "gone", "blank", "cut", "later")
    return stream.mapInArrow(run, f"conv_id {typ}, signature string, gaps long, blank long, duplicate long, truncated long, illegal long")


def _relaxed(best: list[tuple[int, str]]) -> tuple[tuple[int, str], ...]:
    """Allow insertions before what is already there."""
    for _ in range(2):
        best = [min(b, (INSERT + best[_AFTER[s]][0], "I")) for s, b in enumerate(best)]
    return tuple(best)


_NEVER = 1 << 40
END = _relaxed([(0, ""), (_NEVER, "~"), (_NEVER, "~"), (0, "")])


@functools.lru_cache(None)
def step(symbol: str, costs: tuple[int, ...]) -> tuple[tuple[int, str], ...]:
    """Cost to go and first letter per state, before a row with ``symbol``, from the costs after it."""
    out = []
    for s in range(4):
        options = [(DELETE + costs[s], "D")]
        if symbol != "x":
            extra = TRUNCATED if symbol.isupper() else 0
            kept = _KEEP[symbol.lower()].get(s)
            if kept is not None:
                options.append((KEEP + extra + costs[kept], "K"))
            options.append((REROLE + extra + costs[_AFTER[s]], "R"))
        out.append(min(options))
    return _relaxed(out)


class Suffixes:
    """The nodes along one string of the automaton, from its end; the next string keeps those of the common suffix."""

    def __init__(self):
        self.classes: list[tuple[tuple[int, ...], tuple[str, ...]]] = []
        self.number: dict = {}
        self.steps: dict[tuple[str, int], tuple[int, int]] = {}
        self.path = ""
        first, base = self._class(END)
        self.node, self.base = array("H", [first]), array("q", [base])

    def _class(self, best) -> tuple[int, int]:
        base = min(c for c, _ in best)
        key = (tuple(c - base for c, _ in best), tuple(x for _, x in best))
        if key not in self.number:
            self.number[key] = len(self.classes)
            self.classes.append(key)
        return self.number[key], base

    def read(self, reverse: str) -> tuple[int, str]:
        """Cost and best audit of the string whose reverse is given."""
        same, end = 0, min(len(reverse), len(self.path))
        if reverse[:end] == self.path[:end]:
            same = end
        else:
            low, high = 0, end  # longest common prefix by halving
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if reverse[:mid] == self.path[:mid] else (low, mid)
            same = low
        del self.node[same + 1:], self.base[same + 1:]
        for x in reverse[same:]:
            key = (x, self.node[-1])
            if key not in self.steps:
                self.steps[key] = self._class(step(x, self.classes[key[1]][0]))
            to, more = self.steps[key]
            self.node.append(to)
            self.base.append(self.base[-1] + more)
        self.path = reverse
        at, state, audit = len(reverse), 0, []
        cost = self.base[at] + self.classes[self.node[at]][0][0]
        while True:
            letter = self.classes[self.node[at]][1][state]
            if not letter:
                return cost, "".join(audit)
            audit.append(letter)
            state = state if letter == "D" else _KEEP[reverse[at - 1].lower()][state] if letter == "K" else _AFTER[state]
            at -= letter != "I"


def audits(signature: DataFrame) -> DataFrame:
    """``signature, cost, audit`` for each distinct signature."""
    def run(batches):
        trie = Suffixes()
        for b in batches:
            back = b.column(0).to_pylist()
            found = [trie.read(r) for r in back]
            yield pa.RecordBatch.from_arrays([pa.array([r[::-1] for r in back], pa.string()), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], ["signature", "cost", "audit"])

    back = signature.select("signature").distinct().select(F.reverse("signature").alias("back"))
    return back.repartitionByRange("back").sortWithinPartitions("back").mapInArrow(run, "signature string, cost long, audit string")


def plan(rows: DataFrame) -> DataFrame:
    """Counts, cost and audit of each conversation of ``conv_id, turn, role, text, gone`` (a stored table)."""
    found = materialize(signatures(rows), "signatures")
    return materialize(found.join(materialize(audits(found), "audits"), "signature"), "plans")


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``conv_id, role, text`` of the repaired conversations, each as neighbouring rows of one partition in their order."""
    typ = dict(rows.dtypes)["conv_id"]
    head = plans.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"))
    body = _keyed(rows.where("NOT gone")).select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", "digest", "text")

    def run(batches):
        names = ["conv_id", "role", "text"]
        ids, roles, texts, held = [], [], [], 0
        audit, at, state, now, typ = "", 0, 0, None, pa.int64()
        for b in batches:
            typ = b.schema.field("conv_id").type
            for c, kind, role, text in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                # insertions before this row, or at the end of the conversation before
                while at < len(audit) and audit[at] == "I":
                    state = _AFTER[state]
                    ids.append(now), roles.append(_ROLE[state]), texts.append("")
                    at += 1
                if kind == 0:
                    audit, at, state, now = text, 0, 0, c
                    continue
                letter = audit[at]
                at += 1
                if letter != "D":
                    state = _KEEP[role[:1]][state] if letter == "K" else _AFTER[state]
                    ids.append(now), roles.append(role if letter == "K" else _ROLE[state]), texts.append(text)
                    held += len(text)
                if held > BATCH or len(ids) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, typ), pa.array(roles, pa.string()), pa.array(texts, pa.string())], names)
                    ids, roles, texts, held = [], [], [], 0
        for letter in audit[at:]:
            state = _AFTER[state]
            ids.append(now), roles.append(_ROLE[state]), texts.append("")
        yield pa.RecordBatch.from_arrays([pa.array(ids, typ), pa.array(roles, pa.string()), pa.array(texts, pa.string())], names)

    stream = _sorted(head.unionByName(body), "kind", "turn", "role", "digest").select("conv_id", "kind", "role", "text")
    return stream.mapInArrow(run, f"conv_id {typ}, role string, text string")


def digests(fixed: DataFrame) -> DataFrame:
    """``conv_id, sha256`` over ``role:text`` lines of what :func:`repaired` returns; no row for an empty conversation."""
    def run(batches):
        now, h, ids, out, typ = None, None, [], [], None
        for b in batches:
            typ = b.schema.field("conv_id").type
            for c, role, text in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                if h is None or c != now:
                    if h is not None:
                        ids.append(now), out.append(h.hexdigest())
                    now, h = c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
        if h is not None:
            ids.append(now), out.append(h.hexdigest())
        if typ is not None:
            yield pa.RecordBatch.from_arrays([pa.array(ids, typ), pa.array(out, pa.string())], ["conv_id", "sha256"])

    return fixed.mapInArrow(run, f"conv_id {dict(fixed.dtypes)['conv_id']}, sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired rows of every conversation of :func:`damaged` rows."""
    plans = plan(rows)
    d = digests(repaired(rows, plans)).withColumnRenamed("conv_id", "d_conv_id")
    return plans.join(d, plans.conv_id.eqNullSafe(d.d_conv_id), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


@query("op13_suffix_dawg_conversations")
def op13(spark, sf_dir):
    """Damage and repair of all conversations."""
    return repair(damaged(bounded(spark).read.parquet(f"{sf_dir}/conversations.parquet")))
