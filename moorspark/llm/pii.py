r"""Personal data by candidate gradient boosting, in DataFrame functions alone.

The contract's kinds (email, ip, card, phone) are found by their patterns and checks and always stay. High-recall generators
propose further, overlapping spans: anything with an at sign, any number with separators, any long unbroken token.
Each gets bits for its format and context. Boosted trees of depth two score the bits; a threshold calibrated on all
candidates (share of positives among those that score at least as high) selects, and overlapping selected
spans stay by falling score, each unless it overlaps one that stays.

Labels come from the data: a number or address is positive if it passes a contract check, a token if an assignment to a
credential name stands before it (the trees do not see that name for tokens, so they learn the tokens' format). Training
reads every candidate, but only counts per combination of bits reach the driver: at most 2^``BITS`` times three rows.

Span starts come from the lengths between matches (``split``) and of matches (``regexp_extract_all``), both once per
kind. Where the contract's patterns could take quadratic time, starts inside a run that failed at its first character are
skipped; the matches are the same. Defined cases: a null text is empty and stays null when redacted; repeated rows are
treated each; a null doc_id is carried along; without candidates nothing is added; an empty table gives no rows; further
columns are ignored or, in the stage, kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorspark.llm.registry import documents, query
from moorspark.session import materialize

TREES = 12
RATE = 0.5
PRECISION = 0.98
#: the calibration goes through combinations of bits seen this often first, so that a rare one cannot undo their threshold
SEEN = 5
CONTEXT = 24

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Fixed values of the contract: kinds in order with their patterns.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "address": r"(?:\G|(?<![^\s@\"'<>()]))[^\s@\"'<>()]++@[^\s@\"'<>()]++",
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9][0-9 ().-]{5,40}+(?<=[0-9])",
    "secret": r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+",
}
#: what must be in a text for a kind's pattern to be tried: a part of every match (of every card that passes its check)
#: that is cheaper to look for
_NEEDS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike("[0-9][.][0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda text: F.contains(text, F.lit("+")),
    "address": lambda text: F.contains(text, F.lit("@")),
    "number": lambda text: text.rlike("[0-9][0-9 ().-]{5}"),
    # a token lies between two blanks; few words are that long, so few meet the class
    "secret": lambda text: F.exists(F.split(text, " "), lambda word: (F.octet_length(word) >= 20) & word.rlike("[A-Za-z0-9_/+-]{20}")),
}
_CUE = r"(?i)(?:tel|phone|call|mail|contact|card|iban|ssn|passport|account)\W{0,4}$"
_ASSIGNED = r"(?i)(?:token|key|secret|passw(?:or)?d|credential)s?\W{1,5}$"
_SPAN = "array<struct<start:int,ord:int,kind:string,end:int,text:string>>"


def _matches(text: Column, kind: str, order: int, pattern: str) -> Column:
    """Spans of all matches, or none in a text without what the kind needs; code points, end exclusive."""
    body = F.coalesce(text, F.lit(""))
    both = F.zip_with(F.split(body, pattern, -1), F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), lambda b, m: F.struct(F.length(b).alias("b"), m.alias("m")))
    empty = F.struct(F.lit(0).alias("at"), F.expr(f"CAST(array() AS {_SPAN})").alias("out"))

    def step(acc, x):
        start = acc["at"] + x["b"]
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("text"))
        return F.when(x["m"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out")))

    found = F.aggregate(both, empty, step, lambda acc: acc["out"])
    return F.when(_NEEDS[kind](text), found).otherwise(F.expr(f"CAST(array() AS {_SPAN})"))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _passes(kind: str, s: Column) -> Column:
    if kind == "ip":
        return s.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")
    d = _digits(s)
    if kind == "card":
        return F.length(d).between(14, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(d).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """The contract's spans in order of start, then kind."""
    def valid(kind):
        return lambda x: _passes(kind, x["text"])

    return F.sort_array(F.concat(*[F.filter(_matches(text, k, i, p), valid(k)) for i, (k, p) in enumerate(BASE.items())]))


# each bit: (candidate, text before, kind) -> condition
_BITS = [
    lambda s, before, kind: F.contains(s, F.lit("@")),
    lambda s, before, kind: s.rlike(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"),
    lambda s, before, kind: s.startswith("+"),
    lambda s, before, kind: F.length(_digits(s)).between(10, 15),
    lambda s, before, kind: F.length(_digits(s)).between(14, 19),
    lambda s, before, kind: F.call_function("luhn_check", _digits(s)),
    lambda s, before, kind: s.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"),
    lambda s, before, kind: s.rlike("[0-9]") & s.rlike("[A-Za-z]"),
    lambda s, before, kind: s.rlike("^[0-9a-f]+$"),
    lambda s, before, kind: F.length(s) >= 32,
    lambda s, before, kind: s.rlike("[-_/+]"),
    lambda s, before, kind: before.rlike("[\"'=:]$"),
    lambda s, before, kind: before.rlike(_CUE),
]
BITS = len(_BITS)


def _candidate(text: Column):
    def make(x: Column) -> Column:
        before = F.substring(text, F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT)))
        code = sum((F.when(b(x["text"], before, x["kind"]), 1 << i).otherwise(0) for i, b in enumerate(_BITS)), F.lit(0))
        s = x["text"]
        good = F.when(x["kind"] == "secret", before.rlike(_ASSIGNED)).when(x["kind"] == "address", s.rlike("^[A-Za-z0-9._%+-]+" + r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$")).otherwise(
            _passes("ip", s) | (s.rlike(r"^[0-9](?:[\x20-]?[0-9])+$") & _passes("card", s)) | (s.rlike(r"^\+[0-9][\x20().0-9-]+[0-9]$") & _passes("phone", s)))
        return F.struct(x["start"].alias("start"), x["ord"].alias("ord"), x["kind"].alias("kind"), x["end"].alias("end"), code.alias("code"), good.alias("good"))

    return make


def candidates(text: Column) -> Column:
    """Overlapping candidate spans of all generators with their bits and label."""
    spans = F.concat(*[_matches(text, k, len(BASE) + i, p) for i, (k, p) in enumerate(GENERATORS.items())])
    return F.transform(spans, _candidate(text))


class Boosted:
    """Trees of depth two over bits, fitted to counts per combination, and a calibrated threshold per kind."""

    def __init__(self, cells: list[tuple[str, int, int, int]], trees: int = TREES, rate: float = RATE):
        """``cells``: kind, code, candidates, positives."""
        self.kinds = sorted({c[0] for c in cells})
        rows = [([*(code >> i & 1 for i in range(BITS)), *(int(kind == k) for k in self.kinds)], n, p) for kind, code, n, p in sorted(cells)]
        width = BITS + len(self.kinds)
        total, good = sum(r[1] for r in rows), sum(r[2] for r in rows)
        self.start = math.log((good + 1) / (total - good + 1)) if total else 0.0
        score = [self.start] * len(rows)
        self.trees: list[tuple[int, int, int, list[float]]] = []
        for _ in range(trees if rows else 0):
            p = [1 / (1 + math.exp(-s)) for s in score]
            grad = [r[2] - r[1] * q for r, q in zip(rows, p, strict=True)]
            hess = [r[1] * q * (1 - q) for r, q in zip(rows, p, strict=True)]

            def gain(part: list[int], i: int, grad=grad, hess=hess) -> float:
                out = 0.0
                for v in (0, 1):
                    own = [k for k in part if rows[k][0][i] == v]
                    out += sum(grad[k] for k in own) ** 2 / (sum(hess[k] for k in own) + 1)
                return out

            every = list(range(len(rows)))
            root = max(range(width), key=lambda i: (gain(every, i), -i))
            sides = [[k for k in every if rows[k][0][root] == v] for v in (0, 1)]
            below = [max(range(width), key=lambda i, part=part: (gain(part, i), -i)) for part in sides]
            leaves = []
            for part, i in zip(sides, below, strict=True):
                for v in (0, 1):
                    own = [k for k in part if rows[k][0][i] == v]
                    leaves.append(rate * sum(grad[k] for k in own) / (sum(hess[k] for k in own) + 1))
                    for k in own:
                        score[k] += leaves[-1]
            self.trees.append((root, below[0], below[1], leaves))
        # calibration: the lowest score down to which the positives' share stays high, among combinations seen often, then
        # further down (from the top where those give none) among all
        self.threshold = {}
        for kind in self.kinds:
            own = sorted(((round(s, 9), c[2], c[3]) for s, c in zip(score, sorted(cells), strict=True) if c[0] == kind), reverse=True)
            n = p = 0
            for often in (True, False):
                for s, a, b in own:
                    if (often and a < SEEN) or s >= self.threshold.get(kind, math.inf):
                        continue
                    if p + b < PRECISION * (n + a):
                        break
                    n, p = n + a, p + b
                    self.threshold[kind] = s

    def score(self, code: Column, kind: Column) -> Column:
        def bit(i: int) -> Column:
            return (code.bitwiseAND(1 << i) != 0) if i < BITS else (kind == self.kinds[i - BITS])

        out = F.lit(self.start)
        for root, a, b, v in self.trees:
            out = out + F.when(bit(root), F.when(bit(b), v[3]).otherwise(v[2])).otherwise(F.when(bit(a), v[1]).otherwise(v[0]))
        return out

    def selected(self, code: Column, kind: Column, score: Column) -> Column:
        out = F.lit(False)
        for k, t in self.threshold.items():
            out = out | ((kind == k) & (F.round(score, 9) >= t))
        return out


def searched(docs: DataFrame, text: str, base: str, found: str) -> DataFrame:
    """Append ``base`` (contract spans) and ``found`` (candidates)."""
    return docs.withColumns({base: base_spans(F.col(text)), found: candidates(F.col(text))})


def train(found: DataFrame, column: str) -> Boosted:
    """Train on all candidates of all documents through bounded counts."""
    counts = found.select(F.explode(column).alias("c")).groupBy("c.kind", "c.code").agg(F.count("*").alias("n"), F.sum(F.col("c.good").cast("long")).alias("p"))
    return Boosted([(r["kind"], r["code"], r["n"], r["p"]) for r in counts.collect()])


def fit(docs: DataFrame, text: str = "text") -> Boosted:
    """Train on the candidates of the texts."""
    return train(docs.select(candidates(F.col(text)).alias("found")), "found")


def all_spans(docs: DataFrame, model: Boosted, text: str, base: str, spans: str) -> DataFrame:
    """Append ``base`` (contract spans) and ``spans`` (those and the selected ones, in order) to the rows."""
    held = f"{spans}_found"
    return with_selected(searched(docs, text, base, held), model, base, held, spans).drop(held)


def with_selected(found: DataFrame, model: Boosted, base: str, held: str, spans: str) -> DataFrame:
    """Append ``spans``: the contract spans ``base`` and the selected ones of the candidates ``held``, in order."""
    if not model.threshold:
        return found.withColumn(spans, F.transform(base, lambda x: F.struct(x["start"].alias("start"), x["ord"].alias("ord"), x["kind"].alias("kind"), x["end"].alias("end"))))
    scored = F.transform(held, lambda c: F.struct(c["start"].alias("start"), c["ord"].alias("ord"), c["kind"].alias("kind"), c["end"].alias("end"),
                                                                      c["code"].alias("code"), F.round(model.score(c["code"], c["kind"]), 9).alias("score")))
    chosen = F.filter(scored, lambda c: model.selected(c["code"], c["kind"], c["score"]))
    free = F.filter(chosen, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))

    def best(all_: Column) -> Column:
        """By falling score, then place; a span goes only if it overlaps one that stays."""
        first = F.array_sort(all_, lambda c, o: F.when((c["score"] > o["score"]) | ((c["score"] == o["score"]) & (F.struct(c["start"], c["ord"]) < F.struct(o["start"], o["ord"]))), -1).otherwise(1))
        none = F.filter(all_, lambda c: F.lit(False))
        return F.aggregate(first, none, lambda kept, c: F.when(F.exists(kept, lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"])), kept).otherwise(F.concat(kept, F.array(c))))

    plain = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), x["ord"].alias("ord"), x["kind"].alias("kind"), x["end"].alias("end")))
    kept = f"{spans}_free"
    return found.withColumn(kept, free).withColumn(spans, F.sort_array(F.concat(plain(F.col(base)), plain(best(F.col(kept)))))).drop(kept)


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<string>)").alias("out"))

    def step(acc, x):
        more = F.array(F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; spans are replaced in ``text`` and ``n_chars`` follows."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    out = all_spans(docs, fit(docs), "text", f"{prefix}base", f"{prefix}spans").withColumn("text", redacted(F.col("text"), F.col(f"{prefix}spans")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(f"{prefix}spans") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


@query("op8_boosted_pii")
def op8(spark, sf_dir):
    """Spans of all documents: texts are searched once, and what was found is stored for training and selection."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    stored = materialize(searched(docs, "text", "base", "candidates").drop("text"), "pii")
    found = with_selected(stored, train(stored, "candidates"), "base", "candidates", "found")

    def of(kind):
        return lambda x: x["kind"] == kind

    count = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *count, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("found").alias("spans"))
