"""Licence scans by a positional rare-token index.

Templates are word sequences; the index maps each template word to (template, position). A file's words are looked up once;
for each template only its ``RARE`` words of highest inverse document frequency (over all documents) vote: an occurrence
at word p and a posting at position q vote for the start p - q. A start with at least ``VOTES`` of the template's rare
words is a candidate, and it counts if every mandatory key phrase of the template stands complete at its place.
The contract's phrases are templates that are one key phrase each: candidates come from their rarest word, the other
words are intersected by relative position.

Document frequencies are one row per template word, whatever the corpus. Words are compared by 64-bit hashes. Defined
cases: a null or wordless text has no places and score 0; repeated rows are scanned each; a null doc_id is carried along;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorspark.llm import lex
from moorspark.llm.registry import documents, query

RARE = 4
VOTES = 0.75

# Fixed values of the contract: label and phrase.
BASE = {"apache": "apache license", "gpl": "general public license", "mit": "mit license"}

# Opening and key sentences of public licences. Key phrases stand in brackets.
TEMPLATES = {
    "mit-text": "[permission is hereby granted free of charge to any person obtaining a copy] of this software and associated documentation files",
    "apache-text": "[unless required by applicable law or agreed to in writing] software distributed under the license is distributed on an [as is] basis",
    "gpl-text": "[this program is free software] you can redistribute it and or modify it under the terms of the [gnu general public license]",
    "lgpl": "[gnu lesser general public license]",
    "agpl": "[gnu affero general public license]",
    "bsd": "[redistribution and use in source and binary forms] with or without modification are permitted",
    "isc": "[permission to use copy modify and or distribute this software for any purpose] with or without fee is hereby granted",
    "mpl": "this source code form is subject to the terms of the [mozilla public license]",
    "cc-by-nc": "licensed under [cc by nc]",
    "cc-by-sa": "licensed under [cc by sa]",
    "unlicense": "[this is free and unencumbered software released into the public domain]",
}


class Template:
    """Words of a template and which of them are in key phrases."""

    def __init__(self, label: str, text: str):
        self.label = label
        self.words, self.key = [], []
        inside = False
        for token in re.findall(r"[\[\]]|[^\s\[\]]+", text):
            if token in "[]":
                inside = token == "["
            else:
                self.words.append(token)
                self.key.append(inside)


class Index:
    """Positional postings of all templates over one vocabulary, with the rare words of each."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.vocabulary = np.unique(np.array([lex.word_hash(w) for t in templates for w in t.words], np.uint64))
        self.words = [np.searchsorted(self.vocabulary, np.array([lex.word_hash(w) for w in t.words], np.uint64)) for t in templates]
        self.rare: list[list[int]] = []

    def lookup(self, buf: np.ndarray, off: np.ndarray) -> tuple[lex.Words, np.ndarray]:
        """Words of a block and their number in the vocabulary, -1 for others."""
        w = lex.Words(buf, off, lex.ALNUM)
        h = lex.byte_sums(buf, True).span(w.start, w.end)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return w, np.where(self.vocabulary[at] == h, at, -1)

    def weigh(self, frequency: dict[int, int], documents: int) -> None:
        """Choose each template's rare words by inverse document frequency; ties go to the earlier word."""
        idf = [math.log((documents + 1) / (frequency.get(i, 0) + 1)) for i in range(len(self.vocabulary))]
        for words in self.words:
            first = {int(w): q for q, w in reversed(list(enumerate(words)))}
            self.rare.append(sorted(first.values(), key=lambda q: (-idf[words[q]], q))[:RARE])

    def places(self, t: int, ids: np.ndarray, ptr: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start words (in the block, may lie before the document's first) of verified places, and each one's share of votes.

        ``where`` are the places of known words.
        """
        words, rare = self.words[t], self.rare[t]
        starts = np.concatenate([where[ids[where] == words[q]] - q for q in rare])
        start, votes = np.unique(starts, return_counts=True)
        start = start[votes >= VOTES * len(rare)]
        anchor = np.array([q for q, k in enumerate(self.templates[t].key) if k])
        inside = (start + anchor[0] >= 0) & (start + anchor[-1] < len(ids))
        start = start[inside]
        for q in anchor:
            start = start[ids[start + q] == words[q]]
        doc = np.searchsorted(ptr, start + anchor[0], "right") - 1
        start = start[start + anchor[-1] < ptr[doc + 1]]
        share = np.zeros(len(start))
        doc = np.searchsorted(ptr, start + anchor[0], "right") - 1
        for q, w in enumerate(words):
            p = start + q
            ok = (p >= ptr[doc]) & (p < ptr[doc + 1])
            share[ok] += ids[p[ok]] == w
        return start + anchor[0], share / len(words)


def frequencies(docs: DataFrame, index: Index) -> tuple[dict[int, int], int]:
    """Documents that hold each template word, and the number of documents."""
    def run(batches):
        held, n = np.zeros(len(index.vocabulary), np.int64), 0
        for batch in batches:
            for rows, buf, off in lex.blocks(batch):
                w, ids = index.lookup(buf, off)
                known = np.flatnonzero(ids >= 0)
                pairs = np.unique(np.stack([np.searchsorted(w.ptr, known, "right") - 1, ids[known]]), axis=1)
                held += np.bincount(pairs[1], minlength=len(held))
                n += rows.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(held)), -1)), pa.array(np.append(held, n))], ["word", "n"])

    got = {r["word"]: r["n"] for r in docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return got, got.get(-1, 0)


def scan(docs: DataFrame) -> DataFrame:
    """Places, labels and score per row."""
    base = list(BASE)
    index = Index([Template(k, f"[{v}]") for k, v in BASE.items()] + [Template(k, v) for k, v in TEMPLATES.items()])
    index.weigh(*frequencies(docs, index))
    index.rare[: len(base)] = [r[:1] for r in index.rare[: len(base)]]  # the rarest word leads, the key phrase verifies the rest
    names = [t.label for t in index.templates]

    def run(batches):
        for batch in batches:
            for rows, buf, off in lex.blocks(batch):
                w, ids = index.lookup(buf, off)
                where = np.flatnonzero(ids >= 0)
                n = rows.num_rows
                n_base, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                score = np.zeros(n)
                labels: list[set[int]] = [set() for _ in range(n)]
                for t in range(len(names)):
                    at, share = index.places(t, ids, w.ptr, where)
                    doc = np.searchsorted(w.ptr, at, "right") - 1
                    for d in np.unique(doc).tolist():
                        labels[d].add(t)
                    np.maximum.at(score, doc, share)
                    if t < len(base):
                        n_base += np.bincount(doc, minlength=n)
                        np.minimum.at(first, doc, at - w.ptr[doc])
                        np.maximum.at(last, doc, at - w.ptr[doc])
                none = n_base == 0
                text = [",".join(sorted(names[t] for t in x if t < len(base))) for x in labels], [",".join(sorted(names[t] for t in x)) for x in labels]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(w.counts), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                                                  pa.array(text[0], pa.string()), pa.array(text[1], pa.string()), pa.array(score)],
                                                 ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


@query("op4_rare_token_licences")
def op4(spark, sf_dir):
    """Licences of all documents."""
    return scan(documents(spark, sf_dir))
