"""Licence scans with a positional rare-token index.

Templates are short word sequences with a label, in two kinds: base phrases,
which hold wherever their words stand consecutively, and licence passages, which
hold when enough of their rare words stand at the right distance from each other
and their mandatory key phrase is there in full.

The index: document frequencies of all template words are counted over all
documents; a template is posted under its highest-IDF words with their positions
in it.  A document's words are looked up in the postings; each hit proposes a
start, *position in the document minus position in the template*, proposals of
one template are intersected by start, and what remains is verified.  The base
phrases are found by their single rarest word, so every place is proposed.

Words are ``[0-9a-z and every non-ASCII character]+`` after lower-casing A-Z.
Defined results: NULL or empty text has no words, no labels and score 0; ties in
IDF go to the earlier word; repeated rows are scanned alike; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, documents
from .decontam import words

# The base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Licence passages: (label, passage, mandatory key phrase).
PASSAGES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-2", "gnu general public license version 2", "general public license version 2"),
    ("gpl-3", "gnu general public license version 3", "general public license version 3"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("bsd-3-clause", "bsd 3 clause license", "bsd 3 clause"),
    ("mpl-2", "mozilla public license version 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
)
RARE = 4  # highest-IDF words under which a passage is posted
SHARE = 0.6  # of these words that have to stand at the right place


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    key: tuple[bytes, ...]
    base: bool


def templates(base=BASE, passages=PASSAGES) -> list[Template]:
    split = lambda phrase: tuple(words(phrase.encode()))
    return [*[Template(label, split(p), split(p), True) for p, label in base],
            *[Template(label, split(p), split(k), False) for label, p, k in passages]]


def document_frequencies(docs: DataFrame, text: str, vocabulary: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """Rows, and for each word of the (fixed) vocabulary the rows that have it.
    Every task counts its rows first; the driver sees one row per word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for t in byte_texts(batch.column(text)):
                found.update(vocabulary.intersection(words(t)))
                found[b""] += 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    counts = docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    df = {r["word"].encode(): r["n"] for r in counts.collect()}
    return df.pop(b"", 0), df


class Index:
    """Postings word -> [(template number, position in the template)]."""

    def __init__(self, every: list[Template], n_docs: int, df: dict[bytes, int], rare: int = RARE, share: float = SHARE):
        idf = lambda w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1e-9
        self.templates, self.share = every, share
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.weight: list[dict[int, float]] = []
        for no, t in enumerate(every):
            places = sorted(range(len(t.words)), key=lambda i: (-idf(t.words[i]), i))[:1 if t.base else rare]
            self.weight.append({i: idf(t.words[i]) for i in places})
            for i in places:
                self.postings.setdefault(t.words[i], []).append((no, i))
        self.keys = frozenset(self.postings)

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], dict[str, float]]:
        """Base places (start, template) and label -> best score."""
        starts: dict[tuple[int, int], list[int]] = {}
        if not self.keys.isdisjoint(ws):
            get = self.postings.get
            for at, w in enumerate(ws):
                for no, i in get(w, ()):
                    if at >= i:
                        starts.setdefault((no, at - i), []).append(i)
        places, labels = [], {}
        for (no, start), found in starts.items():
            t = self.templates[no]
            if t.base:
                if tuple(ws[start:start + len(t.words)]) == t.words:
                    places.append((start, no))
                    labels[t.label] = 1.0
                continue
            weight = self.weight[no]
            score = sum(weight[i] for i in found) / sum(weight.values())
            if score >= self.share and self._has_key(ws, start, t):
                whole = sum(a == b for a, b in zip(ws[start:start + len(t.words)], t.words)) / len(t.words)
                labels[t.label] = max(labels.get(t.label, 0.0), whole)
        return places, labels

    @staticmethod
    def _has_key(ws: list[bytes], start: int, t: Template) -> bool:
        n, m = len(t.words), len(t.key)
        return any(tuple(ws[i:i + m]) == t.key for i in range(start, start + n - m + 1))


def scan(docs: DataFrame, carry: list[str], text: str = "text", base=BASE, passages=PASSAGES, rare: int = RARE, share: float = SHARE) -> DataFrame:
    """``carry`` columns of every document plus n_words, places (array of start
    and label of the base phrases, in order), base_labels, labels, score."""
    clash = {"n_words", "places", "base_labels", "labels", "score"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with the result's")
    every = templates(base, passages)
    n_docs, df = document_frequencies(docs, text, frozenset(w for t in every for w in t.words))
    index = Index(every, n_docs, df, rare, share)
    place_type = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in ("n_words", "places", "base_labels", "labels", "score")}
            for t in byte_texts(batch.column(text)):
                ws = words(t)
                places, labels = index.scan(ws)
                at = sorted((start, index.templates[no].label) for start, no in places)
                row = (len(ws), [{"start": a, "label": x} for a, x in at], sorted({x for _, x in at}), sorted(labels), max(labels.values(), default=0.0))
                for c, v in zip(out, row):
                    out[c].append(v)
            arrays = [pa.array(out["n_words"], pa.int64()), pa.array(out["places"], place_type), pa.array(out["base_labels"], pa.list_(pa.string())),
                      pa.array(out["labels"], pa.list_(pa.string())), pa.array(out["score"], pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], *arrays], names=[*carry, *out])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(*dict.fromkeys([*carry, text])).mapInArrow(
        run, f"{fields}, n_words long, places array<struct<start:long,label:string>>, base_labels array<string>, labels array<string>, score double")


def query(spark, sf_dir):
    found = scan(documents(spark, sf_dir), ["doc_id"])
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
                        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels"), "score")
