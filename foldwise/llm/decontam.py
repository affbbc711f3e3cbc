"""Benchmark decontamination: scan training token windows against a broadcast
hash set of normalised test n-grams, verify every hit, remove spans or documents.

Words are ``[0-9a-z and every non-ASCII character]+`` after lower-casing A-Z.  A
window is ``n`` consecutive words of an item; an item of fewer words (but not
none) is one window of its own length.  Documents are read once, window hashes
are computed for whole batches with array arithmetic, and each hash hit is
verified word by word against the item's window.

The broadcast set is bounded: items are taken in blocks of at most
``BLOCK_BYTES`` of text (an item larger than that stands alone), each block is
scanned against all documents, and the hits of the blocks are united per
document.  A single block, the usual case, needs no shuffle at all.

Defined results: NULL or empty text has no words and is never hit; an item
without words is no item; repeated items count by item_id (NULL: the empty string); an empty benchmark
leaves every document clean; repeated documents are judged row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, byte_texts, documents, materialize, table, under_plain_names, with_own_names, words_table

N = 13
MIN_SHARE = 20  # contaminated when n_hit * MIN_SHARE >= n_words
BLOCK_BYTES = 16 << 20
BATCH_BYTES = 8 << 20

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
TABLE = words_table(b"0123456789abcdefghijklmnopqrstuvwxyz")
MULT = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def words(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class GramSet:
    """Windows of a block of items: vocabulary, sorted hashes per window length,
    and the windows themselves for the verification."""

    def __init__(self, items: list[tuple[object, str | None]], n: int = N):
        self.vocab: dict[bytes, int] = {}
        windows: dict[int, dict[tuple[int, ...], set]] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words((text or "").encode())]
            if ids:
                size = min(n, len(ids))
                for i in range(len(ids) - size + 1):
                    windows.setdefault(size, {}).setdefault(tuple(ids[i:i + size]), set()).add(item)
        self.windows = windows
        self.codes = np.array([(MULT * (2 * i + 3) ^ (i * 0xC2B2AE3D27D4EB4F)) & MASK for i in range(len(self.vocab))] + [0], np.uint64)
        self.hashes = {size: np.unique(np.array([self._hash(w) for w in wins], np.uint64)) for size, wins in windows.items()}

    def _hash(self, ids: tuple[int, ...]) -> int:
        h = 0
        for i in ids:
            h = (h * MULT + int(self.codes[i])) & MASK
        return h

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int, set]]:
        """(start, length, items) of every occurrence in the word ids (-1: not in
        the vocabulary or a document border)."""
        known = ids >= 0
        code = self.codes[ids]
        for size, wanted in self.hashes.items():
            if ids.size < size:
                continue
            runs = np.concatenate([[0], np.cumsum(~known)])
            at = np.flatnonzero(runs[size:] == runs[:-size])  # windows of known words only
            if not at.size:
                continue
            h = np.zeros(at.size, np.uint64)
            for k in range(size):
                h = h * np.uint64(MULT) + code[at + k]
            for i in at[np.isin(h, wanted)].tolist():
                items = self.windows[size].get(tuple(ids[i:i + size].tolist()))
                if items:
                    yield i, size, items


SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _scan(bound, passed: list[str], text: str):
    """One pass over documents with the hits of earlier blocks, if any, added in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: GramSet = bound.value
        for batch in batches:
            texts = byte_texts(batch.column(text))
            before = batch.schema.get_field_index("hit_spans") >= 0
            old_spans = batch.column("hit_spans").to_pylist() if before else [()] * len(texts)
            old_items = batch.column("items").to_pylist() if before else [()] * len(texts)
            n_words, spans, names = [], [], []
            for i, j in batches_of(texts, BATCH_BYTES):
                bounds, ids = [0], []
                get = grams.vocab.get
                for t in texts[i:j]:
                    ids += [get(w, -1) for w in words(t)]
                    ids.append(-1)
                    bounds.append(len(ids))
                found: dict[int, tuple[list, set]] = {}
                starts = np.array(bounds)
                for at, size, items in grams.hits(np.array(ids, np.int64)) if grams.vocab else ():
                    d = int(np.searchsorted(starts, at, "right")) - 1
                    hit, of = found.setdefault(d, ([], set()))
                    hit.append((at - bounds[d], at - bounds[d] + size))
                    of |= items
                for d in range(j - i):
                    hit, of = found.get(d, ([], set()))
                    n_words.append(bounds[d + 1] - bounds[d] - 1)
                    hit = [*hit, *((s["begin"], s["end"]) for s in old_spans[i + d])]
                    spans.append([{"begin": a, "end": b} for a, b in merge_spans(hit)])
                    names.append(sorted({*of, *old_items[i + d]}))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in passed], pa.array(n_words, pa.int64()), pa.array(spans, SPANS), pa.array(names, pa.list_(pa.string()))],
                names=[*passed, "n_words", "hit_spans", "items"])

    return run


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of bounded size; one block is on the driver at a time."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"),
                            F.coalesce(F.octet_length(F.col(text)), F.lit(0)).alias("b"))
    total = rows.agg(F.sum("b")).first()[0] or 0
    if total <= block_bytes:
        yield [(r["i"], r["t"]) for r in rows.select("i", "t").toLocalIterator()]
        return
    block, size = [], 0
    for r in rows.toLocalIterator():
        if block and size + r["b"] > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += r["b"]
    if block:
        yield block


def scan(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str = "text", item: str = "item_id",
         item_text: str = "text", n: int = N, min_share: int = MIN_SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``carry`` columns of every document plus n_words, hit_spans (word
    positions, merged), items (sorted item ids as strings), n_hit, contaminated."""
    spark = docs.sparkSession
    clash = {"n_words", "hit_spans", "items", "n_hit", "contaminated"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with the result's")
    columns = list(dict.fromkeys([*carry, text]))

    def passed(frame: DataFrame, block: list, keep: list[str]) -> DataFrame:
        bound = spark.sparkContext.broadcast(GramSet(block, n))
        fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
        return frame.mapInArrow(_scan(bound, keep, text), f"{fields}, n_words long, hit_spans array<struct<begin:long,end:long>>, items array<string>")

    found, frame, pending = None, docs.select(*columns), []
    for block in _blocks(benchmark, item, item_text, block_bytes):
        if pending:  # more than one block: one pass for each, with the text kept for the next
            frame = materialize(passed(frame, pending, columns))
        pending = block
    found = passed(frame, pending, carry)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["begin"])
    return (found.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * min_share >= F.col("n_words"))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **rules) -> DataFrame:
    """``docs`` without contaminated documents, all columns kept, whatever their names."""
    plain, own = under_plain_names(docs)
    kept = scan(plain, benchmark, plain.columns, **(rules | {"text": own[rules.get("text", "text")]})).where("not contaminated")
    return with_own_names(kept, docs)


def cut_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the hit words of ``spans`` and what stands between them."""
    if text is None or not spans:
        return text
    raw = text.encode()
    at = [(m.start(), m.end()) for m in WORD.finditer(raw.lower())]
    out, upto = [], 0
    for a, b in spans:
        out.append(raw[upto:at[a][0]])
        upto = at[b - 1][1]
    return b"".join([*out, raw[upto:]]).decode()


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **rules) -> DataFrame:
    """``docs`` with every hit span cut out of its text instead."""
    names = docs.columns
    scanned = scan(docs, benchmark, names, text=text, **rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [cut_spans(t, [(s["begin"], s["end"]) for s in hit])
                   for t, hit in zip(batch.column(text).to_pylist(), batch.column("hit_spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.string()) if c == text else batch.column(c) for c in names], names=names)

    return scanned.select(*names, "hit_spans").mapInArrow(run, docs.schema)


def query(spark, sf_dir):
    found = scan(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x{{7F}}]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format(text='text')}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, coalesce({_WORDS.format(text='text')}, []) AS w FROM benchmark),
sizes AS (SELECT DISTINCT least(13, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM b, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS t(i) WHERE len(w) > 0),
places AS (
  SELECT d.doc_id, sizes.n, t.i, array_to_string(d.w[t.i : t.i + sizes.n - 1], ' ') AS gram
  FROM d, sizes, unnest(generate_series(1, len(d.w) - sizes.n + 1)) AS t(i)),
found AS (SELECT p.doc_id, p.i, p.n, x.item FROM places p JOIN windows x ON p.n = x.n AND p.gram = x.gram),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM found) GROUP BY doc_id),
of AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(of.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(of.items, '')) AS items_sha256,
  coalesce(hit.n_hit, 0) > 0 AND 20 * coalesce(hit.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN of USING (doc_id)
"""
