"""SimHash near-dedup by pigeonhole blocks.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of ``k``
words joined by spaces (repeats count; fewer words: the whole sequence; none:
fingerprint zero), XXH64 with seed 42; a bit is 1 when more than half of the
hashes have it set.

Links: fingerprints that differ in at most ``d`` bits.  64 bits are cut into
``d + 2`` blocks; two such fingerprints agree on at least two blocks, so joining
on every pair of blocks finds all of them, and the Hamming distance verifies.
Equal fingerprints are one vertex from the start.  A bucket of more than
``BUCKET`` fingerprints is linked exactly without its pairs (``d <= 2``): two
fingerprints are within two bits of each other when, and only when, the sets
"myself and everything one bit away" meet; each fingerprint is tied to the
smallest one that shares such a point, so rows grow linearly with the bucket.

Defined results: NULL and empty texts have fingerprint zero and are linked like
any other; repeated rows share a component; a NULL identifier is ignored when
the smallest identifier is chosen (NULL only if there is no other); an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, documents, materialize
from .components import components

SHINGLE = 3
DISTANCE = 2
BUCKET = 64
SEED = 42


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of UTF-8 bytes."""
    words = text.lower().split()  # bytes: only A-Z change, and split() cuts at \\x20 and \\x09-\\x0D
    if not words:
        return 0
    if len(words) <= k:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    join, digest = b" ".join, xxhash.xxh64_intdigest
    grams = map(join, zip(*[words[i:] for i in range(k)]))
    h = np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, h.size, 4096):
        ones += np.unpackbits(h[i:i + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = 2 * ones > h.size
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """(key, fp): fp as a signed long, the same 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, k) for t in byte_texts(batch.column(text))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(fps)], names=[key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fp long")


def _block_masks(n_blocks: int) -> list[int]:
    """Masks of every pair of the ``n_blocks`` blocks of 64 bits."""
    cuts = [64 * i // n_blocks for i in range(n_blocks + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """(a, b) with a < b (as signed longs): pairs of distinct fingerprints that
    connect all fingerprints within ``distance`` bits of each other.  In small
    buckets these are all such pairs; in large ones ties to a common point."""
    if distance > 2:
        raise ValueError("large buckets are linked exactly for distances up to 2")
    masks = _block_masks(distance + 2)
    cases: Column = F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
                              for i, m in enumerate(masks)])
    keyed = materialize(fps.select("fp").distinct().select("fp", F.explode(cases).alias("c")).select("c.m", "c.key", "fp"))
    sizes = keyed.groupBy("m", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(keyed.join(sizes, ["m", "key"]))
    small = shared.where(F.col("n") <= bucket)
    left, right = small.select("m", "key", F.col("fp").alias("a")), small.select("m", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = left.join(right, ["m", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    # one bit away, or zero: 65 points around every fingerprint of a large bucket
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(64)])
    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    if distance < 2:  # one bit: a common point must be one of the two
        raise_points = crowded.select("fp", F.explode(flips).alias("x")).where(F.col("x") != 0)
        other = crowded.select(F.col("fp").alias("b"))
        meet = raise_points.select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("b")).join(other, "b")
        ties = meet.select(F.least("fp", "b").alias("a"), F.greatest("fp", "b").alias("b")).where(F.lit(distance == 1))
    else:
        points = crowded.select("fp", F.explode(flips).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("point"))
        centre = points.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
        ties = points.join(centre.select("point", "a"), "point").select("a", F.col("fp").alias("b")).where("a <> b")
    return pairs.union(ties).distinct()


def _placed(fps: DataFrame, distance: int, bucket: int, first: Column) -> DataFrame:
    """(fp, least): for every fingerprint the smallest ``first`` of its component."""
    roots = components(links(fps, distance, bucket))
    vertices = fps.groupBy("fp").agg(F.min(first).alias("first"))
    placed = vertices.join(roots, vertices["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    return placed.join(least, "root").select("fp", "least")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, distance: int = DISTANCE,
                bucket: int = BUCKET) -> DataFrame:
    """One row per document: key, fp, component_id (the smallest key reachable)."""
    fps = materialize(fingerprints(docs, key, text, k))
    least = _placed(fps, distance, bucket, F.col(key)).withColumnRenamed("least", "component_id")
    return fps.join(least, "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, distance: int = DISTANCE,
             bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one document per component: of its documents (key, text) the one
    with the smallest key (NULL last), then the smallest fingerprint and hash of key and
    text.  Rows equal in key and text are one document and stay together; rows that
    share only a key are told apart."""
    hashes = lambda: (F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")), F.xxhash64(F.lit(SEED), F.col(f"`{text}`"), F.col(f"`{key}`")))
    h1, h2 = hashes()
    rows = docs.select(F.struct(F.col(f"`{key}`").isNull().alias("blank"), F.col(f"`{key}`").alias("key"), h1.alias("h1"), h2.alias("h2")).alias("doc"),
                       F.col(f"`{text}`").alias("text"))
    fps = materialize(fingerprints(rows, "doc", "text", k))
    least = _placed(fps, distance, bucket, F.struct("doc.blank", "doc.key", "fp", "doc.h1", "doc.h2"))
    gone = fps.join(least, "fp").where((F.col("doc.h1") != F.col("least.h1")) | (F.col("doc.h2") != F.col("least.h2"))) \
        .select(F.col("doc.h1").alias("gone_1"), F.col("doc.h2").alias("gone_2")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), h1.alias("h1"), h2.alias("h2"))
    left = whole.join(gone, (F.col("h1") == F.col("gone_1")) & (F.col("h2") == F.col("gone_2")), "left_anti")
    return left.select("row.*")


def hex_fp(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def query(spark, sf_dir):
    return near_groups(documents(spark, sf_dir)).select("doc_id", hex_fp(F.col("fp")).alias("fingerprint"), "component_id")
