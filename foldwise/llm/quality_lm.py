"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is over UTF-8 bytes (digits taken as one symbol), order ``ORDER``, and
is trained on every trusted document, those labelled with quality 1.  A
document's perplexity, evened out for very short texts, is compared with a
threshold of its language, a quantile of the trusted documents' perplexities
times a tolerance; documents above it are rejected.  For the threshold a trusted
document is scored without its own counts: the trusted texts fall into two halves
by a hash of the text (equal texts into the same), and each half is scored by the
model of the other.

Documents, marked as trusted by a join with the labels, are dealt to buckets of
about ``BUCKET_BYTES`` of text by a hash of the whole row, once, with the texts
compressed.  Each bucket gives its distinct n-grams with their trusted counts; these
are added up by n-gram, the lower orders follow as continuation counts (the number of
different one-symbol extensions to the left), discounts come from the counts of
counts, and the probabilities of all n-grams that occur anywhere are worked out by
joins sharded by n-gram.  They go back to the buckets that asked for them, where
documents are scored as a stream: a bucket's n-grams come first, then its documents
one by one, so a task holds the n-grams of one bucket and one text.  Broadcast are
one row of discounts per order, and the trusted identifiers behind a check of their
size.  All of it is one Spark plan, so the documents are shuffled once and the
shuffle is read twice.

Defined results: NULL and empty texts have no perplexity (NULL) and are
rejected; a NULL language is a language of its own; the fewer trusted documents a
language has, the less they say about it and the wider its threshold (the quantile
times ``TOLERANCE ** (1 + FEW_TRUSTED / n)``, without bound as n goes to 0, so that
every text with bytes stays in a language without any); repeated labels of a
document trust it if any says quality 1; repeated documents count as often as
they occur; a document with a NULL identifier is never trusted; identifiers of the
two tables are compared as text; other columns of ``documents`` ride along in one
struct, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import PIECE, documents, materialize, pieces, shuffle_partitions, sized_broadcast, table

ORDER = 4
BUCKET_BYTES = 16 << 20
LEAST_BYTES = 1 << 20  # of a bucket, where there are fewer buckets than tasks
QUANTILE = 0.99
TOLERANCE = 1.05
FEW_TRUSTED = 20  # with n trusted documents the tolerance is taken 1 + FEW_TRUSTED / n times
PRIOR_BYTES = 32
ACCURACY = 10_000  # of the quantile: ranks within 1 / ACCURACY
CHUNK = 1 << 21  # bytes of text whose n-grams are worked on at once
ROWS = 1 << 16
ALPHABET = 256
# a model and its trusted counts: of both halves, or of the other half only
MODELS = {"all": "c0 + c1", "no0": "c1", "no1": "c0"}

FOLD = bytes(48 if 48 <= b <= 57 else b for b in range(256))


def grams(text: bytes) -> np.ndarray:
    """The n-gram that ends at each byte, as an integer; the text is preceded by
    ORDER - 1 zero bytes."""
    a = np.frombuffer(bytes(ORDER - 1) + text.translate(FOLD), np.uint8).astype(np.int64)
    n = a.size - ORDER + 1
    g = a[:n].copy()
    for k in range(1, ORDER):
        g <<= 8
        g |= a[k:k + n]
    return g


def grams_of(text: bytes) -> Iterator[np.ndarray]:
    """The n-grams of a text in chunks, so that a very long one is never held whole
    as integers."""
    for i in range(0, len(text), CHUNK):
        own = grams(text[max(0, i - ORDER + 1):i + CHUNK])
        yield own[min(i, ORDER - 1):]


def half(text: bytes) -> int:
    """The half of the trusted texts that a text falls into."""
    return zlib.crc32(text) & 1


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index(name), name, values)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, so that fewer bytes are shuffled."""
    squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
    for batch in pieces(batches):
        texts = batch.column("x_text").cast(pa.binary()).to_pylist()
        yield _replaced(batch, "x_text", pa.array([None if t is None else squeeze(t) for t in texts], pa.binary()))


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts as strings again, a few at a time."""
    expand = zstandard.ZstdDecompressor().decompress
    for batch in pieces(batches, PIECE // 4):
        texts = batch.column("x_text").to_pylist()
        yield _replaced(batch, "x_text", pa.array([None if t is None else expand(t) for t in texts], pa.binary()).cast(pa.string()))


def _with_text_type(schema: T.StructType, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(f.name, kind if f.name == "x_text" else f.dataType) for f in schema])


def dealt(docs: DataFrame, labels: DataFrame, n: int, buckets: int) -> DataFrame:
    """Documents by bucket: (b, x_id, x_good, x_lang, x_text, x_row), texts compressed.
    ``x_row`` has the caller's row without its text.  The bucket follows from the
    whole row, so no identifier or text gathers rows that differ."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("string").alias("x_of")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    own = docs.select(F.col("doc_id").alias("x_id"), F.col("lang").alias("x_lang"), F.col("text").alias("x_text"), row.alias("x_row"))
    left = own.mapInArrow(packed, _with_text_type(own.schema, T.BinaryType()))
    marked = left.join(sized_broadcast(materialize(good)), F.col("x_id").cast("string") == F.col("x_of"), "left")
    hashed = [F.col("x_row").getField(f.name) for f in docs.schema if f.name != "text" and not re.search("map<|variant", f.dataType.simpleString())]
    bucket = F.pmod(F.xxhash64("x_text", *hashed), F.lit(buckets)).cast("int")
    return marked.select(bucket.alias("b"), "x_id", F.col("x_of").isNotNull().alias("x_good"), "x_lang", "x_text", "x_row").repartition(n, "b")


def _bucket_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of buckets to (b, g, c0, c1): the bucket's distinct n-grams with
    their counts in the trusted documents of either half."""
    bucket = None
    known = tuple(np.zeros(0, np.int64) for _ in range(3))
    texts: tuple[list[bytes], ...] = [], [], []  # of half 0, of half 1, not trusted
    size = 0
    expand = zstandard.ZstdDecompressor().decompress

    def fold() -> None:
        nonlocal known, size
        plain = [np.unique(np.concatenate([grams(t) for t in texts[2]]))] if texts[2] else []
        trusted = [np.unique(np.concatenate([grams(t) for t in part]), return_counts=True) if part else (np.zeros(0, np.int64),) * 2 for part in texts[:2]]
        g, at = np.unique(np.concatenate([known[0], *plain, *[t[0] for t in trusted]]), return_inverse=True)
        first = known[0].size + sum(p.size for p in plain)
        counts = []
        for i, (own, c) in enumerate(trusted):
            weights = np.zeros(at.size)
            weights[:known[0].size] = known[1 + i]
            weights[first:first + own.size] = c
            first += own.size
            counts.append(np.bincount(at, weights=weights, minlength=g.size).astype(np.int64))
        known = g, *counts
        for part in texts:
            part.clear()
        size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        nonlocal known
        fold()
        found, known = known, tuple(np.zeros(0, np.int64) for _ in range(3))
        for i in range(0, found[0].size, ROWS):
            part = [c[i:i + ROWS] for c in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part[0].size, bucket, np.int32)), *map(pa.array, part)], names=["b", "g", "c0", "c1"])

    for batch in batches:
        for b, good, small in zip(*[batch.column(c).to_pylist() for c in ("b", "x_good", "x_text")]):
            if b != bucket:
                if bucket is not None:
                    yield from rows()
                bucket = b
            if small and (text := expand(small)):
                texts[half(text) if good else 2].append(text)
                size += len(text)
                if size > CHUNK:
                    fold()
    if bucket is not None:
        yield from rows()


def _discounts(counts: DataFrame) -> DataFrame:
    """One row (one, d1, d2, d3 of every model) from the counts of counts 1 to 4."""
    n = [F.sum((F.col(f"c_{m}") == i).cast("long")).cast("double").alias(f"n{i}_{m}") for m in MODELS for i in range(1, 5)]

    def clamped(m: str) -> list[Column]:
        of = lambda i: F.col(f"n{i}_{m}")
        y = of(1) / (of(1) + 2 * of(2))
        d = [F.when(of(i) > 0, F.lit(float(i)) - (i + 1) * y * of(i + 1) / of(i)) for i in range(1, 4)]
        return [F.least(F.greatest(F.coalesce(x, F.lit(0.5)), F.lit(0.1)), F.lit(i + 0.0)).alias(f"d{i}_{m}") for i, x in zip(range(1, 4), d)]

    return counts.agg(*n).select(F.lit(1).alias("one"), *[x for m in MODELS for x in clamped(m)])


def _parts(counts: DataFrame) -> DataFrame:
    """(g, own, rest of every model): the discounted share of an n-gram in its
    history and the history's weight for the next lower order (1 where the history
    is unseen)."""
    history = Window.partitionBy("h")
    seen = counts.withColumn("h", F.shiftright("g", 8)).withColumn("one", F.lit(1)).join(F.broadcast(_discounts(counts)), "one")

    def shares(m: str) -> list[Column]:
        c = F.col(f"c_{m}")
        off = F.when(c == 0, 0.0).when(c == 1, F.col(f"d1_{m}")).when(c == 2, F.col(f"d2_{m}")).otherwise(F.col(f"d3_{m}"))
        total = F.sum(c).over(history)
        return [F.when(total > 0, (c - off) / total).otherwise(0.0).alias(f"own_{m}"),
                F.when(total > 0, F.sum(off).over(history) / total).otherwise(1.0).alias(f"rest_{m}")]

    return seen.select("g", *[x for m in MODELS for x in shares(m)])


def log_probabilities(counts: DataFrame) -> DataFrame:
    """(g, logp of every model) for every n-gram of ``counts`` (g, c0, c1), both
    0 for n-grams that are only asked for."""
    by_order = {ORDER: counts.select("g", *[F.expr(c).alias(f"c_{m}") for m, c in MODELS.items()])}
    for n in range(ORDER - 1, 0, -1):
        mask = (1 << (8 * n)) - 1
        by_order[n] = by_order[n + 1].groupBy(F.col("g").bitwiseAND(F.lit(mask).cast("long")).alias("g")).agg(
            *[F.sum((F.col(f"c_{m}") > 0).cast("long")).alias(f"c_{m}") for m in MODELS])
    lower = None
    for n in range(1, ORDER + 1):
        parts = _parts(by_order[n])
        if lower is None:
            lower = parts.select("g", *[(F.col(f"own_{m}") + F.col(f"rest_{m}") / ALPHABET).alias(f"p_{m}") for m in MODELS])
            continue
        mask = (1 << (8 * (n - 1))) - 1
        tail = lower.withColumnRenamed("g", "tail")
        lower = parts.withColumn("tail", F.col("g").bitwiseAND(F.lit(mask).cast("long"))).join(tail, "tail").select(
            "g", *[(F.col(f"own_{m}") + F.col(f"rest_{m}") * F.col(f"p_{m}")).alias(f"p_{m}") for m in MODELS])
    return lower.select("g", *[F.log(f"p_{m}").alias(f"logp_{m}") for m in MODELS])


LOGS = [f"logp_{m}" for m in MODELS]


def _score(batches: Iterator[pa.RecordBatch], kept: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, its n-grams (x_kind 0, by g) before its documents: the
    documents' columns ``kept`` with x_bytes, x_ppl and x_held, one text at a time."""
    expand = zstandard.ZstdDecompressor().decompress
    bucket, held, g, logs = None, [], np.zeros(0, np.int64), []

    def scored(small: bytes | None, good: bool) -> tuple:
        text = expand(small) if small else b""
        if not text:
            return 0, None, None
        models = (0, 1 + half(text)) if good else (0,)
        total = [0.0] * len(models)
        for own in grams_of(text):
            at = np.searchsorted(g, own)
            if not g.size or at.max() >= g.size or (g[at] != own).any():
                raise RuntimeError("a bucket's n-grams must come before its documents: is the union's partitioning kept?")
            for i, m in enumerate(models):
                total[i] += float(logs[m][at].sum())
        ppl = [math.exp(-x / len(text)) for x in total]
        return len(text), ppl[0], ppl[1] if good else None

    for batch in pieces(batches):
        b, kind = batch.column("b").to_numpy(), batch.column("x_kind").to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(b) != 0) | (np.diff(kind) != 0)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            part = batch.slice(i, j - i)
            if b[i] != bucket:
                bucket, held, g, logs = b[i], [], np.zeros(0, np.int64), []
            if kind[i] == 0:
                held.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("g", *LOGS)])
                continue
            if held:
                g, *logs = (np.concatenate(c) for c in zip(*held))
                held = []
            found = [scored(t, x) for t, x in zip(part.column("x_text").to_pylist(), part.column("x_good").to_pylist())]
            sizes, ppl, apart = zip(*found)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(sizes, pa.int64()), pa.array(ppl, pa.float64()), pa.array(apart, pa.float64())],
                                             names=[*kept, "x_bytes", "x_ppl", "x_held"])


KEPT = ["x_id", "x_lang", "x_text", "x_row", "x_good"]


def perplexities(docs: DataFrame, labels: DataFrame, whole: bool = False) -> DataFrame:
    """x_id, x_lang, x_trusted, x_bytes, x_ppl, x_held for every document, stored, and
    if ``whole`` x_text (compressed) and x_row (the other columns of ``docs``).  x_held is
    a trusted document's perplexity under the model of the other half.

    A bucket's n-grams and documents meet without a further shuffle: both sides are
    dealt alike by bucket, and the union keeps that (where the session turns this off,
    the union is dealt once more)."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = dealt(docs, labels, n, max(1, -(-total // BUCKET_BYTES), min(n, total // LEAST_BYTES)))
    asked = rows.sortWithinPartitions("b").mapInArrow(_bucket_grams, "b int, g long, c0 long, c1 long").repartition(n, "g")
    probs = log_probabilities(asked.groupBy("g").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")))
    # a bucket needs the model without a half for the n-grams of its trusted documents of that half
    slices = asked.join(probs.withColumnRenamed("g", "of"), F.col("g") == F.col("of")).select(
        "b", "g", "logp_all", *[F.when(F.col(f"c{i}") > 0, F.col(f"logp_no{i}")).alias(f"logp_no{i}") for i in (0, 1)]).repartition(n, "b")
    none = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    texts = rows.select("b", F.lit(1).alias("x_kind"), F.lit(None).cast("long").alias("g"), *[F.lit(None).cast("double").alias(c) for c in LOGS], *KEPT)
    both = slices.select("b", F.lit(0).alias("x_kind"), "g", *LOGS, *[none(c) for c in KEPT]).union(texts)
    if spark.conf.get("spark.sql.unionOutputPartitioning", "false") != "true":
        both = both.repartition(n, "b")
    kept = [c for c in KEPT if whole or c not in ("x_text", "x_row")]
    out = T.StructType([rows.schema[c] for c in kept]).add("x_bytes", "long").add("x_ppl", "double").add("x_held", "double")
    scored = both.sortWithinPartitions("b", "x_kind", "g").mapInArrow(lambda batches: _score(batches, kept), out)
    return materialize(scored.withColumnRenamed("x_good", "x_trusted"))


def evened(value: str = "x_ppl", weight: int = PRIOR_BYTES) -> Column:
    """Perplexity as if the text went on for ``weight`` bytes at its language's
    median: a text of a few bytes says little about itself."""
    n = F.col("x_bytes")
    return F.exp((F.log(value) * n + F.log("x_mid") * weight) / (n + weight))


def _per_language(scored: DataFrame, values: Column, share: float, name: str) -> DataFrame:
    """(x_of, name, x_n): a quantile over the trusted documents of each language and
    their number, NULL for languages without any."""
    trusted = scored.where("x_trusted and x_held is not null")
    seen = scored.groupBy(F.col("x_lang").alias("x_of")).agg(F.count("*").alias("x_rows"))
    own = trusted.groupBy(F.col("x_lang").alias("x_by")).agg(F.percentile_approx(values, share, ACCURACY).alias(name), F.count("*").alias("x_n"))
    return materialize(seen.join(own, F.col("x_of").eqNullSafe(F.col("x_by")), "left").select("x_of", name, "x_n"))


def _with(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """One row per language is joined on; NULL is a language."""
    return scored.join(sized_broadcast(limits), scored["x_lang"].eqNullSafe(F.col("x_of")), "left").drop("x_of")


def judged(scored: DataFrame, quantile: float = QUANTILE, tolerance: float = TOLERANCE,
           few: int = FEW_TRUSTED) -> DataFrame:
    """``scored`` plus x_even (the perplexity that is judged), x_limit and x_keep."""
    middles = _per_language(scored, F.col("x_held"), 0.5, "x_mid").drop("x_n")
    level = _with(scored, middles).withColumn("x_even", F.coalesce(evened(), F.col("x_ppl"))).withColumn("x_out", evened("x_held")).drop("x_mid")
    limits = _per_language(level, F.col("x_out"), quantile, "x_lim")
    kept = F.col("x_ppl").isNotNull() & F.coalesce(F.col("x_even") <= F.col("x_limit"), F.lit(True))
    return _with(level, limits).withColumn("x_limit", F.col("x_lim") * F.pow(F.lit(float(tolerance)), 1 + few / F.col("x_n"))) \
        .withColumn("x_keep", kept).drop("x_lim", "x_n", "x_out")


def keep_good(docs: DataFrame, labels: DataFrame, **rules) -> DataFrame:
    """``docs`` without the rejected documents, all columns kept."""
    kept = judged(perplexities(docs, labels, whole=True), **rules).where("x_keep").select("x_row", "x_text")
    whole = kept.mapInArrow(unpacked, _with_text_type(kept.schema, T.StringType()))
    return whole.select(*[(F.col("x_text") if c == "text" else F.col("x_row").getField(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    found = judged(perplexities(documents(spark, sf_dir), table(spark, sf_dir, "labels")))
    return found.select(F.col("x_id").alias("doc_id"), F.col("x_lang").alias("lang"), F.col("x_bytes").alias("n_bytes"), F.col("x_ppl").alias("perplexity"), F.col("x_even").alias("judged_perplexity"),
                        F.col("x_limit").alias("threshold"), F.col("x_keep").alias("kept"))
