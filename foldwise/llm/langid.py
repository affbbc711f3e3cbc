"""Language identification with error-correcting output codes.

Every language has a binary codeword; for each bit one n-gram classifier says
whether a text's language has a 1 there.  A classifier is a linear rule over
hashed byte n-grams with the smoothed log-odds of the languages with bit 1
against those with bit 0 as weights.  Its counts come from all training texts:
one pass adds up (language, n-gram bin) in every task before a small shuffle.

A text's mean log-odds per bit are its margins; decoding takes the codeword with
the least logistic loss, each bit weighted by how well its two sides separate
(the symmetric divergence of their n-gram distributions).  The score is the
softmax share of the winner, and a text whose two best codewords lie within
``AMBIGUOUS`` of each other is flagged.

Defined results: ``und`` with score 0 if the text is NULL or has no letter, or if
there was nothing to learn from; with one learned language every other text is
that language; ties go to the language first in code-point order; NULL languages
are not learned from; repeated rows count as often as they occur in training.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, documents, materialize

GRAM = 3
BINS = 1 << 16
SMOOTH = 0.5
SHARPNESS = 12.0  # margins are mean log-odds; this turns them into logits
AMBIGUOUS = 0.1
UNKNOWN = "und"
CHUNK = 1 << 20

LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and next((True for c in text if c.isalpha()), False)


def gram_bins(data: bytes) -> np.ndarray:
    """Bin of every byte trigram, A-Z lower-cased, other ASCII as spaces."""
    a = np.frombuffer(data.translate(LOWER), np.uint8).astype(np.uint32)
    if a.size < GRAM:
        return np.zeros(0, np.int64)
    code = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
    code = code[code != 0x202020]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def codewords(n: int) -> np.ndarray:
    """n x bits matrix of 0 and 1, rows far apart, columns neither constant nor
    equal or opposite: for up to seven languages all 2^(n-1) - 1 ways to divide
    them, beyond that columns from a fixed generator, as many as it takes for a
    distance of a quarter of the bits between any two rows."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 7:
        cols = [[(m >> i) & 1 for i in range(n)] for m in range(1, 1 << (n - 1))]
        return np.array(cols, np.int8).T
    bits = 8 * int(np.ceil(np.log2(n)))
    rng = np.random.default_rng(n)
    while True:
        code = rng.integers(0, 2, (n, bits), dtype=np.int8)
        if least_distance(code) >= bits // 4 and (code.sum(axis=0) % n != 0).all():
            return code
        bits += 1


def least_distance(code: np.ndarray, block: int = 512) -> int:
    """The smallest number of bits in which two rows differ, a block of rows at a time."""
    sign, least = 2.0 * code.astype(np.float32) - 1, code.shape[1]
    for i in range(0, len(code), block):
        same = sign[i:i + block] @ sign[i:].T  # bits - 2 * distance
        same[np.arange(len(same)), np.arange(len(same))] = -code.shape[1]
        least = min(least, int((code.shape[1] - same.max()) // 2))
    return least


class Model:
    def __init__(self, languages: list[str], counts: Iterable[np.ndarray]):
        """counts: BINS numbers of each language in turn; only sums per bit are held."""
        self.languages = languages
        self.code = codewords(len(languages))
        sides = np.zeros((2, self.code.shape[1], BINS))
        for own, word in zip(counts, self.code):  # every language weighs the same on its side
            share = (own + SMOOTH) / (own + SMOOTH).sum()
            for value in (0, 1):
                sides[value, word == value] += share
        ones = self.code.sum(axis=0, dtype=np.int64)[:, None]
        zero, one = sides[0] / np.maximum(len(languages) - ones, 1), sides[1] / np.maximum(ones, 1)
        odds = np.log(one / zero)
        alpha = ((one - zero) * odds).sum(axis=1)
        self.weights = odds.T.astype(np.float32)
        self.alpha = alpha / max(alpha.sum(), 1e-12)

    def margins(self, data: bytes) -> np.ndarray:
        bins = gram_bins(data)
        if not bins.size or not self.weights.shape[1]:
            return np.zeros(self.weights.shape[1])
        total = np.zeros(self.weights.shape[1])
        for i in range(0, bins.size, CHUNK):
            total += self.weights[bins[i:i + CHUNK]].sum(axis=0, dtype=np.float64)
        return total / bins.size

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        if not self.languages:
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        sign = 2.0 * self.code - 1.0
        loss = (self.alpha * np.logaddexp(0.0, -SHARPNESS * sign * margins)).sum(axis=1)
        best = int(loss.argmin())
        share = np.exp(loss[best] - loss)
        second = np.partition(loss, 1)[1]
        return self.languages[best], float(1.0 / share.sum()), bool(second - loss[best] < AMBIGUOUS)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts from every row of ``docs`` with a language.  They come to the driver one
    language at a time; it holds 2 x bits x BINS numbers, and the bits grow with the
    logarithm of the number of languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, x in zip(byte_texts(batch.column("body")), batch.column("label").to_pylist()):
                counts = seen.setdefault(x, np.zeros(BINS, np.int64))
                bins = gram_bins(t)
                if bins.size * 8 > BINS:
                    counts += np.bincount(bins, minlength=BINS)
                else:
                    np.add.at(counts, bins, 1)
            if len(seen) > 64:
                yield rows(seen)
                seen.clear()
        yield rows(seen)

    def rows(seen: dict[str, np.ndarray]) -> pa.RecordBatch:
        names, bins, values = [], [], []
        for x, counts in seen.items():
            at = np.flatnonzero(counts)
            # a language is kept even if none of its texts has an n-gram
            at = at if at.size else np.zeros(1, np.int64)
            names.append(np.full(at.size, x, object))
            bins.append(at)
            values.append(counts[at])
        cat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.RecordBatch.from_arrays([cat(names, pa.string()), cat(bins, pa.int32()), cat(values, pa.int64())], names=["label", "bin", "n"])

    labelled = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("body"), F.col(lang).alias("label"))
    counts = materialize(labelled.mapInArrow(run, "label string, bin int, n long").groupBy("label", "bin").agg(F.sum("n").alias("n")))
    languages = [r["label"] for r in counts.select("label").distinct().orderBy("label").collect()]
    per_language = counts.groupBy("label").agg(F.collect_list(F.struct("bin", "n")).alias("grams"))  # at most BINS each

    def rows_of() -> Iterator[np.ndarray]:
        for r in per_language.orderBy("label").toLocalIterator():
            counted = np.zeros(BINS, np.float64)
            counted[[g["bin"] for g in r["grams"]]] = [g["n"] for g in r["grams"]]
            yield counted

    return Model(languages, rows_of())


def predict(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """``carry`` columns of every document plus lang_pred, score, ambiguous."""
    clash = {"lang_pred", "score", "ambiguous"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with the result's")
    bound = docs.sparkSession.sparkContext.broadcast(model)  # languages x bits and BINS x bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bound.value
        for batch in batches:
            found = [model.decode(model.margins(t.encode())) if has_letter(t) else (UNKNOWN, 0.0, True) for t in batch.column(text).to_pylist()]
            lang, score, open_ = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(open_, pa.bool_())],
                                             names=[*carry, "lang_pred", "score", "ambiguous"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(*dict.fromkeys([*carry, text])).mapInArrow(run, f"{fields}, lang_pred string, score double, ambiguous boolean")


def held_out(key: Column) -> Column:
    """crc32 of the identifier as text, modulo 3, is 1 (NULL: not held out)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    named = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return predict(named, model, ["doc_id", "held_out"])
