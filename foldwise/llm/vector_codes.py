"""Vector code compression: product codes from Hilbert-sorted flat blocks.

Vectors become integers and are cut into ``PARTS`` equal parts; every part has a
codebook that starts as that part of the vectors with the smallest identifiers
and is moved ``ROUNDS`` times to the floored means of the parts nearest to each
entry.  All of it is exact integer arithmetic.

Each part's rows are dealt by range along a Hilbert curve and cut into flat blocks
of at most ``BLOCK`` rows, stored once with the smallest box around them and their
sum.  A round looks at the boxes first: an entry whose least distance to the box
exceeds the smallest greatest distance of any entry can't be nearest to a row of the
block.  A block with one entry left goes to it whole, by its stored sum; of other
blocks the rows are compared with the shortlist alone.  A round sends a task the
codebooks (a few kilobytes) and gets one row per entry and component back, added
up by Spark; the blocks are never shuffled again.

Defined results: rows whose vector is NULL or empty, has a NULL or non-finite
component, or an integer beyond ``vectors.MAX_COMPONENT`` (its squares would leave a
long) are dropped, and so are rows whose length differs from that of the row with
the smallest identifier; a length that ``parts`` doesn't divide is a ValueError;
repeated identifiers are rows of their own, in the order of their packed bytes; NULL
identifiers come last; with fewer rows than entries the codebooks are shorter; ties
go to the lower entry; an empty table gives an empty result.  Only the named columns
are read, so other columns of the table cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, sized_broadcast, table
from .vectors import integer_rows, packed, unpacked

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK = 256
KEY_BITS = 56  # of a place on the Hilbert curve


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of ``points`` (rows of integers below ``2 ** bits``) on the Hilbert
    curve through their grid: bits of the axes are exchanged and inverted from the
    top down, Gray-coded, and read off in turn."""
    x = [c.astype(np.int64) for c in points.T]
    for high in (1 << b for b in range(bits - 1, 0, -1)):
        low = high - 1
        for i in range(len(x)):
            inverted = (x[i] & high) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swapped
            x[0] = x[0] ^ np.where(inverted, low, swapped) if i else np.where(inverted, x[0] ^ low, x[0])
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for high in (1 << b for b in range(bits - 1, 0, -1)):
        turn = np.where(x[-1] & high, turn ^ (high - 1), turn)
    key = np.zeros_like(turn)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ turn) >> b & 1)
    return key


def part_rows(kept: DataFrame, dims: int, parts: int, top: int) -> DataFrame:
    """(part, place, rid, v): every part of every vector with its place on the curve."""
    width = dims // parts
    axes = min(width, KEY_BITS)
    bits = min(16, KEY_BITS // axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column("rid")
            x = np.array([unpacked(v, dims) for v in batch.column("v").to_pylist()], np.int64).reshape(-1, dims)
            for p in range(parts):
                own = x[:, p * width:(p + 1) * width]
                place = hilbert(((own[:, :axes] + top) << bits) // (2 * top + 1), bits)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), p, np.int32)), pa.array(place), rid, pa.array([packed(r) for r in own], pa.binary())],
                                                 names=["part", "place", "rid", "v"])

    return kept.select("rid", "v").mapInArrow(run, "part int, place long, rid long, v binary")


def flat_blocks(rows: DataFrame, width: int, block: int = BLOCK) -> DataFrame:
    """(part, n, rids, v, low, high, total): blocks of neighbours on the curve,
    stored.  Rows are dealt by (part, place, rid), so equal vectors can be split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rids, vs = None, [], []

        def made() -> pa.RecordBatch:
            x = np.array([unpacked(v, width) for v in vs], np.int64)
            values = [part, len(rids), np.array(rids, np.int64).tobytes(), packed(x), packed(x.min(axis=0)), packed(x.max(axis=0)), x.sum(axis=0).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, [pa.int32(), pa.int32()] + [pa.binary()] * 5)],
                                              names=["part", "n", "rids", "v", "low", "high", "total"])

        for batch in batches:
            for p, rid, v in zip(*[batch.column(c).to_pylist() for c in ("part", "rid", "v")]):
                if rids and (p != part or len(rids) >= block):
                    yield made()
                    rids, vs = [], []
                part = p
                rids.append(rid)
                vs.append(v)
        if rids:
            yield made()

    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), "part", "place", "rid").sortWithinPartitions("part", "place", "rid")
    return materialize(dealt.mapInArrow(run, "part int, n int, rids binary, v binary, low binary, high binary, total binary"))


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Indexes of the entries that may be nearest to a point of the box; of equal
    entries the first."""
    below, above = low - entries, entries - high
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
    greatest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=1)
    near = np.flatnonzero(least <= greatest.min())
    return near[np.sort(np.unique(entries[near], axis=0, return_index=True)[1])]


def nearest(x: np.ndarray, entries: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every row of ``x`` among the shortlist."""
    gap = ((x[:, None, :] - entries[short][None, :, :]) ** 2).sum(axis=2)
    at = gap.argmin(axis=1)  # the first, and so the lowest, of equal ones
    return short[at], gap[np.arange(len(x)), at]


def _blocks(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], width: int) -> Iterator[tuple]:
    """(part, n, rids, x, total, shortlist) of every block; x is unpacked on demand."""
    for batch in batches:
        for p, n, rids, v, low, high, total in zip(*[batch.column(c).to_pylist() for c in ("part", "n", "rids", "v", "low", "high", "total")]):
            yield p, n, rids, lambda v=v, n=n: unpacked(v, n * width).reshape(n, width), np.frombuffer(total, np.int64), shortlist(unpacked(low, width), unpacked(high, width), books[p])


def sums(blocks: DataFrame, books: list[np.ndarray]) -> list:
    """Rows (part, entry, position, s): the sum of each component over the rows
    nearest to an entry; position -1 has their number."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(books), len(books[0]), width + 1), np.int64)
        for p, n, _, x, whole, short in _blocks(batches, books, width):
            if len(short) == 1:
                total[p, short[0], :width] += whole
                total[p, short[0], width] += n
                continue
            points = x()
            entry, _ = nearest(points, books[p], short)
            for e in np.unique(entry):
                own = points[entry == e]
                total[p, e, :width] += own.sum(axis=0)
                total[p, e, width] += len(own)
        at = np.argwhere(total[..., width] > 0)
        p, e = np.repeat(at, width + 1, axis=0).T if len(at) else (np.zeros(0, np.int64),) * 2
        position = np.tile(np.arange(width + 1), len(at))
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (p, e, np.where(position == width, -1, position), total[p, e, position])],
                                         names=["part", "entry", "position", "s"])

    found = blocks.select("part", "n", F.lit(None).cast("binary").alias("rids"), "v", "low", "high", "total").mapInArrow(run, "part long, entry long, position long, s long")
    return found.groupBy("part", "entry", "position").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect()


def moved(books: list[np.ndarray], found: list) -> list[np.ndarray]:
    """Codebooks with every used entry at the floored mean of its parts."""
    out, cells = [b.copy() for b in books], {(r["part"], r["entry"], r["position"]): int(r["s"]) for r in found}
    for (p, e, position), s in cells.items():
        if position >= 0:
            out[p][e, position] = s // cells[p, e, -1]
    return out


def assigned(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(rid, part, entry, gap) for every part of every vector."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, n, rids, x, _, short in _blocks(batches, books, width):
            entry, gap = nearest(x(), books[p], short)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(rids, np.int64)), pa.array(np.full(n, p, np.int32)), pa.array(entry.astype(np.int32)), pa.array(gap)],
                                             names=["rid", "part", "entry", "gap"])

    return blocks.mapInArrow(run, "rid long, part int, entry int, gap long")


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(c) for book in books for c in book.ravel()).encode()).hexdigest()


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE, parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, list[np.ndarray]]:
    """The codes (key, label, code, error), one row per kept row of ``df``, and the
    final codebooks, one array (entry, position) per part."""
    kept = integer_rows(df, scale, vector, {"key": key, "label": label})
    in_order = [F.col("key").asc_nulls_last(), "dims", "v"]
    first = kept.orderBy(*in_order).first()
    dims = first["dims"] if first else parts
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    kept = kept.where(F.col("dims") == dims)
    start = np.array([unpacked(r["v"], dims) for r in kept.orderBy(*in_order).limit(entries).collect()], np.int64).reshape(-1, dims)
    books = np.split(start, parts, axis=1)
    blocks = flat_blocks(part_rows(kept, dims, parts, int(kept.agg(F.max("top")).first()[0] or 0)), dims // parts, block)
    for _ in range(rounds):
        books = moved(books, sums(blocks, books))
    of = lambda p: F.max(F.when(F.col("part") == p, F.lower(F.lpad(F.hex("entry"), 2, "0"))))
    codes = assigned(blocks, books).groupBy("rid").agg(F.concat(*[of(p) for p in range(parts)]).alias("code"), F.sum("gap").alias("error"))
    return kept.select("rid", "key", "label").join(codes, "rid").drop("rid"), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` plus label_error, the errors added up over equal labels (NULLs are equal)."""
    codes = materialize(codes)
    per_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(sized_broadcast(materialize(per_label)), F.col("label").eqNullSafe(F.col("of"))).drop("of")


def query(spark, sf_dir):
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(codes).select(F.col("key").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    def assign(r: int) -> str:
        gap = "CAST(list_sum(list_transform(list_zip(s.x, c.x), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS BIGINT)"
        return f"""a{r} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min(gap) AS gap, arg_min(e, (gap, e)) AS e
  FROM (SELECT s.vec_id, s.p, s.x, c.e, {gap} AS gap FROM parts s JOIN c{r} c ON s.p = c.p) GROUP BY vec_id, p)"""

    def move(r: int) -> str:
        mean = ", ".join(f"CAST(floor(CAST(sum(x[{i}]) AS DOUBLE) / count(*)) AS BIGINT)" for i in range(1, 9))
        return f"""c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (SELECT p, e, [{mean}] AS x FROM a{r} GROUP BY p, e) m ON c.p = m.p AND c.e = m.e)"""

    steps = ",\n".join(step(r) for r in range(ROUNDS) for step in (assign, move))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS place
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, place, p, list_slice(v, 8 * p + 1, 8 * p + 8) AS x FROM kept, range(8) t(p)),
c0 AS MATERIALIZED (SELECT p, place AS e, x FROM parts WHERE place < 16),
{steps},
{assign(ROUNDS)},
codes AS (SELECT vec_id, string_agg(lpad(lower(hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(gap) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY p, e)) AS sha FROM c{ROUNDS})
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, (SELECT sha FROM books) AS codebooks_sha256
FROM codes c JOIN kept k ON c.vec_id = k.vec_id
"""


ORACLE = _oracle()
