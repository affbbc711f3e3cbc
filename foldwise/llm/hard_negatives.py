"""Hard-negative mining by coordinate pruning over length buckets.

Vectors become integers (floor of ``SCALE`` times each component) and a score is an
exact integer inner product.  The rows are dealt by range of (label, length) into
buckets of neighbours, which hold their vectors flat and, for every coordinate, the
list of their rows sorted by that coordinate of the vector scaled to length one.
A few buckets in a row are a tile; an anchor travels, in blocks of anchors, to every
tile that may hold rows for it, and the tile's task searches its buckets:

* a bucket whose longest vector can't reach the anchor's running threshold is left;
* else the threshold is an angle, and each of the anchor's ``FOCUS`` largest
  coordinates has a range of values that a vector within that angle can have; the
  ranges are found in the sorted lists, and a row must lie in all of them;
* rows that do are scored exactly.  Where even the shortest list holds more than
  ``WHOLE`` of the bucket, all of it is scored by one product.

First the positives are searched (the best rows of the anchor's label), then, with
the score window of every positive as threshold, the negatives.  A task hands on the
best few rows for each anchor and tile, never pairs.

Defined results: rows with a NULL label, a NULL or empty vector, a NULL or non-finite
component, or an integer so large that scores might leave a long take no part, nor do
vectors whose length differs from that of the row with the smallest identifier; rows
with a NULL identifier are never anchors and come last in ties; repeated identifiers
are rows of their own (an anchor each); an empty table gives an empty result.  Only
the named columns are read, so other columns of the table cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, sized_broadcast, table
from .vectors import integer_rows, packed, unpacked

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
ANCHOR_STEP = 50
LEAST, MOST, OF = 50, 95, 100  # a negative's score, in hundredths of the positive's
FOCUS = 4
WHOLE = 0.25
BUCKET_CELLS = 1 << 16  # components of a bucket's vectors
TILE_BUCKETS = 4
ANCHOR_BLOCK = 1024
SCORE_LIMIT = 1 << 57
SLACK = 1e-9  # keeps rounding of the angles from losing a row

BLOCK_SCHEMA = ("tile long, kind int, seq long, n int, label_low long, label_high long, rids binary, ids binary, blanks binary, "
                "labels binary, v binary, extra binary")
NAMES = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]
TYPES = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[f.split()[1]] for f in BLOCK_SCHEMA.split(", ")]


# ---- blocks --------------------------------------------------------------------

class Block:
    """Rows of vectors: a bucket of the index or a block of anchors."""

    def __init__(self, n: int, rids: bytes, ids: bytes, blanks: bytes, labels: bytes, v: bytes, dims: int):
        self.rids, self.ids, self.labels = (np.frombuffer(b, np.int64) for b in (rids, ids, labels))
        self.blanks = np.frombuffer(blanks, np.uint8)
        self.v = unpacked(v, n * dims).reshape(n, dims)
        top = int(np.abs(self.v).max(initial=0))
        self.exact = dims * top * top < 1 << 50  # products of such blocks are exact as doubles too
        self.lengths = np.sqrt((self.v.astype(np.float64) ** 2).sum(axis=1))
        self.unit = self.v / np.where(self.lengths > 0, self.lengths, 1)[:, None]


class Bucket(Block):
    def __init__(self, *row, orders: bytes, dims: int):
        super().__init__(*row, dims)
        self.orders = np.frombuffer(orders, np.uint16).reshape(dims, -1)  # per coordinate, rows by rising value
        self.sorted = np.take_along_axis(self.unit.T, self.orders.astype(np.int64), axis=1)
        self.longest = float(self.lengths.max())


class Anchors(Block):
    def __init__(self, *row, scores: bytes, dims: int, focus: int):
        super().__init__(*row, dims)
        size = np.abs(self.unit)
        self.focus = np.argpartition(-size, min(focus, dims) - 1, axis=1)[:, :focus]
        self.positive = np.frombuffer(scores, np.int64).reshape(len(self.rids), -1) if scores else None


def products(bucket: Block, anchors: Block, at: np.ndarray) -> np.ndarray:
    """Exact scores of all rows of the bucket (rows) with some anchors (columns)."""
    if bucket.exact and anchors.exact:
        return (bucket.v.astype(np.float64) @ anchors.v[at].T.astype(np.float64)).astype(np.int64)
    return bucket.v @ anchors.v[at].T


def feasible(bucket: Bucket, anchors: Anchors, at: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places (first, end) in the sorted list of each focus coordinate, and the values
    (low, high) there, that a row scoring ``least`` or more must lie between."""
    cos = np.clip(least / (anchors.lengths[at] * bucket.longest) - SLACK, 0, 1)[:, None]
    axis = anchors.focus[at]
    q = np.take_along_axis(anchors.unit[at], axis, axis=1)
    wide = np.sqrt((1 - cos ** 2) * np.maximum(1 - q ** 2, 0))
    low = np.where(q <= -cos, -1, q * cos - wide) - SLACK
    high = np.where(q >= cos, 1, q * cos + wide) + SLACK
    first, end = np.zeros(axis.shape, np.int64), np.zeros(axis.shape, np.int64)
    for c in np.unique(axis):
        own = axis == c
        first[own] = np.searchsorted(bucket.sorted[c], low[own], "left")
        end[own] = np.searchsorted(bucket.sorted[c], high[own], "right")
    return first, end, low, high


def candidates(bucket: Bucket, anchors: Anchors, at: np.ndarray, least: np.ndarray, whole: float = WHOLE) -> Iterator[tuple]:
    """(anchor, rows, scores) with every row of the bucket that scores at least
    ``least`` (-inf: no threshold yet), for the anchors ``at``."""
    pruned = (least > 0) & (anchors.lengths[at] > 0) & (bucket.longest > 0)
    reach = least <= anchors.lengths[at] * bucket.longest * (1 + SLACK)
    dense = at[~pruned & (least <= 0)]
    dense_least = least[~pruned & (least <= 0)]
    at, least = at[pruned & reach], least[pruned & reach]
    if len(at):
        first, end, low, high = feasible(bucket, anchors, at, least)
        size = (end - first).min(axis=1)
        broad = size > whole * len(bucket.rids)
        for j in np.flatnonzero((size > 0) & ~broad):
            a, shortest = at[j], (end[j] - first[j]).argmin()
            rows = bucket.orders[anchors.focus[a][shortest]][first[j][shortest]:end[j][shortest]].astype(np.int64)
            for k, c in enumerate(anchors.focus[a]):
                if k != shortest:
                    value = bucket.unit[rows, c]
                    rows = rows[(value >= low[j][k]) & (value <= high[j][k])]
            if len(rows):
                score = bucket.v[rows] @ anchors.v[a]
                good = score >= least[j]
                yield a, rows[good], score[good]
        dense, dense_least = np.concatenate([dense, at[broad]]), np.concatenate([dense_least, least[broad]])
    if len(dense):
        score = products(bucket, anchors, dense)
        of, rows = np.nonzero((score >= dense_least[None, :]).T)
        cuts = np.searchsorted(of, np.arange(len(dense) + 1))
        for j, a in enumerate(dense):
            own = rows[cuts[j]:cuts[j + 1]]
            yield a, own, score[own, j]


def best_first(bucket: Bucket, rows: np.ndarray, scores: np.ndarray) -> np.ndarray:
    return np.lexsort((bucket.rids[rows], bucket.ids[rows], bucket.blanks[rows], -scores))


def entries_of(bucket: Bucket, rows: np.ndarray, scores: np.ndarray) -> list[tuple]:
    """(-score, blank, id, rid): sorted, the best comes first."""
    return list(zip((-scores).tolist(), bucket.blanks[rows].tolist(), bucket.ids[rows].tolist(), bucket.rids[rows].tolist()))


# ---- the two searches ----------------------------------------------------------

def positives_in(buckets: list[Bucket], anchors: Anchors, k: int) -> Iterator[tuple]:
    """(anchor, 0, entry): the best ``k`` other rows of the anchor's label in a tile."""
    found: list[list] = [[] for _ in anchors.rids]
    least = np.full(len(found), -np.inf)
    for bucket in buckets:
        at = np.flatnonzero(np.isin(anchors.labels, bucket.labels))
        for a, rows, scores in candidates(bucket, anchors, at, least[at]):
            own = (bucket.labels[rows] == anchors.labels[a]) & (bucket.rids[rows] != anchors.rids[a])
            rows, scores = rows[own], scores[own]
            order = best_first(bucket, rows, scores)[:k]
            found[a] = sorted(found[a] + entries_of(bucket, rows[order], scores[order]))[:k]
            if len(found[a]) == k:
                least[a] = -found[a][-1][0]
    for a, own in enumerate(found):
        for entry in own:
            yield a, 0, entry


def window(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative for positives that score ``score``."""
    return -(-score * LEAST // OF), score * MOST // OF


def negatives_in(buckets: list[Bucket], anchors: Anchors, k: int) -> Iterator[tuple]:
    """(anchor, positive, entry): the best ``k`` rows of other labels in a tile inside
    the score window of each of the anchor's positives."""
    low, high = window(anchors.positive)
    used = (anchors.positive != NO_SCORE) & (low <= high)
    found: list[list[list]] = [[[] for _ in range(low.shape[1])] for _ in anchors.rids]
    worst = np.where(used, low, np.iinfo(np.int64).max)  # what a row must score to be new to a positive
    for bucket in buckets:
        one = bucket.labels.min() == bucket.labels.max()
        at = np.flatnonzero(used.any(axis=1) & ~(one & (anchors.labels == bucket.labels[0])))
        for a, rows, scores in candidates(bucket, anchors, at, worst[at].min(axis=1).astype(np.float64)):
            own = bucket.labels[rows] != anchors.labels[a]
            rows, scores = rows[own], scores[own]
            order = best_first(bucket, rows, scores)
            rows, scores = rows[order], scores[order]
            starts = np.searchsorted(-scores, -high[a], "left")  # the first that is not above the window
            for p in np.flatnonzero(used[a]):
                i = starts[p]
                if i < len(rows) and scores[i] >= worst[a, p]:
                    new = entries_of(bucket, rows[i:i + k], scores[i:i + k])
                    found[a][p] = sorted(found[a][p] + [e for e in new if -e[0] >= low[a, p]])[:k]
                    if len(found[a][p]) == k:
                        worst[a, p] = -found[a][p][-1][0]
    for a, by_positive in enumerate(found):
        for p, own in enumerate(by_positive):
            for entry in own:
                yield a, p, entry


NO_SCORE = np.iinfo(np.int64).min >> 8  # fills the places of positives that an anchor lacks


# ---- Spark ---------------------------------------------------------------------

def _blocks(rows: DataFrame, size: int, kind: int, dims: int, parts: int, keys: list[str]) -> DataFrame:
    """Blocks of ``size`` neighbours in the order ``keys``, stored.  ``rid`` is among
    the keys, so rows that are equal in the others can be split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, []

        def block() -> pa.RecordBatch:
            rids, ids, labels, vs, extras = zip(*held)
            blank = np.array([i is None for i in ids], np.uint8)
            v = np.array([unpacked(x, dims) for x in vs], np.int64)
            if kind == 0:
                length = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
                unit = v / np.where(length > 0, length, 1)[:, None]
                extra = np.argsort(unit.T, axis=1, kind="stable").astype(np.uint16).tobytes()
            else:
                extra = b"".join(e or b"" for e in extras)
            values = [(part << 32) + made // TILE_BUCKETS, kind, (part << 32) + made, len(held), min(labels), max(labels), np.array(rids, np.int64).tobytes(),
                      np.array([i or 0 for i in ids], np.int64).tobytes(), blank.tobytes(), np.array(labels, np.int64).tobytes(), packed(v), extra]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, TYPES)], names=NAMES)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("rid", "id", "label", "v", "extra")]):
                held.append(row)
                if len(held) >= size:
                    yield block()
                    made, held = made + 1, []
        if held:
            yield block()

    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return materialize(dealt.select("rid", "id", "label", "v", "extra").mapInArrow(run, BLOCK_SCHEMA))


def search(index: DataFrame, anchors: DataFrame, meets: Column, find: Callable, k: int, dims: int, focus: int = FOCUS) -> DataFrame:
    """(anchor_rid, p, score, blank, id, rid): what ``find`` gets for the anchors in
    each tile that ``meets`` lets them travel to (by the labels low, high of the tile).
    The stated anchors go to the tiles in blocks; a task holds one tile and one block."""
    tiles = index.groupBy("tile").agg(F.min("label_low").alias("low"), F.max("label_high").alias("high")).withColumnRenamed("tile", "to")
    sent = anchors.join(sized_broadcast(materialize(tiles)), meets).drop("tile", "low", "high").withColumnRenamed("to", "tile")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, buckets = None, []
        for batch in batches:
            for t, kind, n, rids, ids, blanks, labels, v, extra in zip(*[batch.column(c).to_pylist() for c in (
                    "tile", "kind", "n", "rids", "ids", "blanks", "labels", "v", "extra")]):
                if t != tile:
                    tile, buckets = t, []
                row = (n, rids, ids, blanks, labels, v)
                if kind == 0:
                    buckets.append(Bucket(*row, orders=extra, dims=dims))
                    continue
                block = Anchors(*row, scores=extra, dims=dims, focus=focus)
                out = [(int(block.rids[a]), p, -e[0], e[1], None if e[1] else e[2], e[3]) for a, p, e in find(buckets, block, k)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()])],
                                                     names=["anchor_rid", "p", "score", "blank", "id", "rid"])

    dealt = index.unionByName(sent.select(*NAMES)).repartition(shuffle_partitions(index.sparkSession), "tile").sortWithinPartitions("tile", "kind", "seq")
    return dealt.mapInArrow(run, "anchor_rid long, p int, score long, blank int, id long, rid long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per (anchor, p): each tile has sent that many at most."""
    order = Window.partitionBy("anchor_rid", "p").orderBy(F.desc("score"), "blank", "id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", anchors: Column | None = None, scale: int = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, focus: int = FOCUS, bucket_cells: int = BUCKET_CELLS, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on ``id`` (the key as a long) and ``label``; by default
    every identifier that ``ANCHOR_STEP`` divides."""
    own = df.select(F.col(key).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), F.col(vector).alias("x"))
    rows = integer_rows(own.where("label is not null"), scale, "x", {"id": "id", "label": "label"})
    first = rows.orderBy(F.col("id").asc_nulls_last(), "dims", "v").first()
    dims = first["dims"] if first else 1
    rows = rows.where((F.col("dims") == dims) & (F.col("top") <= math.isqrt(SCORE_LIMIT // dims))).withColumn("extra", F.lit(None).cast("binary"))
    n = shuffle_partitions(df.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = [math.sqrt(float((unpacked(v, dims).astype(np.float64) ** 2).sum())) for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("rid", "id", "label", "v", "extra")], pa.array(length, pa.float64())],
                                             names=["rid", "id", "label", "v", "extra", "length"])

    with_length = rows.select("rid", "id", "label", "v", "extra").mapInArrow(lengths, "rid long, id long, label long, v binary, extra binary, length double")
    index = _blocks(with_length.withColumn("shorter", -F.col("length")), max(16, bucket_cells // dims), 0, dims, n, ["label", "shorter", "rid"])
    is_anchor = anchors if anchors is not None else F.col("id") % ANCHOR_STEP == 0
    asked = rows.where(is_anchor).select("rid", "id", "label", "v", "extra")
    parts = max(1, -(-asked.count() // anchor_block))
    blocks = _blocks(asked, anchor_block, 1, dims, parts, ["label", "rid"])
    same = (F.col("label_low") <= F.col("high")) & (F.col("low") <= F.col("label_high"))
    best = materialize(_ranked(search(index, blocks, same, lambda *a: positives_in(*a), positives, dims, focus), positives))
    # the anchors again, each with the scores of its positives
    held = best.groupBy("anchor_rid").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("found"))

    def score_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = [np.array([s["score"] for s in f] + [NO_SCORE] * (positives - len(f)), np.int64).tobytes() for f in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("rid", "id", "label", "v")], pa.array(extra, pa.binary())], names=["rid", "id", "label", "v", "extra"])

    again = asked.drop("extra").join(held, F.col("rid") == F.col("anchor_rid")).select("rid", "id", "label", "v", "found").mapInArrow(
        score_bytes, "rid long, id long, label long, v binary, extra binary")
    blocks = _blocks(again, anchor_block, 1, dims, parts, ["label", "rid"])
    other = ~((F.col("label_low") == F.col("label_high")) & (F.col("low") == F.col("high")) & (F.col("low") == F.col("label_low")))
    worst = _ranked(search(index, blocks, other, lambda *a: negatives_in(*a), negatives, dims, focus), negatives)
    named = best.select(F.col("anchor_rid").alias("of"), (F.col("rank") - 1).alias("of_p"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (worst.join(named, (F.col("anchor_rid") == F.col("of")) & (F.col("p") == F.col("of_p")))
            .join(asked.select(F.col("rid").alias("own_rid"), F.col("id").alias("anchor_id")), F.col("anchor_rid") == F.col("own_rid"))
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def query(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), label=moved)


ORACLE = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda t: t[1] * t[2])) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positive AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
