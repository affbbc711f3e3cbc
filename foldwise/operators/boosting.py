"""Histogram boosting of many models in shared passes (L3).

Features are binned once, by learned equal-mass edges, and stored as one byte per
feature.  A run is a training set (a bit of the rows' masks) with its own depth or
number of leaves, step size, row and column shares.  All runs grow their next tree
together: in a pass every task adds up gradient, Hessian and rows by (run, node,
feature, bin) from the bins it reads, Spark adds the tasks' sums, and the driver picks
the best split of each open node.  A tree of depth d takes d passes, whatever the
number of runs and rows; a tree grown leaf by leaf takes one for every split.

The sum of the trees so far is stored with each row and run every ``KEEP`` steps; passes
in between add the few trees since then, and only those of the runs that they are for.  Runs that differ only in their number of
steps are one run: its stages are scored on the way.

Rows with the same bins, label and masks are alike in every pass but for the draws of a
tree.  :func:`merged` makes one of them, with the hashes of its keys, so a pass costs
as many rows as there are different ones; a draw counts the hashes.

Differences from libraries of boosted trees: bins are the learned ones only, a row's or
column's draw follows from a hash (so reruns agree, on any cluster), and columns are
drawn per tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import learned_bin_code
from ..session import materialize
from .fit import quantile_edges
from .split_stats import TRAIN, VALID

BINS = 32
KEEP = 4
PIECE = 4096  # rows that a task works on at once


@dataclass(frozen=True)
class Run:
    """One model: its training set and how its trees grow (by ``max_depth``, or to
    ``num_leaves`` by the best gain first)."""
    split: int
    max_depth: int | None = 3
    num_leaves: int | None = None
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample: float = 1.0
    l2: float = 1.0
    min_hessian: float = 1.0


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has feature -1."""
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    depth: list = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, at, at + 1
        for _ in range(2):
            for own, new in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.depth, self.depth[node] + 1)):
                own.append(new)
        return at, at + 1

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``bins`` (rows x features)."""
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.cut, self.left, self.right))
        leaf = feature < 0
        feature, cut = np.where(leaf, 0, feature), np.where(leaf, 255, cut)  # a leaf's rows go to its left: itself
        here = np.arange(len(feature))
        left, right = np.where(leaf, here, left), np.where(leaf, here, right)
        step = np.stack([right, left], axis=1).ravel()
        flat, first = np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
        at = np.zeros(len(bins), np.int64)
        for _ in range(max(self.depth)):
            at = step[2 * at + (flat[first + feature[at]] <= cut[at])]
        return at


def feature_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Learned inner edges of every feature."""
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]))
    found = quantile_edges(df.select(one.alias("_c")).select("_c.*"), "value", bins, by=["feature"])
    by = {r["feature"]: list(r["edges"]) for r in found.collect()}  # features x bins
    return [by.get(c, []) for c in features]


def binned_rows(df: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]], key: str, label: str) -> DataFrame:
    """(row, y, masks, b, s): a hash of the key, label, masks and one byte per feature
    (a missing value is in the first bin), stored; no trees yet."""
    code = [F.coalesce(learned_bin_code(F.col(c).cast("double"), F.array(*[F.lit(float(e)) for e in own])), F.lit(0)) if own else F.lit(0)
            for c, own in zip(features, edges)]
    hexed = F.concat(*[F.lpad(F.hex(c.cast("long")), 2, "0") for c in code])
    return materialize(df.select(F.xxhash64(F.col(key)).alias("row"), F.col(label).cast("double").alias("y"), TRAIN, VALID, F.unhex(hexed).alias("b"),
                                 F.lit(None).cast("binary").alias("s")))


def merged(rows: DataFrame) -> DataFrame:
    """:func:`binned_rows` with equal rows made one, ``row`` the hashes of their keys one
    after the other.  They meet by a range of (bins, label, masks, key), so many equal rows are
    several tasks' work; a batch of a task merges what it holds."""
    same = ["b", "y", TRAIN, VALID]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            parts = [_bytes(batch.column("b")).reshape(n, -1), *(batch.column(c).to_numpy()[:, None] for c in same[1:])]
            new = np.any([(x[1:] != x[:-1]).any(axis=1) for x in parts], axis=0)
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            keys = batch.column("row").to_numpy()
            ends = pa.array(np.append(starts, n).astype(np.int32) * 8, pa.int32())
            own = pa.Array.from_buffers(pa.binary(), len(starts), [None, ends.buffers()[1], pa.py_buffer(np.ascontiguousarray(keys).tobytes())])
            kept = batch.take(pa.array(starts))
            yield pa.RecordBatch.from_arrays([own, *[kept.column(c) for c in ("y", TRAIN, VALID, "b", "s")]], names=["row", "y", TRAIN, VALID, "b", "s"])

    near = rows.select("row", "y", TRAIN, VALID, "b", "s").repartitionByRange(*same, "row").sortWithinPartitions(*same)
    return materialize(near.mapInArrow(run, f"row binary, y double, {TRAIN} long, {VALID} long, b binary, s binary"))


def _hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
    """The key hashes of the rows, and of merged rows where each one's start."""
    if not (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        return column.to_numpy(), None
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 8
    return _bytes(column).view(np.int64), np.cumsum(sizes) - sizes


def _number(column: pa.Array) -> np.ndarray | None:
    """How many rows a merged one stands for; None for plain rows."""
    hashes, starts = _hashes(column)
    return None if starts is None else np.diff(np.append(starts, len(hashes)))


def _weights(column: pa.Array, step: int, share: float, seed: int) -> np.ndarray:
    """How many of each row are drawn (true or false for plain rows)."""
    hashes, starts = _hashes(column)
    if starts is not None and share >= 1:
        return _number(column).astype(np.float64)
    own = drawn(hashes, step, share, seed)
    return own if starts is None else np.add.reduceat(own.astype(np.float64), starts)


def drawn(row: np.ndarray, step: int, share: float, seed: int) -> np.ndarray:
    """Rows of a tree: a hash of (row, step, seed) below ``share``."""
    if share >= 1:
        return np.ones(len(row), bool)
    with np.errstate(over="ignore"):
        h = (row.astype(np.uint64) ^ np.uint64(step * 0x9E3779B9 + seed)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


def columns_of(n: int, step: int, share: float, seed: int) -> np.ndarray:
    if share >= 1:
        return np.arange(n)
    order = np.random.default_rng([seed, step]).permutation(n)
    return np.sort(order[:max(1, round(share * n))])


def _pieces(batches: Iterator[pa.RecordBatch], n_runs: int, since: list[list[tuple[Tree, float]]], wanted: Sequence[int]) -> Iterator[tuple]:
    """(batch, bins, label, train, valid, row, scores of the ``wanted`` runs, one row each)
    with the trees that are not stored yet added."""
    for batch in batches:
        for i in range(0, batch.num_rows, PIECE):
            part = batch.slice(i, PIECE)
            n = part.num_rows
            bins = _bytes(part.column("b")).reshape(n, -1)
            stored = part.column("s")
            scores = np.zeros((len(wanted), n)) if stored.null_count else _bytes(stored).view(np.float64).reshape(n, n_runs).T[list(wanted)]
            for at, m in enumerate(wanted):
                for tree, rate in since[m]:
                    scores[at] += rate * np.array(tree.value)[tree.nodes(bins)]
            yield part, bins, part.column("y").to_numpy(), part.column(TRAIN).to_numpy(), part.column(VALID).to_numpy(), part.column("row"), scores


def _bytes(column: pa.Array) -> np.ndarray:
    """The bytes of a binary column without nulls, one value after the other."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]]


def histograms(rows: DataFrame, runs: Sequence[Run], trees: Sequence[Tree], wanted: dict[int, list[int]], since: list, step: int, n_bins: int, seed: int) -> dict:
    """{(run, node): array (feature, bin, [gradient, Hessian, rows])} of the wanted nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        place = {m: np.full(len(trees[m].feature), -1) for m in wanted}  # of a node among the wanted ones
        for m, nodes in wanted.items():
            place[m][nodes] = np.arange(len(nodes))
        draws = {}
        for _, bins, y, train, _, row, scores in _pieces(batches, len(runs), since, list(wanted)):
            by_feature = np.ascontiguousarray(bins.T)
            draws.clear()
            for (m, nodes), score in zip(wanted.items(), scores):
                share = runs[m].subsample
                if share not in draws:
                    draws[share] = _weights(row, step, share, seed)
                at = place[m][trees[m].nodes(bins)]
                own = np.flatnonzero((train >> runs[m].split & 1).astype(bool) & (draws[share] > 0) & (at >= 0))
                if not len(own):
                    continue
                p = 1 / (1 + np.exp(-score[own]))
                first, g, h = at[own] * n_bins, p - y[own], p * (1 - p)
                many = None if draws[share].dtype == bool else draws[share][own]
                if many is not None:
                    g, h = g * many, h * many
                size = len(nodes) * n_bins
                if m not in total:
                    total[m] = np.zeros((3, len(by_feature), size))
                for f, cell in enumerate(first + np.take(by_feature, own, axis=1)):
                    for to, weight in zip(total[m], (g, h, many)):
                        to[f] += np.bincount(cell, weight, size)
        for m, x in total.items():
            for node, own in zip(wanted[m], x.reshape(*x.shape[:2], -1, n_bins).transpose(2, 1, 3, 0)):
                if own[..., 2].any():
                    yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([node], pa.int32()), pa.array([own.ravel().tolist()], pa.list_(pa.float64()))], names=["run", "node", "sums"])

    found = rows.mapInArrow(run, "run int, node int, sums array<double>").groupBy("run", "node").agg(Summarizer.sum(array_to_vector(F.col("sums"))).alias("sums"))
    return {(r["run"], r["node"]): r["sums"].toArray().reshape(-1, n_bins, 3) for r in found.collect()}


def best_split(hist: np.ndarray, columns: np.ndarray, run: Run) -> tuple:
    """(gain, feature, cut, left sums, right sums): the highest gain, of equals the lowest
    feature and cut; gain 0 if no split is allowed."""
    left = np.cumsum(hist[columns], axis=1)[:, :-1]
    whole = hist[columns[0]].sum(axis=0)
    right = whole - left
    of = lambda s: s[..., 0] ** 2 / (s[..., 1] + run.l2)
    gain = 0.5 * (of(left) + of(right) - of(whole))
    allowed = (left[..., 1] >= run.min_hessian) & (right[..., 1] >= run.min_hessian) & (left[..., 2] > 0) & (right[..., 2] > 0)
    gain = np.where(allowed, np.round(gain, 9), 0.0)  # sums in another order must not change a tie
    if gain.size == 0 or gain.max() <= 0:
        return 0.0, -1, 0, whole, whole
    f, b = np.unravel_index(gain.argmax(), gain.shape)
    return float(gain[f, b]), int(columns[f]), int(b), left[f, b], right[f, b]


def grow(rows: DataFrame, runs: Sequence[Run], since: list, step: int, n_features: int, n_bins: int, seed: int) -> list[Tree]:
    """The next tree of every run."""
    trees = [Tree() for _ in runs]
    columns = [columns_of(n_features, step, r.colsample, seed) for r in runs]
    open_: list[dict[int, tuple]] = [{} for _ in runs]  # by node: its best split
    wanted = {m: [0] for m in range(len(runs))}
    while wanted:
        hists = histograms(rows, runs, trees, wanted, since, step, n_bins, seed)
        asked, wanted = wanted, {}
        for m, nodes in asked.items():
            run, tree = runs[m], trees[m]
            for node in nodes:
                if (m, node) in hists:
                    found = best_split(hists[m, node], columns[m], run)
                    open_[m][node] = found
                    if node == 0:
                        tree.value[0] = -found[3][0] / (found[3][1] + run.l2) if found[1] < 0 else 0.0
            leaves = sum(f < 0 for f in tree.feature)
            ready = sorted((n for n, s in open_[m].items() if s[0] > 0), key=lambda n: (-open_[m][n][0], n))
            if run.num_leaves is not None:
                ready = ready[:max(0, min(1, run.num_leaves - leaves))]  # the best leaf only
            for node in ready:
                _, f, cut, *sides = open_[m].pop(node)
                for child, s in zip(tree.split(node, f, cut), sides):
                    tree.value[child] = -s[0] / (s[1] + run.l2)
                    if run.max_depth is None or tree.depth[child] < run.max_depth:
                        wanted.setdefault(m, []).append(child)
            if run.num_leaves is not None and sum(f < 0 for f in tree.feature) >= run.num_leaves:
                wanted.pop(m, None)
            if run.num_leaves is None:
                open_[m].clear()
    return trees


def stored(rows: DataFrame, n_runs: int, since: list) -> DataFrame:
    """The rows with the trees of ``since`` added to their stored scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, *_, scores in _pieces(batches, n_runs, since, range(n_runs)):
            own = pa.array([s.tobytes() for s in scores.T], pa.binary())
            yield part.set_column(part.schema.get_field_index("s"), "s", own)

    return materialize(rows.mapInArrow(run, rows.schema))


def hits(rows: DataFrame, runs: Sequence[Run], since: list) -> list[tuple[int, int, int, int]]:
    """(training rows, hits, validation rows, hits) of every run as it stands."""
    names = ["n_train", "hit_train", "n_valid", "hit_valid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(runs), 4), np.int64)
        for _, _, y, train, valid, row, scores in _pieces(batches, len(runs), since, range(len(runs))):
            many = _number(row)
            for m, r in enumerate(runs):
                right = (scores[m] > 0) == (y > 0)
                t, v = ((mask >> r.split & 1).astype(bool) for mask in (train, valid))
                total[m] += [x.sum() if many is None else many[x].sum() for x in (t, t & right, v, v & right)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(runs), dtype=np.int32)), *[pa.array(c) for c in total.T.copy()]], names=["run", *names])

    found = rows.mapInArrow(run, "run int, " + ", ".join(f"{n} long" for n in names)).groupBy("run").agg(*[F.sum(n).alias(n) for n in names]).collect()
    by = {r["run"]: tuple(r[n] for n in names) for r in found}
    return [by.get(m, (0, 0, 0, 0)) for m in range(len(runs))]


def boost(rows: DataFrame, runs: Sequence[Run], stages: Sequence[int], n_features: int, n_bins: int = BINS, seed: int = 42) -> tuple[list[list[Tree]], dict[int, list[tuple]]]:
    """Trees of every run after ``max(stages)`` steps, and :func:`hits` at every stage."""
    trees: list[list[Tree]] = [[] for _ in runs]
    since: list[list[tuple[Tree, float]]] = [[] for _ in runs]
    scored = {}
    for step in range(max(stages)):
        for m, tree in enumerate(grow(rows, runs, since, step, n_features, n_bins, seed)):
            trees[m].append(tree)
            since[m].append((tree, runs[m].learning_rate))
        if step + 1 in stages:
            scored[step + 1] = hits(rows, runs, since)
        if len(since[0]) >= KEEP and step + 1 < max(stages):
            rows, since = stored(rows, len(runs), since), [[] for _ in runs]
    return trees, scored
