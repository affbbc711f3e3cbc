"""Histogram boosting against a brute-force tree and its own definition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import boosting as bo
from foldwise.operators.boosting import Run
from foldwise.operators.split_stats import TRAIN, VALID, Splits, with_masks
from foldwise.session import materialize

FEATURES = ["x0", "x1", "x2", "x3"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(600, 4)), 2)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 0) + rng.normal(size=600) * 0.5 > 0).astype(int)
    df = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))], ["id", "y", *FEATURES])
    splits = Splits(outer_k=3, nested=False)
    masked = materialize(with_masks(df, "id", "y", splits))
    edges = bo.feature_edges(masked, FEATURES, 8)
    rows = bo.binned_rows(masked, FEATURES, edges, "id", "y")
    found = rows.toArrow()
    bins = np.frombuffer(b"".join(found["b"].to_pylist()), np.uint8).reshape(len(x), 4)
    return rows, bins, found["y"].to_numpy(), found[TRAIN].to_numpy(), found[VALID].to_numpy(), found["row"].to_numpy(), edges, masked


def test_bins_follow_the_edges(data):
    rows, bins, *_, edges, masked = data
    want = {r["id"]: [sum(e < r[c] for e in own) for c, own in zip(FEATURES, edges)] for r in masked.collect()}
    hashed = {r["id"]: r["h"] for r in masked.select("id", F.xxhash64("id").alias("h")).collect()}
    got = {r["row"]: list(r["b"]) for r in rows.collect()}
    assert got == {hashed[i]: b for i, b in want.items()} and all(1 <= len(e) <= 7 for e in edges)


def brute(bins, y, score, run, own, columns):
    """The tree by trying every split of every node."""
    p = 1 / (1 + np.exp(-score))
    g, h = p - y, p * (1 - p)
    of = lambda at: g[at].sum() ** 2 / (h[at].sum() + run.l2)
    value = lambda at: -g[at].sum() / (h[at].sum() + run.l2)

    def best(at):
        options = []
        for f in columns:
            for cut in range(7):
                left, right = at & (bins[:, f] <= cut), at & (bins[:, f] > cut)
                if left.any() and right.any() and min(h[left].sum(), h[right].sum()) >= run.min_hessian:
                    options.append((-round(0.5 * (of(left) + of(right) - of(at)), 9), f, cut))
        return min(options, default=(0.0, -1, 0))

    if run.num_leaves is None:
        out, todo = [], [(own, 0)]
        while todo:
            at, depth = todo.pop(0)
            gain, f, cut = best(at) if depth < run.max_depth else (0.0, -1, 0)
            if gain >= 0:
                out.append((at, value(at)))
            else:
                todo += [(at & (bins[:, f] <= cut), depth + 1), (at & (bins[:, f] > cut), depth + 1)]
        return out
    open_ = [own]
    while len(open_) < run.num_leaves:
        gain, i = min((best(at)[0], i) for i, at in enumerate(open_))
        if gain >= 0:
            break
        at = open_.pop(i)
        _, f, cut = best(at)
        open_ += [at & (bins[:, f] <= cut), at & (bins[:, f] > cut)]
    return [(at, value(at)) for at in open_]


@pytest.mark.parametrize("run", [Run(0, max_depth=3), Run(1, max_depth=2, l2=0.5), Run(2, max_depth=4, colsample=0.5), Run(0, max_depth=None, num_leaves=6),
                                 Run(0, max_depth=2, subsample=0.6), Run(3, max_depth=3, min_hessian=20.0), Run(1, max_depth=None, num_leaves=5, colsample=0.75, subsample=0.7)])
def test_two_trees_equal_brute_force(data, run):
    rows, bins, y, train, _, row, *_ = data
    trees, _ = bo.boost(rows, [run], [2], 4, n_bins=8)
    score = np.zeros(len(y))
    for step, tree in enumerate(trees[0]):
        own = (train >> run.split & 1).astype(bool) & bo.drawn(row, step, run.subsample, 42)
        want = brute(bins, y, score, run, own, bo.columns_of(4, step, run.colsample, 42))
        at = tree.nodes(bins)
        got = sorted((int((own & (at == n)).sum()), round(tree.value[n], 9)) for n in range(len(tree.feature)) if tree.feature[n] < 0)
        assert got == sorted((int(a.sum()), round(v, 9)) for a, v in want)
        score += run.learning_rate * np.array(tree.value)[at]


def test_runs_together_are_the_runs_alone_and_stages_are_shorter_runs(data, monkeypatch):
    rows, bins, y, train, valid, *_ = data
    monkeypatch.setattr(bo, "KEEP", 2)  # scores are stored on the way
    runs = [Run(1, max_depth=2), Run(2, max_depth=3, subsample=0.8, colsample=0.5), Run(0, max_depth=None, num_leaves=4)]
    trees, scored = bo.boost(rows, runs, [3, 5], 4, n_bins=8)
    for m, run in enumerate(runs):
        alone, one = bo.boost(rows, [run], [3], 4, n_bins=8)
        assert [t.feature for t in alone[0]] == [t.feature for t in trees[m][:3]] and one[3][0] == scored[3][m]
        for stage in (3, 5):
            score = sum(run.learning_rate * np.array(t.value)[t.nodes(bins)] for t in trees[m][:stage])
            right = (score > 0) == (y > 0)
            t, v = (train >> run.split & 1).astype(bool), (valid >> run.split & 1).astype(bool)
            assert scored[stage][m] == (t.sum(), (t & right).sum(), v.sum(), (v & right).sum())
    assert scored[5][0][1] / scored[5][0][0] > 0.75


def test_columns_and_rows_are_drawn_in_their_shares():
    row = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 20_000)
    for step in range(3):
        assert abs(bo.drawn(row, step, 0.8, 42).mean() - 0.8) < 0.02
    assert (bo.drawn(row, 0, 0.5, 42) != bo.drawn(row, 1, 0.5, 42)).any()
    assert len(bo.columns_of(10, 3, 0.8, 42)) == 8 and len({tuple(bo.columns_of(10, s, 0.5, 42)) for s in range(20)}) > 5


def test_degenerate_training_sets(spark, data):
    rows = data[0]
    empty = bo.boost(rows.where("y > 5"), [Run(0)], [1], 4, n_bins=8)
    assert empty[0][0][0].feature == [-1] and empty[1][1] == [(0, 0, 0, 0)]
    one_class, _ = bo.boost(rows.withColumn("y", F.lit(1.0)), [Run(0, max_depth=2)], [2], 4, n_bins=8)
    assert all(t.feature == [-1] and t.value[0] > 0 for t in one_class[0])
