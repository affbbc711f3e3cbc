"""What a pass of the boosted models shares, and what it leaves out."""

import numpy as np
import pyarrow as pa
import pytest

from foldwise.operators import boosting as bo
from foldwise.operators.split_stats import TRAIN, VALID


@pytest.mark.parametrize("steps, times", [(2, 0), (3, 1), (4, 1)])
def test_scores_are_not_stored_after_the_last_step(monkeypatch, steps, times):
    stored = []
    monkeypatch.setattr(bo, "KEEP", 2)
    monkeypatch.setattr(bo, "grow", lambda rows, runs, *_: [bo.Tree() for _ in runs])
    monkeypatch.setattr(bo, "hits", lambda *_: [])
    monkeypatch.setattr(bo, "stored", lambda rows, *_: stored.append(1) or rows)
    bo.boost(None, [bo.Run(0)], [steps], 1)
    assert len(stored) == times


def test_a_pass_scores_only_the_runs_that_it_is_for(monkeypatch):
    seen = []
    nodes = bo.Tree.nodes
    monkeypatch.setattr(bo.Tree, "nodes", lambda tree, bins: seen.append(tree) or nodes(tree, bins))
    n = 20
    batch = pa.RecordBatch.from_pydict({"row": pa.array(range(n)), "y": pa.array([0.0] * n), TRAIN: pa.array([3] * n), VALID: pa.array([0] * n),
                                        "b": pa.array([bytes([i, 1]) for i in range(n)], pa.binary()),
                                        "s": pa.array([np.array([1.0, 10.0 + i, 2.0]).tobytes() for i in range(n)], pa.binary())})
    trees = [bo.Tree() for _ in range(3)]
    for t in trees:
        a, b = t.split(0, 0, 9)
        t.value[a], t.value[b] = 1.0, 3.0
    (_, bins, *_, scores), = bo._pieces(iter([batch.slice(4)]), 3, [[(t, 0.5)] for t in trees], [1])
    assert seen == [trees[1]] and bins[:, 0].tolist() == list(range(4, n))
    assert scores.tolist() == [[10.0 + i + (0.5 if i <= 9 else 1.5) for i in range(4, n)]]


def test_equal_rows_are_one_and_count_as_many(spark):
    """Histograms and hits of merged rows are those of the rows, draws included."""
    rng = np.random.default_rng(4)
    rows = [(i, float(rng.random() < 0.4), int(rng.integers(0, 4)), 0, bytes(rng.integers(0, 3, 2).tolist()), None) for i in rng.integers(-2**62, 2**62, 600).tolist()]
    df = spark.createDataFrame(rows, f"row long, y double, {TRAIN} long, {VALID} long, b binary, s binary").repartition(3)
    one = bo.merged(df)
    assert one.count() < 200
    runs = [bo.Run(0, subsample=0.7), bo.Run(1)]
    want, got = (bo.boost(x, runs, [5], 2, 3) for x in (df, one))
    assert want[1] == got[1]
    for x, y in zip(sum(want[0], []), sum(got[0], [])):
        assert (x.feature, x.cut, x.left) == (y.feature, y.cut, y.left) and np.allclose(x.value, y.value)
    a, b = (bo.histograms(x, runs, [bo.Tree(), bo.Tree()], {0: [0], 1: [0]}, [[], []], 3, 3, 42) for x in (df, one))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)
