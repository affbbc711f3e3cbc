"""Bracket-and-refine quantiles against Spark's exact percentile."""

import random

import pytest
from pyspark.sql import functions as F

from foldwise.operators import quantiles as q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(4)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(30_000)] + [(f"g{i % 7}", float(rng.randint(0, 9))) for i in range(3000)]
    rows += [("one", 3.5), ("two", 1.0), ("two", 2.0), (None, 5.0), (None, 6.0), ("none", None), ("nan", float("nan")), ("same", 2.0)] + [("same", 2.0)] * 500
    return spark.createDataFrame(rows, "g string, v double").repartition(6)


def exact(df, keys):
    clean = df.where("v IS NOT NULL AND NOT isnan(v)")
    return {tuple(r[k] for k in keys): r["q"] for r in clean.groupBy(*keys).agg(F.percentile("v", F.array(*[F.lit(p) for p in PROBS])).alias("q")).collect()}


def close(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12), k


@pytest.mark.parametrize("keys", [["g"], []])
def test_equal_to_exact_percentiles(data, keys):
    got = {tuple(r[k] for k in keys): [r[f"q{i}"] for i in range(len(PROBS))] for r in q.bracketed_quantiles(data, keys, "v", PROBS).collect()}
    close(got, exact(data, keys))


@pytest.mark.parametrize("keys", [["g"], []])
def test_a_poor_sketch_does_not_change_the_result(data, keys):
    """Eight items a sketch and no margin: brackets miss, and the groups are done again."""
    got = {tuple(r[k] for k in keys): [r[f"q{i}"] for i in range(len(PROBS))] for r in q.bracketed_quantiles(data, keys, "v", PROBS, margin=1e-4, k=8).collect()}
    close(got, exact(data, keys))


def test_only_the_values_inside_are_kept(data):
    hot = data.where("g = 'hot'")
    _, counts = q._between(hot, ["g"], "v", [0.5], q.MARGIN, q.SKETCH_K)
    assert counts.count() < 0.05 * hot.count()
    assert counts.agg(F.sum("_n")).first()[0] == hot.count()
    assert q.bracketed_quantiles(data.limit(0), ["g"], "v", [0.5]).count() == 0
