import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN = float("nan")


def frame(spark, rows, parts=3, extra=""):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra.split():
        df = df.selectExpr("*", f"concat('x', vec_id) AS `{name}`")
    return df.repartition(parts) if rows else df


def floats(x):
    return [float(np.float32(v)) for v in x]


def plain(rows, step=10, k=5, m=3, scale=256):
    """Every inner product, from the definition."""
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, v, lab in rows
            if lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    last = lambda i: (i is None, i or 0)
    for at, (aid, alab, a) in enumerate(kept):
        if aid is None or aid % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), last(i), lab == alab, i) for n, (i, lab, v) in enumerate(kept) if n != at)
        for ps, _, same, pid in [s for s in scored if s[2]][:k]:
            fit = [s for s in scored if not s[2] and -50 * ps <= -100 * s[0] <= -95 * ps][:m]
            out += [(aid, pid, rank, nid, -ps, -ns) for rank, (ns, _, _, nid) in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(df, step=10, **rules):
    got = hn.mine(df, anchors=F.col("id") % step == 0, **rules)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(n, seed=2, dims=8, labels=4, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(6)]
    return [(i, floats(scale * rng.uniform(0.3, 2) * x for x in (rng.gauss(c, 0.15) for c in rng.choice(centres))), rng.randrange(labels)) for i in range(n)]


AWKWARD = [(None, floats([0.2] * 8), 1), (None, floats([0.2] * 8), 2), (20, None, 1), (30, [], 1), (40, [NAN] + [0.0] * 7, 1), (50, [None] + [0.1] * 7, 2),
           (60, floats([0.3] * 8), None), (2000, [0.0] * 8, 1), (2010, floats([0.4] * 8), 1), (2010, floats([0.4] * 8), 1), (2010, floats([0.4] * 8), 2),
           (2020, floats([-0.4] * 8), 77), (2030, [float("inf")] * 8, 1)]


@pytest.mark.parametrize("rules", [{}, {"bucket_cells": 128, "anchor_block": 3}, {"focus": 1, "bucket_cells": 512}, {"focus": 8, "bucket_cells": 256}])
def test_against_every_product(spark, rules):
    rows = corpus(260) + AWKWARD + [(3000 + i, floats([0.25, 0.5] * 4), i % 2) for i in range(120)]  # a hot vector in two labels
    assert mined(frame(spark, rows, extra="id rid label_low rank score v extra"), **rules) == plain(rows)


def test_one_hot_label(spark):
    rows = [(i, v, 0 if i % 3 else 5 + i) for i, v, _ in corpus(200, seed=5)]
    assert mined(frame(spark, rows), bucket_cells=128) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(10, None, 1)], [(10, floats([0.5] * 4), 1)], [(10, floats([0.5] * 4), 1), (11, floats([0.5] * 4), 1), (12, floats([0.3] * 4), 2)]])
def test_few_rows(spark, rows):
    assert mined(frame(spark, rows)) == plain(rows)


def test_large_components_and_other_lengths(spark):
    rows = corpus(60, scale=50_000.0)
    odd = [(5000, floats([0.5] * 3), 1), (5010, floats([3e38] * 8), 1)]
    assert mined(frame(spark, rows + odd)) == plain(rows)


def test_the_lists_prune_and_lose_nothing():
    rng = np.random.default_rng(7)
    dims, n, m = 8, 400, 30
    v = rng.normal(size=(n, dims))
    v = np.floor(300 * v / np.sqrt((v ** 2).sum(axis=1))[:, None]).astype(np.int64)  # a bucket's rows have about one length
    q = v[rng.integers(0, n, m)] + rng.integers(-20, 20, (m, dims))
    as_row = lambda x: (len(x), *(np.arange(len(x)).tobytes(),) * 2, np.zeros(len(x), np.uint8).tobytes(), np.zeros(len(x), np.int64).tobytes(), hn.packed(x))
    length = np.sqrt((v.astype(float) ** 2).sum(axis=1))
    orders = np.argsort((v / length[:, None]).T, axis=1, kind="stable").astype(np.uint16).tobytes()
    bucket, anchors = hn.Bucket(*as_row(v), orders=orders, dims=dims), hn.Anchors(*as_row(q), scores=b"", dims=dims, focus=4)
    score = v @ q.T
    least = np.floor(0.9 * np.sqrt((q ** 2).sum(axis=1)) * 300)
    first, end, _, _ = hn.feasible(bucket, anchors, np.arange(m), least)
    assert (end - first).min(axis=1).mean() < 0.5 * n  # the shortest list is narrower than the bucket
    assert min((score >= least).sum(axis=0)) > 0
    for whole in (0.0, 0.25, 1.0):
        found = {a: dict(zip(rows.tolist(), scores.tolist())) for a, rows, scores in hn.candidates(bucket, anchors, np.arange(m), least, whole)}
        for a in range(m):
            assert found.get(a, {}) == {i: s for i, s in enumerate(score[:, a].tolist()) if s >= least[a]}
