"""E5c against a brute-force evaluation of the same estimator."""

import collections
import random

import pytest

from foldwise.operators.select import knn_mutual_information


def _digamma(n):
    return sum(1.0 / i for i in range(1, n)) - 0.5772156649015329


def brute(vals, labs, k=3):
    cnt = collections.Counter(labs)
    pts = [(v, lab) for v, lab in zip(vals, labs) if cnt[lab] > 1]
    n = len(pts)
    sk = sn = sm = 0.0
    for v, lab in pts:
        kk = min(k, cnt[lab] - 1)
        r = sorted(abs(v - w) for w, l2 in pts if l2 == lab)[kk]     # [0] is the point itself
        m = sum(1 for w, _ in pts if v - r < w < v + r) if r > 0 else sum(1 for w, _ in pts if w == v)
        sk += _digamma(kk)
        sn += _digamma(cnt[lab])
        sm += _digamma(m)
    return max(0.0, _digamma(n) + sk / n - sn / n - sm / n)


def test_knn_mi_matches_brute_force(spark):
    rnd = random.Random(3)
    rows, data = [], {}
    for f in ("ints", "gauss", "small"):
        n = 4 if f == "small" else 250
        vals, labs = [], []
        for i in range(n):
            y = rnd.randint(0, 1) if f != "small" else i % 2
            v = float(rnd.randint(0, 30) + 2 * y) if f == "ints" else rnd.gauss(y, 1.0)
            vals.append(v)
            labs.append(y)
            rows.append((i, f, v, y))
        vals.append(1.0)
        labs.append(7)                      # a one-point class is ignored
        rows.append((10_000, f, 1.0, 7))
        data[f] = (vals, labs)
    df = spark.createDataFrame(rows, "id long, feature string, value double, y int")
    got = {r["feature"]: r["mi"] for r in knn_mutual_information(df, "id", "y").collect()}
    for f, (v, lab) in data.items():
        assert abs(got[f] - brute(v, lab)) < 1e-9, f


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_neighbours_across_slices(spark, slices):
    from foldwise.operators.ranks import neighbours
    rng = random.Random(slices)
    rows = [(rng.choice(["a", "a", "a", None, "b"]), i, float(rng.randint(0, 6)) if i % 9 else None) for i in range(120)] + [("alone", 500, 1.0)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    got = {r["id"]: (r["_i"], r["_before"], r["_after"]) for r in neighbours(df, ["id"], ["g"], "v", 4, slices).collect()}
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: r[1])
        values = [r[2] for r in own]
        at = lambda j: values[j] if 0 <= j < len(values) else None  # noqa: E731,B023
        for i, r in enumerate(own):
            assert got[r[1]] == (i, [at(i - d) for d in range(1, 5)], [at(i + d) for d in range(1, 5)])


def test_neighbours_store_only_the_borders(spark, monkeypatch):
    """Rows inside a slice are final; what meets across slices is at most 2k rows of a slice and group, stored once."""
    from foldwise.operators import ranks
    stored = []

    def counted(df):
        out = keep(df)
        stored.append(out.count())
        return out

    keep = ranks.materialize
    monkeypatch.setattr(ranks, "materialize", counted)
    df = spark.range(2000).selectExpr("id", "cast(id as double) v", "id % 2 g")
    got = ranks.neighbours(df, ["v", "id"], ["g"], "v", 3, 4)
    assert got.count() == 2000
    assert min(n for n in stored if n > 8) <= 2 * 3 * 4 * 2
