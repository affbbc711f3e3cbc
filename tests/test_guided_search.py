"""The nested search's short cuts: guides instead of Hessians, cells instead of values, packed rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldwise.operators import logistic
from foldwise.operators import split_stats as V
from foldwise.operators.folds import assign_folds
from foldwise.operators.logistic import Fit
from foldwise.operators.split_stats import TRAIN, Splits
from foldwise.plans import splits as S
from foldwise.session import materialize


def plain():
    class Plain:
        """Split 0 has all rows, the others leave out every third one, the last has none."""

        def __call__(self, batch, splits):
            x = np.array(batch.column("x").to_pylist())
            y, i = batch.column("y").to_numpy().astype(float), batch.column("i").to_numpy()
            for s in splits:
                train = np.ones(len(y), bool) if s == 0 else i % 3 != s - 1 if s < 4 else np.zeros(len(y), bool)
                yield s, x, y, train, ~train

    return Plain()


@pytest.mark.parametrize("rare", [False, True])
def test_guided_models_reach_their_own_optimum_without_hessians_of_their_own(spark, monkeypatch, rare):
    rng = np.random.default_rng(3)
    x = np.hstack([rng.normal(size=(3000, 3)), rng.random((3000, 2)) < 0.4])
    if rare:  # a column that only rows of one third have
        x[:, 4] = (np.arange(3000) % 3 == 1) & (rng.random(3000) < 0.01)
    y = (x @ [1.0, -0.5, 0.2, 0.7, 2.0] + rng.logistic(size=3000) > 0.3).astype(int)
    df = materialize(spark.createDataFrame([(i, int(t), [float(v) for v in r]) for i, (t, r) in enumerate(zip(y, x))], "i int, y int, x array<double>").repartition(4))
    fits = [Fit(s, c) for s in (1, 2, 3, 4) for c in ((0, 1), (0, 1, 2, 3, 4))] + [Fit(2, (0, 3))]
    guides = [Fit(0, (0, 1)), Fit(0, (0, 1, 2, 3, 4))]
    want, led = logistic.fit_many(df, plain(), fits), logistic.fit_many(df, plain(), guides)
    asked, real = [], logistic._sums
    monkeypatch.setattr(logistic, "_sums", lambda design, own, w: asked.extend(own[m] for m in w) or real(design, own, w))
    got, led_got = logistic.fit_guided(df, plain(), fits, guides, [0, 1, 0, 1, 0, 1, 0, 1, 0])
    for a, b in zip([*got, *led_got], [*want, *led]):
        assert np.allclose(a, b, atol=1e-8)
    assert not got[6].any()  # no training rows
    assert rare or all(f.split == 0 for f in asked)


def test_medians_from_the_values_of_a_few_cells(spark):
    splits = Splits(outer_k=2, inner_k=2)
    df = spark.range(3000).select("id", (F.col("id") % 2).cast("int").alias("y"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("g"),
                                  F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 7 == 0, 0.0).otherwise(F.xxhash64("id") % 100000 / 7).alias("v"))
    rows = materialize(V.with_masks(df, "id", "y", splits))
    cuts = V.cut_points(rows, {"v": F.col("v")}, 64)["v"]
    found, _ = V.tiered_medians(rows, [["g"], []], ["g"], "v", splits, cuts)
    whole = V.finest_counts(rows, ["g"], "v", splits)
    key = lambda t: sorted((r["_tier"], r["g"] or "", r[V.INDEX], r["q"]) for r in t.collect())
    assert key(found) == key(V.tiered_vectors(whole, [["g"], []], ["g"], splits))
    cells = materialize(V.narrowed_counts(rows, ["g"], "v", splits, cuts))
    kept = V.cells_of(V._rolled(cells, [["g"], []], ["g"], splits), ["_tier", "g"], "_v", [0.5], splits)
    assert V.narrowed_counts(rows, ["g"], "v", splits, cuts, kept).count() < whole.count() / 2


def test_cells_count_every_value_of_every_split(spark):
    splits = Splits(outer_k=2, nested=False)  # three
    df = spark.createDataFrame([(1, 7, [1.5], ["a"]), (0, 3, [-0.0], ["b"]), (0, 5, [0.0], [None]), (1, 5, [1.5, 2.5, 2.5], ["a", "b", "a"]), (1, 1, [None], ["c"])],
                               f"y int, {TRAIN} long, n array<double>, c array<string>").repartition(2)
    got = {(r["feature"], r["num"], r["cat"], r["y"]): [r[c] for c in splits.counts] for r in V.counted_cells(df, "y", splits, ["n"], ["c"], {"n": [0.5, 1.5]}, {"n": [1.5]}).collect()}
    inf = float("inf")
    assert got == {("n", 1.5, None, 1): [2, 1, 1], ("n", 0.5, None, 0): [2, 1, 1], ("n", inf, None, 1): [0, 0, 1], ("c", None, "a", 1): [2, 1, 2], ("c", None, "b", 0): [1, 1, 0],
                   ("c", None, "c", 1): [1, 0, 0]}
    assert V.array_moments(df, {"n": 1.0}, splits)["n"][1] == pytest.approx((0.75, 0.75))


def test_packed_rows_give_each_split_its_matrix():
    design = S.Design("y", {"AgeFilled": [(1.0, 2.0), (0.0, 1.0), (0.5, 4.0)], "FareFilled": [(0.0, 1.0)] * 3}, {c: ["a", "b"] for c in S.CATEGORICAL_COLUMNS})
    values = [[1.0], [2.0, 3.0, 2.0], [4.0, 4.0, 4.0], [None]]
    words = [["a"], ["a", "b", "z"], [None], ["b"]]
    batch = pa.RecordBatch.from_pydict({**{c: pa.array(values, pa.list_(pa.float64())) for c in S.NUMERIC}, **{c: pa.array(words, pa.list_(pa.string())) for c in S.CATEGORICAL_COLUMNS},
                                        "y": pa.array([0, 1, 1, 0]), TRAIN: pa.array([7, 3, 1, 5]), V.VALID: pa.array([0, 4, 6, 2])})
    for order in ([0, 1, 2], [2, 0]):
        for s, x, y, train, valid in design(batch, order):
            at = lambda v: v[s if len(v) > 1 else 0]  # noqa: E731,B023
            numbers = np.array([at(v) or 0.0 for v in values])
            mean, deviation = design.scale["AgeFilled"][s]
            assert np.allclose(x[:, 0], (numbers - mean) / deviation) and np.allclose(x[:, 5], numbers)
            hot = np.array([[at(w) == c for c in ("a", "b")] for w in words], float)
            assert np.array_equal(x[:, len(S.NUMERIC):], np.tile(hot, len(S.CATEGORICAL_COLUMNS)))
            assert train.tolist() == [bool(m >> s & 1) for m in (7, 3, 1, 5)]


def test_rows_are_numbered_from_one_reading(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("y"))
    plain = {r["id"]: r["fold"] for r in assign_folds(df, "id", "y", 4, 42).collect()}
    assert {r["id"]: r["fold"] for r in assign_folds(df, "id", "y", 4, 42, stored=True).collect()} == plain


def test_a_band_is_one_value_where_the_splits_agree(spark):
    edges = [[1.0, 5.0], [1.5, 5.0]]
    rows = [([0.5],), ([1.2],), ([3.0],), ([1.2, 3.0],), ([None],)]
    df = spark.createDataFrame(rows, "v array<double>")
    got = [r[0] for r in df.select(S._bands(F.col("v"), edges, F.sequence(F.lit(0), F.lit(1)))).collect()]
    assert got[:4] == [["Q1"], ["Q2", "Q1"], ["Q2"], ["Q2", "Q2"]] and set(got[4]) == {None}
