"""Fitted statistics and lookups (A1-A7, J1, J2) on fixture rows."""

import random

from pyspark.sql import functions as F

from foldwise.operators.features import Roles, apply_features, fit_features
from foldwise.operators.fit import mode, quantile_edges, tiered_quantile
from foldwise.operators.folds import fold_moments
from foldwise.operators.lookup import apply_tiered
from foldwise.operators.quantiles import grouped_quantiles


def edges(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    return quantile_edges(df, "v", q).first()["edges"]


def test_quantile_edges(spark):
    assert edges(spark, [1, 2, 10, 20], 4) == [1.75, 6.0, 12.5]
    assert edges(spark, [5, 5, 5, 5, 9], 4) == []
    assert edges(spark, [3, 3, 3], 4) == []


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), ("c",), (None,)], "x string")
    assert mode(df, "x").first()["mode"] == "a"


def test_ranked_equals_direct_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)]
    rows += [(f"g{i % 20}", float(rnd.randint(0, 50))) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.1, 0.25, 0.5, 0.9]
    direct = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    for slices in (1, 50):
        got = {r["g"]: [r[f"q{i}"] for i in range(4)] for r in grouped_quantiles(df, ["g"], "v", probs, slices=slices).collect()}
        assert got.keys() == direct.keys()
        for g in got:
            assert [round(x, 9) for x in got[g]] == [round(x, 9) for x in direct[g]]


def test_values_far_below_one_millionth(spark):
    """No rounding of learned edges or of moments."""
    df = spark.range(1000).select((F.col("id") * 1e-9).alias("v"), (F.col("id") % 5 + 1).cast("int").alias("fold"))
    edges = quantile_edges(df, "v", 4).first()["edges"]
    assert len(edges) == 3 and all(abs(e - x) < 1e-15 for e, x in zip(edges, (249.75e-9, 499.5e-9, 749.25e-9)))
    for r in fold_moments(df, ["v"], "fold", 5).collect():
        rest = [i * 1e-9 for i in range(1000) if i % 5 + 1 != r["fold"]]
        mean = sum(rest) / len(rest)
        std = (sum((x - mean) ** 2 for x in rest) / len(rest)) ** 0.5
        assert r["n"] == 800 and abs(r["mean"] / mean - 1) < 1e-9 and abs(r["std"] / std - 1) < 1e-9


def test_nan_is_missing_in_fit_and_apply(spark):
    nan = float("nan")
    rows = [(i, i % 2, 1, "A, Mr. B", "male", nan if i % 4 == 0 else 20.0 + i, 0, 0, "x", nan if i % 5 == 0 else 5.0 * i, None, "S") for i in range(1, 41)]
    cols = "PassengerId long, Survived int, Pclass int, Name string, Sex string, Age double, SibSp int, Parch int, Ticket string, Fare double, Cabin string, Embarked string"
    r = Roles()
    raw = spark.createDataFrame(rows, cols)
    plain = spark.createDataFrame([[None if isinstance(v, float) and v != v else v for v in row] for row in rows], cols)
    a = apply_features(raw, fit_features(raw, r), r).collect()
    assert sorted(a) == sorted(apply_features(plain, fit_features(plain, r), r).collect())
    assert all(x["AgeMissing"] == (x["PassengerId"] % 4 == 0) and x["FareMissing"] == (x["PassengerId"] % 5 == 0) for x in a)
    assert all(x["AgeFilled"] == x["AgeFilled"] and x["FareFilled"] == x["FareFilled"] for x in a)


def test_tiered_fill_cascade(spark):
    rows = [("Mr", 1, "male", 40.0), ("Mr", 1, "male", None), ("Mr", 3, "unknown", None), ("Mr", 3, "male", 26.0),
            ("Rare", 3, "male", None), ("Miss", 3, "female", 24.0), ("New", 4, "male", None), ("Mrs", 2, "female", 28.0)]
    df = spark.createDataFrame(rows, "t string, c int, s string, age double")
    tiers = [["t", "c", "s"], ["t", "c"], ["c"], []]
    params = tiered_quantile(df, tiers, "age")
    out = {(r["t"], r["c"], r["s"]): (r["filled"], r["tier"])
           for r in apply_tiered(df, params, tiers, "age", "filled", tier_out="tier").collect()}
    assert out[("Mr", 1, "male")] in {(40.0, -1), (40.0, 0)}
    assert out[("Mr", 3, "unknown")] == (26.0, 1)
    assert out[("Rare", 3, "male")] == (25.0, 2)      # class-3 median of 26 and 24
    assert out[("New", 4, "male")] == (27.0, 3)       # overall median of 40, 26, 24, 28


def test_overall_median_value(spark):
    df = spark.createDataFrame([(40.0,), (26.0,), (24.0,), (28.0,), (None,)], "v double")
    assert grouped_quantiles(df, [], "v", [0.5]).first()["q0"] == 27.0
