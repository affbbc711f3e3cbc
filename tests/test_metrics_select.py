"""Metrics, ranking and selection edge rows."""

from foldwise.operators import metrics as M
from foldwise.operators.select import rank_features, select_k


def test_metrics_example(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "y int, p double") \
        .selectExpr("y", "p", "CAST(p > 0.5 AS INT) AS pred")
    m = M.classification_metrics(df, "y", "pred").first()
    assert m["accuracy"] == 0.75 and abs(m["precision"] - 2 / 3) < 1e-12 and m["recall"] == 1.0
    assert abs(m["f1"] - 0.8) < 1e-12
    assert M.roc_auc(df, "y", "p").first()["auc"] == 0.875


def test_no_positive_prediction(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, pred int")
    m = M.classification_metrics(df, "y", "pred").first()
    assert m["precision"] == 0.0 and m["f1"] == 0.0


def test_rank_and_select_first_best(spark):
    t = spark.createDataFrame([(0, 0.8), (1, 0.9), (2, 0.9), (3, 0.7)], "pos int, score double")
    r = {x["pos"]: (x["rank"], x["selected"]) for x in M.rank_candidates(t, "score", "pos").collect()}
    assert r == {0: (3, False), 1: (1, True), 2: (1, False), 3: (4, False)}


def test_top_k_later_column_wins(spark):
    scores = spark.createDataFrame([("a", 0.3), ("b", 0.5), ("c", 0.5), ("d", 0.1)], "feature string, mi double")
    pos = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d")], "position int, feature string")
    ranked = rank_features(scores, pos)
    assert [x["feature"] for x in select_k(ranked, 1).collect()] == ["c"]
    assert sorted(x["feature"] for x in select_k(ranked, 2).collect()) == ["b", "c"]
