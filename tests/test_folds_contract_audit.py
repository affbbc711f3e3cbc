"""Folds (W4), contract (D1), fingerprints (D9) and encoder edge rows."""

import hashlib

from pyspark.sql import functions as F

from foldwise.operators import audit as A
from foldwise.operators import contract as C
from foldwise.operators.encode import encode_long, fit_encoder
from foldwise.operators.folds import assign_folds


def test_folds_balanced_and_stable(spark):
    df = spark.range(0, 1003).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    a = assign_folds(df, "id", "y", 5, 42)
    sizes = sorted(r["count"] for r in a.groupBy("fold").count().collect())
    assert sizes[-1] - sizes[0] <= 1 and sum(sizes) == 1003
    assert a.select("id").distinct().count() == 1003
    b = assign_folds(df, "id", "y", 5, 42)
    assert a.join(b, ["id", "y", "fold"]).count() == 1003
    per_label = a.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        c = sorted(r["count"] for r in per_label if r["y"] == y)
        assert c[-1] - c[0] <= 1


def test_contract_flags_each_violation(spark):
    train = spark.createDataFrame([(1, 0), (1, 1), (2, 2)], "id long, label int")
    test = spark.createDataFrame([(2,), (3,)], "id long")
    res = {r["check"]: r["passed"] for r in C.validate_raw(train, test, ["label", "id"], "id", "label").collect()}
    assert res == {"train_columns": False, "test_columns": True, "train_unique_key": False,
                   "test_unique_key": True, "disjoint_keys": False, "label_domain": False}


def test_fingerprint_order_insensitive(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None), (3, "c", 1.0)], "k int, s string, v double")
    f1 = A.fingerprint(df).first()
    f2 = A.fingerprint(df.orderBy(F.desc("k")).repartition(3)).first()
    f3 = A.fingerprint(df.withColumn("s", F.when(F.col("k") == 2, "x").otherwise(F.col("s")))).first()
    assert f1 == f2 and f1["fingerprint"] != f3["fingerprint"]


def test_encoder_unseen_null_constant(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "c string, x double")
    test = spark.createDataFrame([(1, "z", 1.0), (2, None, 1.0), (3, "a", 1.0)], "id int, c string, x double")
    enc = fit_encoder(train, ["x"], [], ["c"])
    rows = encode_long(test, enc, ["id"]).collect()
    hot = {(r["id"], r["feature"]) for r in rows if r["feature"].startswith("c_")}
    assert hot == {(3, "c_a")}
    assert all(r["value"] == 0.0 for r in rows if r["feature"] == "x")


def test_folds_and_auc_equal_plain_windows(spark):
    from foldwise.operators import metrics as M

    df = spark.range(0, 2000).select(F.col("id"), (F.col("id") % 7 == 0).cast("int").alias("y"),
                                     ((F.col("id") * 37) % 101 / 100.0).alias("s"))
    rows = df.collect()
    order = sorted(rows, key=lambda r: (r["y"], hashlib.md5(f"{r['id']}|42".encode()).hexdigest()))
    plain_f = {r["id"]: i % 5 + 1 for i, r in enumerate(order)}
    assert {r["id"]: r["fold"] for r in assign_folds(df, "id", "y", 5, 42).collect()} == plain_f
    pos, neg = [[r["s"] for r in rows if r["y"] == y] for y in (1, 0)]
    plain_auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(M.roc_auc(df, "y", "s").first()["auc"] - plain_auc) < 1e-12


def test_approximate_folds_cover_all_folds(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 2).cast("int").alias("y"))
    a = assign_folds(df, "id", "y", 5, 42, approximate=True)
    sizes = {r["fold"]: r["count"] for r in a.groupBy("fold").count().collect()}
    assert set(sizes) == {1, 2, 3, 4, 5} and min(sizes.values()) > 800


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert [r["name"] for r in C.required_columns(df, ["a", "c", "b", "d"]).collect()] == ["c", "d"]
    assert C.required_columns(df, ["a", "b"]).count() == 0
