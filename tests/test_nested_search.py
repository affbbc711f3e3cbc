"""Splits without row copies, and the many-model solver, against one split at a time."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from foldwise.operators import logistic
from foldwise.operators import split_stats as V
from foldwise.operators.encode import encode_wide, fit_encoder
from foldwise.operators.features import CATEGORICAL_COLUMNS, PASSTHROUGH_COLUMNS, SCALED_COLUMNS, apply_features, fit_features
from foldwise.operators.fit import tiered_quantile
from foldwise.operators.logistic import Fit
from foldwise.operators.split_stats import TRAIN, VALID, Splits
from foldwise.plans import search
from foldwise.plans.pax import PAX_ROLES, pax
from foldwise.plans.splits import KEY, prepare, score_features
from foldwise.session import materialize

CHECKED = [0, 20, 43]  # the full table, an outer and an inner training set


@pytest.fixture(scope="module")
def prepared(spark, sf_dir):
    raw = materialize(pax(spark, sf_dir))
    return raw, prepare(raw, PAX_ROLES)


def dealt(rows, k, seed):
    """{key: fold} as W4 has it."""
    order = sorted(rows, key=lambda r: (r[1], hashlib.md5(f"{r[0]}|{seed}".encode()).hexdigest()))
    return {key: i % k + 1 for i, (key, _) in enumerate(order)}


def test_masks_against_the_definition(spark):
    rows = [(i, i % 3 == 0) for i in range(97)]
    splits = Splits(outer_k=3, inner_k=2)
    df = spark.createDataFrame([(i, int(y)) for i, y in rows], "k long, y int").repartition(4)
    outer = dealt([(i, int(y)) for i, y in rows], 3, 42)
    inner = {f: dealt([(i, int(y)) for i, y in rows if outer[i] != f], 2, 42 + f) for f in (1, 2, 3)}
    got = {r["k"]: (r[TRAIN], r[VALID]) for r in V.with_masks(df, "k", "y", splits).collect()}
    assert len(got) == len(rows)
    for k, (train, valid) in got.items():
        for bit, split in enumerate(splits.ids):
            f, g = divmod(split, 10)
            t = split == 0 or outer[k] != f and (g == 0 or inner[f][k] != g)
            v = split > 0 and (outer[k] == f if g == 0 else outer[k] != f and inner[f][k] == g)
            assert (train >> bit & 1, valid >> bit & 1) == (int(t), int(v)), (k, split)


def test_vector_quantiles_equal_a_fit_per_split(spark):
    splits = Splits(outer_k=2, inner_k=2)
    df = spark.range(400).select("id", (F.col("id") % 2).cast("int").alias("y"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 4)).alias("g"),
                                 F.when(F.col("id") % 11 == 0, None).otherwise(F.xxhash64("id") % 50).cast("double").alias("v"))
    rows = materialize(V.with_masks(df, "id", "y", splits))
    found = V.tiered_vectors(V.finest_counts(rows, ["g"], "v", splits), [["g"], []], ["g"], splits).collect()
    for bit in range(len(splits)):
        own = rows.where(F.shiftright(TRAIN, bit).bitwiseAND(F.lit(1).cast("long")) == 1)
        want = {(r["_tier"], r["g"]): r["median"] for r in tiered_quantile(own, [["g"], []], "v").collect()}
        assert {(r["_tier"], r["g"]): r["q"] for r in found if r[V.INDEX] == bit} == want


def test_no_row_is_copied(prepared):
    raw, p = prepared
    assert p.rows.count() == raw.count()
    lengths = p.rows.agg(*[F.min(F.size(c)).alias(c) for c in ("AgeFilled", "TicketPrefix", "Title")]).first()
    assert set(lengths) == {1}
    assert p.rows.where(f"size(AgeFilled) NOT IN (1, {len(p.splits)})").isEmpty()


@pytest.mark.parametrize("split", CHECKED)
def test_design_and_scores_equal_a_fit_on_the_split_alone(spark, prepared, split):
    raw, p = prepared
    bit = p.splits.ids.index(split)
    masks = p.rows.select(F.col(KEY).alias("_k"), TRAIN, VALID)
    tagged = raw.join(masks, raw["pid"] == masks["_k"]).drop("_k")
    train = materialize(tagged.where(F.shiftright(TRAIN, bit).bitwiseAND(F.lit(1).cast("long")) == 1).select(*raw.columns))
    fp = fit_features(train, PAX_ROLES)
    clean = materialize(apply_features(train, fp, PAX_ROLES, keep=["survived"]))
    enc = fit_encoder(clean, SCALED_COLUMNS, PASSTHROUGH_COLUMNS, CATEGORICAL_COLUMNS)
    # the ranking of the split's features
    want = {r["feature"]: (r["mi"], r["rank"]) for r in score_features(clean, PAX_ROLES, p.names).collect()}
    got = {r["feature"]: (r["mi"], r["rank"]) for r in p.ranking.where(f"split = {split}").collect()}
    assert got.keys() == want.keys()
    for f in want:
        assert abs(got[f][0] - want[f][0]) < 1e-9, f
    assert sorted(x[1] for x in got.values()) == list(range(1, len(got) + 1))
    # the encoded columns of all rows
    own = [n for n in p.names if n in want]
    wide = encode_wide(apply_features(raw, fp, PAX_ROLES), enc, keep=[KEY])
    expected = {r[KEY]: [r[n] for n in own] for r in wide.collect()}
    batch = p.rows.toArrow().combine_chunks().to_batches()[0]
    at = [p.names.index(n) for n in own]
    for s, x, y, train_bits, valid_bits in p.design(batch, [bit]):
        assert s == bit and train_bits.sum() == train.count()
        for key, row in zip(batch.column(KEY).to_pylist(), x[:, at]):
            assert np.allclose(row, expected[key], atol=1e-9), key


def objective(w, x, y):
    eta = x @ w[:-1] + w[-1]
    return np.logaddexp(0, eta).sum() - y @ eta + 0.5 * w[:-1] @ w[:-1]


def test_solver_equals_mllib(spark, prepared):
    """To 1e-6 on columns of moderate size; on all columns, some of which are so large that
    MLlib's line search gives up early, the optimum is no worse and its gradient is zero."""
    raw, p = prepared
    batch = p.rows.toArrow().combine_chunks().to_batches()[0]
    (_, whole, *_), = p.design(batch, [0])
    mild = [i for i in range(len(p.names)) if 0 < whole[:, i].std() and np.abs(whole[:, i]).max() < 15]
    fits = [Fit(p.splits.ids.index(s), tuple(c)) for s in CHECKED for c in (mild[:4], mild, range(len(p.names)))]
    weights = logistic.fit_many(p.rows, p.design, fits)
    scores = logistic.accuracies(p.rows, p.design, fits, weights)
    for f, w, score in zip(fits, weights, scores):
        (_, x, y, train, valid), = p.design(batch, [f.split])
        x = x[:, list(f.columns)]
        cols = [f"x{i}" for i in range(len(f.columns))]
        df = spark.createDataFrame([(float(a), *map(float, b)) for a, b in zip(y[train], x[train])], ["label", *cols])
        data = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
        model = LogisticRegression(standardization=False, elasticNetParam=0.0, maxIter=5000, tol=1e-15, regParam=1 / train.sum()).fit(data)
        theirs = np.append(model.coefficients.toArray(), model.intercept)
        if len(f.columns) <= len(mild):
            assert np.allclose(w, theirs, atol=1e-6)
        assert objective(w, x[train], y[train]) <= objective(theirs, x[train], y[train]) + 1e-8
        eta = x @ w[:-1] + w[-1]
        left = x[train].T @ (1 / (1 + np.exp(-eta[train])) - y[train]) + w[:-1]
        assert (np.abs(left) / (1 + np.abs(x[train]).sum(axis=0))).max() < 1e-9
        hit = (eta > 0) == (y > 0)
        assert (score["train_rows"], score["train_hits"], score["valid_rows"], score["valid_hits"]) == (train.sum(), (hit & train).sum(), valid.sum(), (hit & valid).sum())


def test_solver_on_odd_training_sets(spark):
    class Plain:
        def __call__(self, batch, splits):
            x = np.array([batch.column("x").to_pylist()]).T
            y = batch.column("y").to_numpy().astype(float)
            for s in splits:
                yield s, x, y, np.ones(len(y), bool) if s == 0 else np.zeros(len(y), bool), np.zeros(len(y), bool)

    df = spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)], "x double, y int")  # separable
    w, none = logistic.fit_many(df, Plain(), [Fit(0, (0,)), Fit(1, (0,))])
    assert ((np.arange(10) * w[0] + w[1] > 0) == (np.arange(10) > 4)).all() and not none.any()
    one_class = logistic.fit_many(df.withColumn("y", F.lit(1)), Plain(), [Fit(0, (0,))], max_iter=25)[0]
    assert np.isfinite(one_class).all()
    with pytest.raises(ValueError):
        logistic.fit_many(df, Plain(), [Fit(0, tuple(range(logistic.MAX_COLUMNS + 1)))])


def test_nested_search_covers_every_row_once(spark, prepared):
    raw, p = prepared
    res = search.run_search(p, k_grid=[8, "all"])
    rows = raw.count()
    cov = res.oof.groupBy("PassengerId").count()
    assert cov.count() == rows and cov.where(F.col("count") != 1).count() == 0
    nested = res.nested.collect()
    assert len(nested) == 5 and sum(r["validation_rows"] for r in nested) == rows
    sel = res.selection.collect()
    assert sum(1 for r in sel if r["selected"]) == 1
    assert {r["effective_k"] for r in sel} == {8, len(p.names)}
    assert len(res.final_weights) == len(res.final_features) + 1
