"""Nested cross-validation, final search and scoring.

Every candidate is a (split, k) pair: a logistic regression on the split's training
rows with its top-k features.  All of them are fitted together by the many-model
solver over the packed rows: first, for every k, the model of all rows (one of which is the final
one), then the candidates with these as their guides; scored in one more pass.  One
number per candidate returns to the driver and becomes a small table that is ranked with
window functions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import logistic
from ..operators import metrics as M
from ..operators.logistic import Fit
from ..session import materialize
from .splits import KEY, SPLIT, Prepared, packed

# The numbers of features tried by the search.
K_GRID = [8, 12, 16, 20, 24, 28, 32, 36, 40, "all"]


@dataclass
class SearchResult:
    candidates: DataFrame      # (split, grid_pos, k, train_accuracy, valid_accuracy)
    nested: DataFrame          # V2 outer-fold table
    selection: DataFrame       # V4 selection table
    oof: DataFrame             # V3 (key, fold, prediction)
    best_k: str
    final_features: list
    final_weights: np.ndarray  # of final_features, the intercept last


def _selected(ranked: list[tuple], k) -> list[tuple]:
    """The top-k of (rank, position, feature), in column order."""
    return sorted((f for f in ranked if k == "all" or f[0] <= k), key=lambda f: f[1])


def run_search(p: Prepared, k_grid=K_GRID, c: float = 1.0) -> SearchResult:
    spark = p.rows.sparkSession
    ids, outer_k = p.splits.ids, p.splits.outer_k
    ranking: dict[int, list] = {i: [] for i in ids}
    for row in p.ranking.select(SPLIT, "rank", "position", "feature").collect():  # splits x encoded features
        ranking[row[SPLIT]].append((row["rank"], row["position"], row["feature"]))

    def fit_of(split: int, k) -> Fit:
        return Fit(ids.index(split), tuple(f[1] for f in _selected(ranking[split], k)))

    cells = [(s, gi, k) for s in ids if s != 0 for gi, k in enumerate(k_grid)]
    fits = [fit_of(s, k) for s, _, k in cells]
    blocks, unpacked = packed(p)
    weights, whole = logistic.fit_guided(blocks, unpacked, fits, [fit_of(0, k) for k in k_grid], [gi for _, gi, _ in cells], c)
    scores = logistic.accuracies(blocks, unpacked, fits, weights)
    share = lambda hits, rows: hits / rows if rows else None
    results = [(s, gi, str(k), share(x["train_hits"], x["train_rows"]), share(x["valid_hits"], x["valid_rows"])) for (s, gi, k), x in zip(cells, scores)]
    cand = spark.createDataFrame(results, "split int, grid_pos int, k string, train_accuracy double, valid_accuracy double")
    sizes = {s: (x["train_rows"], x["valid_rows"]) for (s, _, _), x in zip(cells, scores)}

    inner = cand.where(F.col(SPLIT) % 10 != 0).withColumn("outer_fold", (F.col(SPLIT) / 10).cast("int"))
    inner_mean = inner.groupBy("outer_fold", "grid_pos", "k").agg(
        F.round(F.avg("valid_accuracy"), 12).alias("inner_accuracy"))
    best_inner = materialize(M.pick_best(inner_mean, "inner_accuracy", "grid_pos", by=["outer_fold"]))
    outer = cand.where((F.col(SPLIT) % 10 == 0) & (F.col(SPLIT) > 0)) \
        .withColumn("outer_fold", (F.col(SPLIT) / 10).cast("int"))
    sized = spark.createDataFrame([(f, *sizes[10 * f]) for f in range(1, outer_k + 1)],
                                  "outer_fold int, train_rows long, validation_rows long")
    nested = (best_inner.join(outer.select("outer_fold", "grid_pos", F.col("valid_accuracy").alias("outer_accuracy")),
                              ["outer_fold", "grid_pos"])
              .join(sized, "outer_fold")
              .select("outer_fold", "train_rows", "validation_rows", F.col("k").alias("best_k"),
                      F.col("inner_accuracy").alias("inner_best_accuracy"), "outer_accuracy"))

    # V3: out-of-fold predictions of each outer fold's chosen model, from one pass
    best = {row["outer_fold"]: row["grid_pos"] for row in best_inner.collect()}
    chosen = [cells.index((10 * f, gi, k_grid[gi])) for f, gi in sorted(best.items())]
    found = logistic.predictions(p.rows, p.design, [fits[i] for i in chosen], [weights[i] for i in chosen], KEY)
    fold_of = F.array(*[F.lit(i // 10) for i in ids])
    oof = found.select(KEY, F.get(fold_of, F.col(SPLIT)).alias("fold"), "prediction")

    # V4: the final search over the outer folds (same folds, same seed)
    summary = outer.groupBy("grid_pos", "k").agg(
        F.round(F.avg("valid_accuracy"), 12).alias("cv_accuracy_mean"),
        F.stddev_pop("valid_accuracy").alias("cv_accuracy_std"),
        F.avg("train_accuracy").alias("train_accuracy_mean"))
    # P11: "all" is shown as the total number of encoded features (chart data)
    summary = summary.withColumn("effective_k", F.when(F.col("k") == "all", F.lit(len(p.names)))
                                 .otherwise(F.col("k").try_cast("int")))
    selection = M.rank_candidates(summary, "cv_accuracy_mean", "grid_pos").orderBy("rank", "k")
    best_k = selection.where("selected").first()["k"]
    k = "all" if best_k == "all" else int(best_k)
    return SearchResult(cand, nested, selection.drop("grid_pos"), oof, best_k, [f[2] for f in _selected(ranking[0], k)], whole[k_grid.index(k)])
