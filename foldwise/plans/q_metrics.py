"""Queries: metrics on a deterministic score column and candidate ranking
(M1-M4, W1-W3, confusion matrix, ROC points)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators.folds import assign_folds
from .q_features import round_doubles
from .registry import query
from .views import oracle_with, view

THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """olab rows with ``score`` = price / 500,000 and ``prediction`` = score > 0.5."""
    o = view(spark, sf_dir, "olab")
    s = F.col("o_totalprice") / 500000
    return o.select("id", "label", "o_orderpriority", "o_orderstatus", s.alias("score"),
                    (s > 0.5).cast("int").alias("prediction"))


_SCORED = """s AS (SELECT id, label, o_orderpriority, o_orderstatus, o_totalprice / 500000 AS score,
                  CAST(o_totalprice / 500000 > 0.5 AS INTEGER) AS prediction FROM olab)"""


@query("m1_m2_classification_metrics", oracle=oracle_with("olab", f""", {_SCORED},
c AS (SELECT o_orderstatus, COUNT(*) AS rows, COUNT(*) FILTER (WHERE label = prediction) AS hit,
             COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
             COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM s GROUP BY o_orderstatus)
SELECT o_orderstatus, rows, round(hit / rows, 6) AS accuracy,
       round(COALESCE(tp / NULLIF(tp + fp, 0), 0), 6) AS precision,
       round(COALESCE(tp / NULLIF(tp + fn, 0), 0), 6) AS recall,
       round(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c"""))
def q_classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1+M2: accuracy, precision, recall, F1 per status (zero division -> 0)."""
    return round_doubles(M.classification_metrics(scored(spark, sf_dir), "label", "prediction", ["o_orderstatus"]))


@query("m3_roc_auc", oracle=oracle_with("olab", f""", {_SCORED},
t AS (SELECT o_orderpriority, score, COUNT(*) FILTER (WHERE label = 1) AS pos,
             COUNT(*) FILTER (WHERE label = 0) AS neg FROM s GROUP BY o_orderpriority, score),
c AS (SELECT *, SUM(neg) OVER (PARTITION BY o_orderpriority ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS below FROM t)
SELECT o_orderpriority, round(SUM(pos * (below + neg / 2.0)) / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)), 6) AS auc
FROM c GROUP BY o_orderpriority"""))
def q_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: exact ROC-AUC with ties, per priority."""
    return round_doubles(M.roc_auc(scored(spark, sf_dir), "label", "score", ["o_orderpriority"]))


@query("m3_roc_points", oracle=oracle_with("olab", f""", {_SCORED},
t AS (SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label = 0) AS neg FROM s GROUP BY score),
c AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             SUM(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM t)
SELECT score AS threshold, round(CAST(fp AS DOUBLE) / (SELECT CAST(SUM(neg) AS DOUBLE) FROM t), 6) AS fpr,
       round(CAST(tp AS DOUBLE) / (SELECT CAST(SUM(pos) AS DOUBLE) FROM t), 6) AS tpr FROM c"""))
def q_roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC curve points (one per distinct score)."""
    r = M.roc_points(scored(spark, sf_dir), "label", "score")
    return r.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query("m_confusion_matrix", oracle=oracle_with("olab", f""", {_SCORED}
SELECT label, prediction, COUNT(*) AS count FROM s GROUP BY label, prediction"""))
def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion matrix of the thresholded score."""
    return M.confusion_matrix(scored(spark, sf_dir), "label", "prediction")


def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (threshold candidate, fold): accuracy on the fold's training rows and
    on its validation rows.  One aggregation for all candidates and folds."""
    s = scored(spark, sf_dir)
    f = assign_folds(s, "id", "label", 5, 42)
    cands = spark.createDataFrame([(i, t) for i, t in enumerate(THRESHOLDS)], "grid_pos int, threshold double")
    folds = spark.range(1, 6).select(F.col("id").cast("int").alias("cv_fold"))
    rows = f.crossJoin(F.broadcast(cands)).crossJoin(F.broadcast(folds))   # grid x folds: fixed, tiny
    hit = (F.col("label") == (F.col("score") > F.col("threshold")).cast("int")).cast("double")
    return rows.groupBy("grid_pos", "threshold", "cv_fold").agg(
        F.avg(F.when(F.col("fold") != F.col("cv_fold"), hit)).alias("train_accuracy"),
        F.avg(F.when(F.col("fold") == F.col("cv_fold"), hit)).alias("valid_accuracy"))


_CAND = """, folds AS (SELECT id, label, score, CAST((row_number() OVER (ORDER BY label, md5(concat_ws('|', CAST(id AS VARCHAR), '42'))) - 1) % 5 + 1 AS INTEGER) AS fold FROM s),
cands AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, CAST({t} AS DOUBLE))" for i, t in enumerate(THRESHOLDS)) + """) v(grid_pos, threshold)),
cs AS (SELECT grid_pos, threshold, cv_fold,
              AVG(CASE WHEN fold <> cv_fold THEN CAST(label = CAST(score > threshold AS INTEGER) AS INTEGER) END) AS train_accuracy,
              AVG(CASE WHEN fold = cv_fold THEN CAST(label = CAST(score > threshold AS INTEGER) AS INTEGER) END) AS valid_accuracy
       FROM folds CROSS JOIN cands CROSS JOIN (SELECT CAST(i AS INTEGER) AS cv_fold FROM range(1, 6) t(i)) f
       GROUP BY grid_pos, threshold, cv_fold)"""


@query("m4_generalisation_gap", oracle=oracle_with("olab", f", {_SCORED}{_CAND}" + """
SELECT threshold, round(AVG(train_accuracy), 6) AS train_mean, round(AVG(valid_accuracy), 6) AS valid_mean,
       round(AVG(train_accuracy) - AVG(valid_accuracy), 6) AS gap FROM cs GROUP BY threshold"""))
def q_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: mean train vs validation accuracy per candidate, and the gap."""
    return round_doubles(M.generalisation_gap(candidate_scores(spark, sf_dir), "threshold",
                                              "train_accuracy", "valid_accuracy"))


@query("w1_w2_candidate_ranking", oracle=oracle_with("olab", f", {_SCORED}{_CAND}" + """,
m AS (SELECT grid_pos, threshold, AVG(valid_accuracy) AS cv_mean, STDDEV_POP(valid_accuracy) AS cv_std FROM cs GROUP BY ALL)
SELECT threshold, round(cv_mean, 6) AS cv_mean, round(cv_std, 6) AS cv_std,
       CAST(rank() OVER (ORDER BY round(cv_mean, 12) DESC) AS INTEGER) AS rank,
       row_number() OVER (ORDER BY round(cv_mean, 12) DESC, grid_pos) = 1 AS selected FROM m"""))
def q_candidate_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1+W2+A23: candidates ranked by mean validation accuracy (ties share a
    rank, exactly one selected: the earliest grid position)."""
    cs = candidate_scores(spark, sf_dir)
    m = cs.groupBy("grid_pos", "threshold").agg(F.round(F.avg("valid_accuracy"), 12).alias("cv_mean"),
                                               F.stddev_pop("valid_accuracy").alias("cv_std"))
    r = M.rank_candidates(m, "cv_mean", "grid_pos")
    return round_doubles(r.select("threshold", "cv_mean", "cv_std", "rank", "selected"))
