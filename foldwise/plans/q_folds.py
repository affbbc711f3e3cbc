"""Queries: folds, hold-out, per-fold statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import split_stats as V
from ..operators.folds import assign_folds, fold_moments, fold_sizes, holdout_split
from ..session import materialize
from .q_features import round_doubles
from .registry import query
from .views import oracle_with, view

_FOLDS_OLAB = """SELECT id, label, CAST((row_number() OVER (ORDER BY label, md5(concat_ws('|', CAST(id AS VARCHAR), '42'))) - 1) % 5 + 1 AS INTEGER) AS fold FROM olab"""
_FOLDS_PAX = """folds AS (SELECT pid, CAST((row_number() OVER (ORDER BY survived, md5(concat_ws('|', CAST(pid AS VARCHAR), '42'))) - 1) % 5 + 1 AS INTEGER) AS fold FROM pax),
exp AS (SELECT p.*, s.split FROM pax p JOIN folds f ON p.pid = f.pid
        CROSS JOIN (SELECT CAST(10 * i AS INTEGER) AS split FROM range(1, 6) t(i)) s WHERE f.fold <> s.split / 10)"""


def olab_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "olab").select("id", "label")
    return assign_folds(o, "id", "label", 5, 42)


@query("w4_stratified_folds", oracle=oracle_with("olab", _FOLDS_OLAB))
def q_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded stratified 5-fold assignment of every row."""
    return olab_folds(spark, sf_dir)


@query("w4_fold_sizes", oracle=oracle_with("olab", f"SELECT fold, label, COUNT(*) AS rows FROM ({_FOLDS_OLAB}) t GROUP BY fold, label"))
def q_fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per fold and label (sizes differ by at most one per label)."""
    return fold_sizes(olab_folds(spark, sf_dir), "fold", "label")


@query("w5_holdout_split", oracle=oracle_with("olab", """
SELECT id, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', CAST(id AS VARCHAR), '42'))) - 1
                     < ceil(COUNT(*) OVER (PARTITION BY label) * 0.2) THEN 'valid' ELSE 'train' END AS role
FROM olab"""))
def q_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified 80/20 hold-out split."""
    o = view(spark, sf_dir, "olab").select("id", "label")
    return holdout_split(o, "id", "label", 0.2, 42).select("id", "role")


@query("v1_fold_medians", oracle=oracle_with("pax", "," + _FOLDS_PAX + """
SELECT split, 0 AS tier, pclass, sex, round(quantile_cont(age, 0.5), 6) AS median FROM exp WHERE age IS NOT NULL GROUP BY split, pclass, sex
UNION ALL SELECT split, 1, pclass, NULL, round(quantile_cont(age, 0.5), 6) FROM exp WHERE age IS NOT NULL GROUP BY split, pclass
UNION ALL SELECT split, 2, NULL, NULL, round(quantile_cont(age, 0.5), 6) FROM exp WHERE age IS NOT NULL GROUP BY split"""))
def q_fold_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: tiered medians of every outer training fold from split-count vectors, no row copied."""
    p = view(spark, sf_dir, "pax").select("pid", "survived", "pclass", "sex", "age")
    splits, keys = V.Splits(nested=False), ["pclass", "sex"]
    members = materialize(V.with_masks(p, "pid", "survived", splits))
    t = V.tiered_vectors(V.finest_counts(members, keys, "age", splits), [keys, ["pclass"], []], keys, splits).where(F.col(V.INDEX) > 0)
    split = F.get(F.array(*[F.lit(i) for i in splits.ids]), F.col(V.INDEX))
    return round_doubles(t.select(split.alias("split"), F.col("_tier").alias("tier"), "pclass", "sex", F.col("q").alias("median")))


@query("v1_nested_fold_medians", oracle=oracle_with("pax", """,
outer_f AS (SELECT *, (row_number() OVER (ORDER BY survived, md5(concat_ws('|', CAST(pid AS VARCHAR), '42'))) - 1) % 5 + 1 AS f FROM pax),
inner_f AS (SELECT o.pid, t.i AS outer_fold,
              (row_number() OVER (PARTITION BY t.i ORDER BY o.survived, md5(concat_ws('|', CAST(o.pid AS VARCHAR), CAST(42 + t.i AS VARCHAR)))) - 1) % 4 + 1 AS g
            FROM outer_f o JOIN range(1, 6) t(i) ON o.f <> t.i),
exp AS (SELECT o.pclass, o.age, 10 * i.outer_fold + h.g AS split FROM outer_f o JOIN inner_f i ON o.pid = i.pid JOIN range(1, 5) h(g) ON i.g <> h.g)
SELECT CAST(split AS INTEGER) AS split, 0 AS tier, pclass, round(quantile_cont(age, 0.5), 6) AS median FROM exp WHERE age IS NOT NULL GROUP BY split, pclass
UNION ALL SELECT CAST(split AS INTEGER), 1, NULL, round(quantile_cont(age, 0.5), 6) FROM exp WHERE age IS NOT NULL GROUP BY split"""))
def q_nested_fold_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1+V2: tiered medians of all 20 inner training sets of the nested search, from one row each."""
    p = view(spark, sf_dir, "pax").select("pid", "survived", "pclass", "age")
    splits = V.Splits()
    members = materialize(V.with_masks(p, "pid", "survived", splits))
    t = V.tiered_vectors(V.finest_counts(members, ["pclass"], "age", splits), [["pclass"], []], ["pclass"], splits)
    split = F.get(F.array(*[F.lit(i) for i in splits.ids]), F.col(V.INDEX))
    return round_doubles(t.select(split.alias("split"), F.col("_tier").alias("tier"), "pclass", F.col("q").alias("median")).where("split % 10 <> 0"))


@query("v1_fold_moments", oracle=oracle_with("pax", "," + _FOLDS_PAX + """
SELECT CAST(split / 10 AS INTEGER) AS fold, 'fare' AS feature, COUNT(fare) AS n, round(AVG(fare), 6) AS mean,
       round(STDDEV_POP(fare), 6) AS std FROM exp GROUP BY split
UNION ALL
SELECT CAST(split / 10 AS INTEGER), 'age', COUNT(age), round(AVG(age), 6), round(STDDEV_POP(age), 6) FROM exp GROUP BY split"""))
def q_fold_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 additive form: per-fold training mean/std as total minus fold, no expansion."""
    p = view(spark, sf_dir, "pax").select("pid", "survived", "age", "fare")
    f = assign_folds(p, "pid", "survived", 5, 42)
    return round_doubles(fold_moments(f, ["fare", "age"], "fold", 5))
