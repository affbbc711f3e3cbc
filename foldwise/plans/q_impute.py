"""Queries: tiered imputation (A1-A3, J1-J3) on the ``obs`` view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fit import tiered_quantile
from ..operators.lookup import apply_tiered
from ..session import materialize
from .registry import query
from .views import oracle_with, view

OBS_TIERS = [["k1", "k2", "k3"], ["k1", "k2"], ["k1"], []]

_MEDIANS_SQL = """
m3 AS (SELECT k1, k2, k3, quantile_cont(v, 0.5) AS m FROM obs WHERE v IS NOT NULL GROUP BY k1, k2, k3),
m2 AS (SELECT k1, k2, quantile_cont(v, 0.5) AS m FROM obs WHERE v IS NOT NULL GROUP BY k1, k2),
m1 AS (SELECT k1, quantile_cont(v, 0.5) AS m FROM obs WHERE v IS NOT NULL GROUP BY k1),
m0 AS (SELECT quantile_cont(v, 0.5) AS m FROM obs WHERE v IS NOT NULL),
filled AS (
  SELECT o.id,
         CASE WHEN o.v IS NOT NULL THEN -1 WHEN m3.m IS NOT NULL THEN 0
              WHEN m2.m IS NOT NULL THEN 1 WHEN m1.m IS NOT NULL THEN 2 ELSE 3 END AS tier,
         COALESCE(o.v, m3.m, m2.m, m1.m, m0.m) AS v_filled
  FROM obs o
  LEFT JOIN m3 ON o.k1 = m3.k1 AND o.k2 = m3.k2 AND o.k3 = m3.k3
  LEFT JOIN m2 ON o.k1 = m2.k1 AND o.k2 = m2.k2
  LEFT JOIN m1 ON o.k1 = m1.k1
  CROSS JOIN m0)
"""


def imputed_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the four median tiers on the observed rows of ``obs`` and fill every row."""
    obs = view(spark, sf_dir, "obs")
    params = materialize(tiered_quantile(obs, OBS_TIERS, "v"))
    return apply_tiered(obs, params, OBS_TIERS, "v", "v_filled", tier_out="tier")


@query("a1_j1_impute_tier_counts",
       oracle=oracle_with("obs", "," + _MEDIANS_SQL.strip() +
                          "\nSELECT tier, COUNT(*) AS n FROM filled GROUP BY tier"))
def impute_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum slice: rows answered by each tier (-1 = observed, 3 = overall)."""
    return imputed_obs(spark, sf_dir).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


@query("a1_j1_impute_rows",
       oracle=oracle_with("obs", "," + _MEDIANS_SQL.strip() +
                          "\nSELECT id, tier, round(v_filled, 6) AS v_filled FROM filled"))
def impute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level hierarchical fill of ``obs.v``."""
    res = imputed_obs(spark, sf_dir)
    return res.select("id", "tier", F.round("v_filled", 6).alias("v_filled"))


@query("a1_tier_medians",
       oracle=oracle_with("obs", """
SELECT 0 AS tier, k1, k2, CAST(k3 AS INTEGER) AS k3, round(quantile_cont(v, 0.5), 6) AS median FROM obs
 WHERE v IS NOT NULL GROUP BY k1, k2, k3
UNION ALL SELECT 1, k1, k2, NULL, round(quantile_cont(v, 0.5), 6) FROM obs WHERE v IS NOT NULL GROUP BY k1, k2
UNION ALL SELECT 2, k1, NULL, NULL, round(quantile_cont(v, 0.5), 6) FROM obs WHERE v IS NOT NULL GROUP BY k1
UNION ALL SELECT 3, NULL, NULL, NULL, round(quantile_cont(v, 0.5), 6) FROM obs WHERE v IS NOT NULL"""))
def tier_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1+A2: the fitted parameter table itself (all tiers in one job)."""
    obs = view(spark, sf_dir, "obs")
    p = tiered_quantile(obs, OBS_TIERS, "v")
    return p.select(F.col("_tier").alias("tier"), "k1", "k2", "k3", F.round("median", 6).alias("median"))
