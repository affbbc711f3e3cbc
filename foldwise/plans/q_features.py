"""Queries: the clean feature row (F1-F22, A4-A7, J1, J2, J8) on ``pax``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import apply_features, fit_features
from .pax import PAX_ROLES, clean_rows_sql, fit_ctes, pax, pax_split
from .registry import query


def round_doubles(df: DataFrame, decimals: int = 6) -> DataFrame:
    return df.select(*[F.round(c, decimals).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


def clean_pax(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = pax(spark, sf_dir, materialized=True)
    train, _ = pax_split(spark, sf_dir, raw)
    params = fit_features(train, PAX_ROLES)
    return apply_features(raw, params, PAX_ROLES)


@query("f22_clean_feature_rows", oracle=clean_rows_sql())
def clean_feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fit on the training rows, apply to every row (train and held-out)."""
    return round_doubles(clean_pax(spark, sf_dir))


@query("a7_fare_band_edges", oracle=f"WITH {fit_ctes()} SELECT inner_edges AS edges FROM edges")
def fare_band_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartile edges of the imputed fare role, duplicates dropped, inner edges only."""
    train, _ = pax_split(spark, sf_dir)
    return fit_features(train, PAX_ROLES).fare_edges


@query("a4_port_mode", oracle=f"WITH {fit_ctes()} SELECT m AS mode FROM pm")
def port_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: mode of the port role on the training rows, ties to the smallest value."""
    from ..operators.fit import mode
    train, _ = pax_split(spark, sf_dir)
    return mode(train, PAX_ROLES.embarked)


@query("a6_frequent_prefixes",
       oracle=f"WITH {fit_ctes()} SELECT prefix, CAST(COUNT(*) AS BIGINT) AS count FROM tr "
              "GROUP BY prefix HAVING COUNT(*) >= 10")
def frequent_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket-role prefixes seen at least 10 times in training."""
    from ..functions.exprs import ticket_prefix
    from ..operators.fit import frequent_values
    train, _ = pax_split(spark, sf_dir)
    d = train.select(ticket_prefix(PAX_ROLES.ticket).alias("prefix"))
    return frequent_values(d, "prefix", PAX_ROLES.ticket_min_count)


@query("j2_fare_class_medians",
       oracle=f"""WITH {fit_ctes()}
SELECT 0 AS tier, pclass, round(m, 6) AS median FROM f1
UNION ALL SELECT 1, NULL, round(m, 6) FROM f0""")
def fare_class_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3/J2 parameters: class medians of the fare role and the overall fallback."""
    train, _ = pax_split(spark, sf_dir)
    p = fit_features(train, PAX_ROLES).fare
    return p.select(F.col("_tier").alias("tier"), "pclass", F.round("median", 6).alias("median"))
