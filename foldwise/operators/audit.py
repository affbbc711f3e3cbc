"""Audit and reproducibility.

The reference hashes output files byte by byte.  Files written by a cluster
come in many parts whose order and split points vary, so the check is
re-aimed at an order-insensitive *table fingerprint*: row count plus the sum
of the first 60 bits of each row's MD5, taken in DECIMAL so the sum cannot
overflow.  Every cell goes into the digest behind its length, so cells that
contain the separator or the NULL mark are told apart.  Equal tables give equal fingerprints whatever the partitioning;
one changed cell changes it (with overwhelming probability).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .profile import null_counts

NULL_TOKEN = "␀"  # without a length, unlike a cell with that text
DIGEST_DIGITS = 15


def row_digest(df: DataFrame, columns: Sequence[str] | None = None):
    cols = list(columns or df.columns)
    text = [F.col(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_TOKEN)) for t in text]
    return F.md5(F.concat_ws("|", *parts))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(rows, fingerprint)`` of a table, independent of row order."""
    h = F.conv(F.substring(row_digest(df, columns), 1, DIGEST_DIGITS), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("decimal(38,0)").cast("string").alias("fingerprint"))


def compare_fingerprints(left: DataFrame, right: DataFrame, name: str = "artifact") -> DataFrame:
    """Full outer join of two ``(artifact, rows, fingerprint)`` tables;
    ``identical`` is true only when both sides exist and agree."""
    a = left.select(name, F.col("rows").alias("left_rows"), F.col("fingerprint").alias("left_fingerprint"))
    b = right.select(name, F.col("rows").alias("right_rows"), F.col("fingerprint").alias("right_fingerprint"))
    j = a.join(b, name, "full_outer")
    same = (F.col("left_fingerprint").eqNullSafe(F.col("right_fingerprint")) & F.col("left_fingerprint").isNotNull()
            & F.col("left_rows").eqNullSafe(F.col("right_rows")))
    return j.withColumn("identical", same)


def fingerprints(tables: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    """``(artifact, rows, fingerprint)`` for several named tables."""
    out = None
    for name, df in tables.items():
        f = fingerprint(df).select(F.lit(name).alias("artifact"), "rows", "fingerprint")
        out = f if out is None else out.unionByName(f)
    return out if out is not None else spark.createDataFrame([], "artifact string, rows long, fingerprint string")


def missing_before_after(frames: dict[str, DataFrame]) -> DataFrame:
    """D6+J4: per-field missing counts of several frames side by side, full
    outer aligned on the field name, absent -> 0."""
    out = None
    for name, df in frames.items():
        n = null_counts(df, out=name)
        out = n if out is None else out.join(n, "field", "full_outer")
    return out.select("field", *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in frames])


def field_dictionary(spark: SparkSession, entries: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """``(field, type, source, definition, modeling_guidance)``."""
    return spark.createDataFrame(list(entries), "field string, type string, source string, "
                                                "definition string, modeling_guidance string")
