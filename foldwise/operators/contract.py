"""Data contracts (D1-D5) and the set operations they use.

Checks return a DataFrame ``(check, violations, passed)`` instead of raising;
:func:`raise_on_failure` turns a failing table into an exception for callers
that want the reference's fail-fast behaviour.  Schema checks are metadata
only; data checks are one aggregation or semi/anti join each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .profile import null_counts

CHECK_SCHEMA = "check string, violations long"


def _checks(spark: SparkSession, rows: list[tuple[str, int]]) -> DataFrame:
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def _finish(df: DataFrame) -> DataFrame:
    return df.select("check", F.col("violations").cast("long").alias("violations"),
                     (F.col("violations") == 0).alias("passed"))


def schema_table(df: DataFrame) -> DataFrame:
    """Schema as a table ``(position, name, type)`` (metadata, no scan)."""
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, name string, type string")


def column_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns present on one side only: ``(name, side)``."""
    a, b = schema_table(left).select("name"), schema_table(right).select("name")
    return (a.join(b, "name", "left_anti").withColumn("side", F.lit("left_only"))
            .unionByName(b.join(a, "name", "left_anti").withColumn("side", F.lit("right_only"))))


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both tables (a semi join)."""
    return left.select(key).join(right.select(key), key, "left_semi").distinct()


def not_subset(values: DataFrame, column: str, allowed: DataFrame, allowed_col: str) -> DataFrame:
    """Values of ``column`` missing from ``allowed`` (empty = subset)."""
    return values.select(column).distinct().join(
        allowed.select(F.col(allowed_col).alias(column)), column, "left_anti")


def validate_raw(train: DataFrame, test: DataFrame, train_columns: Sequence[str], key: str,
                 label: str, allowed_labels: Sequence = (0, 1),
                 expected_rows: tuple[int, int] | None = None) -> DataFrame:
    """The raw contract of a train/test pair.

    Checks: column names and order of both files, optional row counts, unique
    keys in each file, no key shared by the files, label domain.
    """
    spark = train.sparkSession
    test_columns = [c for c in train_columns if c != label]
    order_train = 0 if list(train.columns) == list(train_columns) else 1
    order_test = 0 if list(test.columns) == list(test_columns) else 1
    meta = [("train_columns", order_train), ("test_columns", order_test)]
    bad = (~F.coalesce(F.col(label).isin(*allowed_labels), F.lit(False))).cast("long")
    # both files side by side, read once each; one aggregation per key answers every check
    none = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    sides = train.select(F.col(key).alias("_k"), one.alias("_a"), none.alias("_b"), bad.alias("_bad")).union(
        test.select(F.col(key), none, one, none))
    per_key = sides.groupBy("_k").agg(*[F.sum(c).alias(c) for c in ("_a", "_b", "_bad")])
    shared = F.col("_k").isNotNull() & (F.col("_a") > 0) & (F.col("_b") > 0)
    counted = per_key.agg(F.count_if(F.col("_a") > 1).alias("train_unique_key"), F.count_if(F.col("_b") > 1).alias("test_unique_key"),
                          F.count_if(shared).alias("disjoint_keys"), F.coalesce(F.sum("_bad"), none).alias("label_domain"),
                          F.coalesce(F.sum("_a"), none).alias("_n"), F.coalesce(F.sum("_b"), none).alias("_m"))
    names = ["train_unique_key", "test_unique_key", "disjoint_keys", "label_domain"]
    if expected_rows is not None:
        n, m = expected_rows
        counted = counted.withColumn("row_counts", (F.col("_n") != n).cast("long") + (F.col("_m") != m).cast("long"))
        names = ["row_counts", *names]
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("violations")) for c in names]))
    return _finish(_checks(spark, meta).unionByName(counted.select(stacked.alias("_s")).select("_s.*")))


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required columns that are absent: ``(name)``."""
    present = set(df.columns)
    return df.sparkSession.createDataFrame([(c,) for c in required if c not in present], "name string")


def no_nulls(df: DataFrame) -> DataFrame:
    """D3: columns that still hold missing values, with their counts."""
    return null_counts(df).where(F.col("missing") > 0)


def aligned(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> bool:
    """Same feature names in the same order (metadata only)."""
    a = [c for c in left.columns if c not in ignore]
    b = [c for c in right.columns if c not in ignore]
    return a == b


def non_numeric(df: DataFrame) -> list[str]:
    """Names of columns that are not numeric (empty = all numeric)."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]


def raise_on_failure(checks: DataFrame) -> None:
    failed = checks.where(~F.col("passed")).collect()
    if failed:
        raise ValueError("contract failed: " + ", ".join(f"{r['check']}={r['violations']}" for r in failed))
