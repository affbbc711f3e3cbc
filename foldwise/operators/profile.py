"""Profiling and data-audit aggregations.

Each function is one or two aggregation passes; per-column statistics are
computed for all columns in the same pass and then unpivoted to a long table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.exprs import nan_as_null
from ..session import materialize, sized_broadcast
from .quantiles import bracketed_quantiles, grouped_quantiles


def _missing(df: DataFrame, c: str) -> Column:
    cond = F.col(c).isNull()
    if dict(df.dtypes)[c] in ("double", "float"):
        cond = cond | F.isnan(F.col(c))
    return cond


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of a numeric type, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def null_counts(df: DataFrame, columns: Sequence[str] | None = None, out: str = "missing") -> DataFrame:
    """``(field, missing)`` for every column, one pass (``count_if`` per column)."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in columns])
    return wide.unpivot([], columns, "field", out) if columns else wide


def null_share(df: DataFrame, columns: Sequence[str] | None = None, decimals: int = 2) -> DataFrame:
    """``(field, missing, missing_pct)`` for columns with missing values, largest first."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(_missing(df, c)).alias(c) for c in columns])
    long = wide.unpivot(["_rows"], columns, "field", "missing")
    return (long.where(F.col("missing") > 0)
            .select("field", "missing", F.round(F.col("missing") * 100.0 / F.col("_rows"), decimals).alias("missing_pct"))
            .orderBy(F.desc("missing_pct"), "field"))


def total_nulls(df: DataFrame) -> DataFrame:
    """A10: number of missing cells in the whole table."""
    total = None
    for c in df.columns:
        e = F.count_if(_missing(df, c))
        total = e if total is None else total + e
    return df.agg(total.cast("long").alias("missing_cells"))


def label_rate(df: DataFrame, group: str | Column, label: str, out: str = "rate_pct") -> DataFrame:
    """Mean of the 0/1 label per group, in percent."""
    return df.groupBy(group).agg((F.avg(label) * 100).alias(out))


def label_rate_pivot(df: DataFrame, row: str, col: str, label: str,
                     values: Sequence | None = None) -> DataFrame:
    """Label rate (%) by two keys, ``col`` pivoted into columns.

    Pass ``values`` when they are known; otherwise Spark collects the distinct
    values of ``col`` first (bounded by its cardinality, max 10,000).
    """
    g = df.groupBy(row)
    p = g.pivot(col, list(values)) if values is not None else g.pivot(col)
    return p.agg(F.avg(label) * 100)


def count_and_rate(df: DataFrame, key: Column, key_name: str, label: str, decimals: int = 2) -> DataFrame:
    """Row count and rounded label rate per derived key, one aggregation."""
    return df.groupBy(key.alias(key_name)).agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg(label) * 100, decimals).alias("rate_pct"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact ``describe``: count, mean, sample std, min, quartiles, max per column.

    Long form ``(feature, count, mean, std, min, q25, q50, q75, max)``.  The
    quartiles are exact (``summary()`` would give approximate ones).
    """
    columns = list(columns)
    long = nan_as_null(df, columns).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]))
        .alias("_s")).select("_s.*")
    basic = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    qs = grouped_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75])
    qs = qs.select("feature", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"))
    return basic.join(qs, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def info(df: DataFrame) -> DataFrame:
    """``(position, column, non_null, dtype)``; counts in one pass."""
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column", "non_null")
    meta = df.sparkSession.createDataFrame(
        [(i, c, t) for i, (c, t) in enumerate(df.dtypes)], "position int, column string, dtype string")
    return meta.join(F.broadcast(long), "column").select("position", "column", "non_null", "dtype")


def shape(df: DataFrame) -> DataFrame:
    """``(rows, columns)``."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def correlations(df: DataFrame, columns: Sequence[str], lower_only: bool = True) -> DataFrame:
    """Pearson correlation of every pair in one aggregation, long form
    ``(col_a, col_b, corr)``; rows with a NULL in either column are skipped
    pairwise (pandas' behaviour)."""
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for j, b in enumerate(columns)
             if (i > j if lower_only else True)]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"`{a}|{b}`").alias("corr"))
        for a, b in pairs]))
    return wide.select(stacked.alias("_s")).select("_s.*")


def histogram(df: DataFrame, value: str, bins: int, where: Column | None = None) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed.

    ``(bin, lower, upper, count)``; empty bins are not listed.  ``where``
    restricts the rows first (the clipped view).
    """
    rows = df.where(F.col(value).isNotNull())
    if where is not None:
        rows = rows.where(where)
    rng = rows.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1)))
    counted = rows.crossJoin(F.broadcast(rng)).groupBy(b.cast("int").alias("bin"), "_lo", "_hi").agg(
        F.count(F.lit(1)).alias("count"))
    return counted.select("bin", (F.col("_lo") + F.col("bin") * width).alias("lower"),
                          (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"), "count")


def box_stats(df: DataFrame, value: str, by: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest values inside 1.5 IQR fences) and the
    number of outliers per group."""
    by = list(by)
    rows = nan_as_null(df, [value]).where(F.col(value).isNotNull())
    q = bracketed_quantiles(rows, by, value, [0.25, 0.5, 0.75]).select(
        *by, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = q.withColumn("_lf", F.col("q1") - whisker * (F.col("q3") - F.col("q1"))) \
         .withColumn("_uf", F.col("q3") + whisker * (F.col("q3") - F.col("q1")))
    v = F.col(value)
    inside = (v >= F.col("_lf")) & (v <= F.col("_uf"))
    # the quartile table has one row per group: stored, then sent to the rows
    # behind a check of its size; a shuffle join remains for very many groups
    q = sized_broadcast(materialize(q))
    joined = rows.join(q, by, "inner") if by else rows.crossJoin(q)
    agg = joined.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))
    return agg


def mean_median(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and exact median (reference lines of a histogram)."""
    by = list(by)
    df = nan_as_null(df, [value])
    m = df.groupBy(*by).agg(F.avg(value).alias("mean"))
    med = bracketed_quantiles(df, by, value, [0.5]).withColumnRenamed("q0", "median")
    return m.join(med, by, "inner") if by else m.crossJoin(med)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def domain_violations(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Distinct values outside the allowed set (NULL included)."""
    return df.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False))).select(column).distinct()


def mean_std_pop(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation (numpy's default ``std``)."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def prediction_summary(df: DataFrame, prediction: str) -> DataFrame:
    """Rows, positive and negative predictions, positive rate."""
    p = F.col(prediction)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(p == 1).alias("positives"),
                  F.count_if(p == 0).alias("negatives"), F.avg(p.cast("double")).alias("positive_rate"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """A5 + O2: the ``n`` most frequent values (a top-k report; per-partition
    top-n then a merge, never a global sort)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(column)).limit(n)
