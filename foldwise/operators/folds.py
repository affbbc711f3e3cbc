"""Seeded stratified folds and per-fold training sets.

Fold rule (reproducible in any SQL engine): order the rows by
``(label, md5(concat_ws('|', key, seed)))``, number them 0..n-1 and deal
``fold = idx % k + 1``.  Fold sizes differ by at most one and each label is
spread evenly.  The index of a row is the number of rows in the buckets before
its own (a bucket: one label and one value of the first ``BUCKET_DIGITS`` hex
digits of the hash, counted with a map-side combine) plus its place inside the
bucket, so no label (two groups!) goes through one task and rows are shuffled once.

Training sets of many folds at once are the matter of ``split_stats.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import nan_as_null
from ..session import materialize, sized_broadcast

TRAIN, VALID = "train", "valid"


def fold_hash(key: str, seed: int | Column) -> Column:
    seed_col = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), seed_col.cast("string")))


# 65,536 buckets per label: their counts fit one task, and 100 TB of rows leave
# about a million rows in each
BUCKET_DIGITS = 4


# where the numbered rows are stored: their buckets' counts are broadcast
STORED_DIGITS = 3


def hashed_index(df: DataFrame, h: Column, first: Sequence[str], group_by: Sequence[str], out: str, stored: bool = False) -> DataFrame:
    """Add ``out``: the 0-based position in the order ``(*first, h)`` inside
    ``group_by``, for a uniformly distributed hex string ``h``.

    ``stored`` writes the rows once they have their place in a bucket and counts the
    buckets from there: ``df`` is worked out, and hashed, once instead of twice."""
    tagged = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, STORED_DIGITS if stored else BUCKET_DIGITS))
    bucket = [*group_by, *first, "_b"]
    if stored:
        inside = materialize(tagged.withColumn("_place", F.row_number().over(Window.partitionBy(*bucket).orderBy("_h"))).drop("_h"))
        sizes = inside.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_size"))
        before = (Window.partitionBy(*group_by) if group_by else Window.partitionBy(F.lit(0))).orderBy(*first, "_b").rowsBetween(Window.unboundedPreceding, -1)
        starts = sized_broadcast(materialize(sizes.select(*[F.col(c).alias(f"_o_{c}") for c in bucket], F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))))
        match = [inside[c].eqNullSafe(starts[f"_o_{c}"]) for c in bucket]
        return inside.join(starts, match).withColumn(out, F.col("_start") + F.col("_place") - 1).drop("_b", "_place", "_start", *[f"_o_{c}" for c in bucket])
    sizes = tagged.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group_by) if group_by else Window.partitionBy(F.lit(0))
    before = before.orderBy(*first, "_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(f"_o_{c}") for c in bucket],
                          F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = tagged.withColumn("_place", F.row_number().over(Window.partitionBy(*bucket).orderBy("_h")))
    match = [inside[c].eqNullSafe(starts[f"_o_{c}"]) for c in bucket]
    return (inside.join(starts, match).withColumn(out, F.col("_start") + F.col("_place") - 1)
            .drop("_h", "_b", "_place", "_start", *[f"_o_{c}" for c in bucket]))


def assign_folds(df: DataFrame, key: str, label: str, k: int, seed: int,
                 out: str = "fold", group_by: Sequence[str] = (), seed_col: Column | None = None,
                 approximate: bool = False, stored: bool = False) -> DataFrame:
    """Stratified fold ``1..k`` for every row (within ``group_by`` groups).

    ``approximate=True`` deals ``pmod(xxhash64(key, seed), k) + 1`` instead: no
    ordering pass and no shuffle, folds balanced only in expectation.  ``stored``: see
    :func:`hashed_index`.
    """
    if approximate:
        s = seed_col if seed_col is not None else F.lit(seed)
        return df.withColumn(out, (F.pmod(F.xxhash64(F.col(key), s), F.lit(k)) + 1).cast("int"))
    h = fold_hash(key, seed_col if seed_col is not None else seed)
    idx = hashed_index(df, h, [label], list(group_by), "_idx", stored)
    return idx.withColumn(out, (F.col("_idx") % k + 1).cast("int")).drop("_idx")


def holdout_split(df: DataFrame, key: str, label: str, test_size: float, seed: int,
                  out: str = "role") -> DataFrame:
    """Stratified hold-out: per label the first ``ceil(n_label*test_size)``
    rows in hash order go to ``valid``."""
    idx = hashed_index(df, fold_hash(key, seed), [], [label], "_idx")
    n = df.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    joined = idx.join(sized_broadcast(n), F.col(label).eqNullSafe(F.col("_l")))      # one row per label value
    return (joined.withColumn(out, F.when(F.col("_idx") < F.ceil(F.col("_n") * test_size), F.lit(VALID))
                              .otherwise(F.lit(TRAIN)))
            .drop("_idx", "_n", "_l"))


def fold_sizes(folds: DataFrame, fold: str = "fold", label: str | None = None) -> DataFrame:
    keys = [fold] + ([label] if label else [])
    return folds.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def fold_moments(df: DataFrame, columns: Sequence[str], fold: str, k: int) -> DataFrame:
    """V1 for additive statistics: count, mean and population std of each column
    over the training rows of every fold, from one pass over the data and no row
    expansion.

    Per fold ``(n, mean, M2)`` are taken in one aggregation; those of the k-1
    other folds are then merged (Chan et al.), which neither rounds the values
    nor subtracts large sums from each other.
    Result: ``(fold, feature, n, mean, std)``.
    """
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"{c}__n"), F.avg(v).alias(f"{c}__mean"),
                 (F.var_pop(v) * F.count(v)).alias(f"{c}__m2")]
    per = nan_as_null(df, columns).groupBy(fold).agg(*aggs)
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__mean").alias("mean"),
                                       F.col(f"{c}__m2").alias("m2")) for c in columns]))
    long = per.select(F.col(fold).alias("_of"), one.alias("_m")).select("_of", "_m.*").where("n > 0")
    # k rows per feature: each goes to the k-1 training sets it belongs to
    to = F.explode(F.array_except(F.sequence(F.lit(1), F.lit(k)), F.array(F.col("_of").cast("int"))))
    parts = F.sort_array(F.collect_list(F.struct(F.col("_of"), F.col("n").cast("double").alias("n"), "mean", "m2")))
    sets = long.withColumn(fold, to).groupBy(fold, "feature").agg(parts.alias("_p"))

    def merge(a, b):
        n, d = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + d * b["n"] / n).alias("mean"),
                        (a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / n).alias("m2"))

    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    total = F.aggregate("_p", zero, merge)
    return sets.withColumn("_t", total).select(fold, "feature", F.col("_t.n").cast("long").alias("n"), F.col("_t.mean").alias("mean"),
                                               F.sqrt(F.col("_t.m2") / F.col("_t.n")).alias("std"))
