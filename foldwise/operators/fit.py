"""Statistics learned on an explicit set of training rows.

Every function takes the training rows as its first argument and returns a
small *parameter table*; nothing is computed on the frame that is later
transformed.  ``by`` adds grouping keys in front of every statistic, which is
how all cross-validation folds are fitted in one job (see ``folds.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import nan_as_null
from .quantiles import grouped_quantiles, not_missing, quantiles_from_counts

TIER = "_tier"


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def tiered_quantile(df: DataFrame, tiers: Sequence[Sequence[str]], value: str,
                    by: Sequence[str] = (), prob: float = 0.5, out: str = "median") -> DataFrame:
    """A1/A2/A3: exact quantile (median by default) of ``value`` for each key tier.

    ``tiers`` lists key sets from the most to the least specific, e.g.
    ``[[title, cls, sex], [title, cls], [cls], []]``.  One table results:
    ``(_tier, <all keys>, <by>, out)``; keys outside a tier are NULL.  Rows with a
    NULL key are left out of the tiers using that key (a missing key never
    matches on apply), and missing values are ignored.

    Value counts are taken once at the finest grain (map-side combine) and the
    counts are rolled up to every tier before the rank search.
    """
    res = tiered_quantiles(df, [("_", tiers, value)], by, prob, out)
    return res.drop(STAT)


STAT = "_stat"


def _ordered_keys(tier_lists) -> list[str]:
    keys: list[str] = []
    for tiers in tier_lists:
        for t in tiers:
            for k in t:
                if k not in keys:
                    keys.append(k)
    return keys


def tiered_quantiles(df: DataFrame, specs: Sequence[tuple[str, Sequence[Sequence[str]], str]],
                     by: Sequence[str] = (), prob: float = 0.5, out: str = "median") -> DataFrame:
    """Several tiered quantiles in one pass: ``specs`` = [(stat, tiers, value)].

    Result ``(_stat, _tier, <all keys>, <by>, out)``.  All measures share one
    rank search (one set of jobs for the whole fit).
    """
    by = list(by)
    all_keys = _ordered_keys([t for _, t, _ in specs])
    parts = []
    for stat, tiers, value in specs:
        keys = _ordered_keys([tiers])
        grouping = [*by, *keys, "_v"]
        # rows are counted once at the finest grain; GROUPING SETS then copies
        # counts, not rows, once per tier
        sets = [[*by, *t, "_v"] for t in tiers]
        rows = df.where(not_missing(df, value)).withColumn("_v", F.col(value).cast("double"))
        finest = rows.groupBy(*grouping).agg(F.count(F.lit(1)).alias("_m"))
        counted = finest.groupingSets(sets, *grouping).agg(F.sum("_m").alias("_n"), F.grouping_id().alias("_gid"))
        tier_of = None
        for i, t in enumerate(tiers):
            kept = {*by, *t, "_v"}
            gid = sum(1 << (len(grouping) - 1 - j) for j, c in enumerate(grouping) if c not in kept)
            # a data NULL in a key of this tier never matches on apply: drop it
            ok = F.lit(True)
            for k in t:
                ok = ok & F.col(k).isNotNull()
            cond = (F.col("_gid") == gid) & ok
            tier_of = F.when(cond, F.lit(i)) if tier_of is None else tier_of.when(cond, F.lit(i))
        part = counted.withColumn(TIER, tier_of).where(F.col(TIER).isNotNull()) \
                      .withColumn(STAT, F.lit(stat)).drop("_gid")
        parts.append(part)
    rolled = _union_all(parts)
    q = quantiles_from_counts(rolled, [STAT, TIER, *by, *all_keys], "_v", [prob])
    return q.withColumnRenamed("q0", out).select(STAT, TIER, *all_keys, *by, out)


def mode(df: DataFrame, column: str, by: Sequence[str] = (), out: str = "mode",
         weight: str | None = None) -> DataFrame:
    """A4: most frequent non-missing value; ties go to the smallest value.
    ``weight`` names a count column when ``df`` is already a frequency table."""
    c = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.where(not_missing(df, column)).groupBy(*by, column).agg(c.alias("_c"))
    # min over (-count, value): most frequent first, then smallest value
    pick = F.min(F.struct((-F.col("_c")).alias("neg"), F.col(column).alias("v")))["v"]
    return counts.groupBy(*by).agg(pick.alias(out))


def frequencies(df: DataFrame, column: str, by: Sequence[str] = (), out: str = "count") -> DataFrame:
    """A5: ``value_counts`` without NULLs: ``(by..., value, count)``."""
    return df.where(not_missing(df, column)).groupBy(*by, column).agg(F.count(F.lit(1)).alias(out))


def frequent_values(df: DataFrame, column: str, min_count: int, by: Sequence[str] = ()) -> DataFrame:
    """Values seen at least ``min_count`` times."""
    return frequencies(df, column, by).where(F.col("count") >= min_count)


def quantile_edges(df: DataFrame, value: str, q: int, by: Sequence[str] = (),
                   out: str = "edges", decimals: int | None = None) -> DataFrame:
    """``q`` equal-mass bins.  Returns the *inner* edges (array<double>),
    duplicates dropped, so the bins are (-inf, e1], (e1, e2], ..., (e_last, inf).

    Edges are exact unless ``decimals`` asks for rounding.
    """
    return inner_edges(grouped_quantiles(df, list(by), value, [i / q for i in range(q + 1)]), q, by, out, decimals)


def inner_edges(qs: DataFrame, q: int, by: Sequence[str] = (), out: str = "edges", decimals: int | None = None) -> DataFrame:
    """The inner edges from the quantiles ``q0 .. q<q>`` of every group."""
    inner = [F.col(f"q{i}") for i in range(1, q)]
    if decimals is not None:
        inner = [F.round(c, decimals) for c in inner]
        lo, hi = F.round(F.col("q0"), decimals), F.round(F.col(f"q{q}"), decimals)
    else:
        lo, hi = F.col("q0"), F.col(f"q{q}")
    # pandas.qcut keeps the distinct edges among min, inner..., max; the two
    # outer ones are then opened to -inf / +inf, so only the distinct inner
    # edges that differ from min and max survive as cut points.
    arr = F.array_distinct(F.array(lo, *inner, hi))
    kept = F.slice(arr, 2, F.greatest(F.size(arr) - 2, F.lit(0)))
    return qs.select(*by, kept.alias(out))


def mean_std(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation per column (long form)."""
    if not columns:
        return df.limit(0).select(*by, F.lit("").alias("feature"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("std"))
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    wide = nan_as_null(df, columns).groupBy(*by).agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in columns]))
    return wide.select(*by, stacked.alias("_s")).select(*by, "_s.*")


def category_lists(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sorted distinct non-missing categories per column, long form
    ``(by..., feature, category, position)``.  ``category`` is the value as
    text; ``position`` (0-based) follows the column's own type order (numbers
    numerically, text lexically), as scikit-learn's encoder does.

    One pass: all columns are unpivoted and de-duplicated together; positions
    come from the skew-safe global index (a column with very many categories is
    never numbered inside one task).
    """
    from pyspark.sql.types import NumericType

    from .ranks import global_index

    types = {f.name: f.dataType for f in df.schema.fields}
    items = []
    for c in columns:
        numeric = isinstance(types[c], NumericType)
        items.append(F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"),
                              (F.col(c).cast("double") if numeric else F.lit(None).cast("double")).alias("_num")))
    long = (df.select(*by, F.explode(F.array(*items)).alias("_s")).select(*by, "_s.*")
            .where(F.col("category").isNotNull()).distinct())
    return global_index(long, ["_num", "category"], group_by=[*by, "feature"], out="position").drop("_num")
