"""Apply learned parameter tables to any batch.

Each lookup is a left join of the batch with a small parameter table.  The
parameter side is broadcast behind a row-count check
(:func:`foldwise.session.sized_broadcast`), so the batch is never shuffled for
it; the joins pipeline inside the scan's stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import sized_broadcast
from .fit import TIER


def join_params(df: DataFrame, params: DataFrame, keys: Sequence[str], prefix: str,
                payload: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Left join ``params(keys+by, payload)`` to ``df`` on keys+by; the side's
    columns arrive with ``prefix`` (callers select what they keep)."""
    join_keys = list(by) + list(keys)
    side = params.select(*[F.col(k).alias(f"{prefix}k_{k}") for k in join_keys],
                         *[F.col(p).alias(f"{prefix}{p}") for p in payload])
    side = sized_broadcast(side)
    if not join_keys:
        return df.crossJoin(side)   # a one-row table
    cond = [df[k] == side[f"{prefix}k_{k}"] for k in join_keys]
    return df.join(side, on=cond, how="left")


def apply_tiered(df: DataFrame, params: DataFrame, tiers: Sequence[Sequence[str]], value: str,
                 out: str, stat: str = "median", by: Sequence[str] = (),
                 tier_out: str | None = None) -> DataFrame:
    """``coalesce(value, tier0, tier1, ..., overall)``.

    ``params`` comes from :func:`foldwise.operators.fit.tiered_quantile`.  A
    tier whose group had no observed value is absent, so the next tier answers,
    which also covers an all-missing class (the reference's NaN hole, Q13).
    ``tier_out`` names an optional column with the answering tier: -1 when the
    value was observed, else the tier index.
    """
    res = df
    fills: list[Column] = []
    for i, t in enumerate(tiers):
        part = params.where(F.col(TIER) == i)
        res = join_params(res, part, t, f"_t{i}_", [stat], by)
        fills.append(F.col(f"_t{i}_{stat}"))
    observed = F.col(value).isNotNull()
    if dict(df.dtypes).get(value) in ("double", "float"):
        observed = observed & ~F.isnan(F.col(value))
    filled = F.when(observed, F.col(value).cast("double")).otherwise(F.coalesce(*fills))
    outs = [filled.alias(out)]
    if tier_out:
        which = F.when(observed, F.lit(-1))
        for i, f in enumerate(fills):
            which = which.when(f.isNotNull(), F.lit(i))
        outs.append(which.alias(tier_out))
    keep = [F.col(c) for c in df.columns if c not in (out, tier_out)]
    return res.select(*keep, *outs)


def keep_if_listed(df: DataFrame, listed: DataFrame, column: str, list_col: str, out: str,
                   other: str = "OTHER", by: Sequence[str] = ()) -> DataFrame:
    """Keep the value when it is in the learned list, else ``other``."""
    side = listed.select(*by, F.col(list_col).alias(column)).withColumn("_listed", F.lit(True))
    res = join_params(df, side, [column], "_l_", ["_listed"], by)
    keep = [F.col(c) for c in df.columns if c != out]
    return res.select(*keep, F.when(F.col("_l__listed"), F.col(column)).otherwise(F.lit(other)).alias(out))
