"""Exact grouped quantiles (linear interpolation, ``quantile_cont`` semantics).

Values are pre-aggregated to ``(group, value, count)`` with a map-side combine;
the values at the two ranks around ``p * (n - 1)`` are found with the
range-sliced running sum of :mod:`.ranks`.  No group, however large or however
many distinct values it has, is ever held by one task.

NULL values are ignored; a group whose values are all NULL yields NULL (the
caller falls back to a coarser level).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, sized_broadcast
from . import ranks


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys..., value, _n)``: one row per distinct non-null value of each group."""
    return (df.where(not_missing(df, value))
            .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))


def not_missing(df: DataFrame, name: str):
    """NULL, and NaN for floating columns, count as missing (pandas' notna)."""
    cond = F.col(name).isNotNull()
    if dict(df.dtypes).get(name) in ("double", "float"):
        cond = cond & ~F.isnan(F.col(name))
    return cond


def quantiles_from_counts(counts: DataFrame, keys: Sequence[str], value: str,
                          probs: Sequence[float], count_col: str = "_n",
                          slices: int | None = None) -> DataFrame:
    """Quantiles from a ``(keys, value, count)`` table with unique ``(keys, value)``.

    Returns ``(keys..., q0, q1, ...)`` one column per probability, DOUBLE.
    """
    keys = list(keys)
    data = counts.select(*keys, value, count_col)
    cum = ranks.sliced_running_sum(data.withColumn("_w", F.col(count_col)), [value], keys, "_cum", "_total",
                                   slices or ranks.default_slices(data))
    v = F.col(value).cast("double")
    first_rank = F.col("_cum") - F.col(count_col)           # rank of the first copy (0-based)
    aggs, cols = [], []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        lo = F.floor(pos)
        hi = F.ceil(pos)
        holds_lo = (first_rank <= lo) & (lo < F.col("_cum"))
        holds_hi = (first_rank <= hi) & (hi < F.col("_cum"))
        cols += [F.when(holds_lo, v).alias(f"_lo{i}"), F.when(holds_hi, v).alias(f"_hi{i}"),
                 (pos - lo).alias(f"_fr{i}")]
        aggs += [F.max(f"_lo{i}").alias(f"_lo{i}"), F.max(f"_hi{i}").alias(f"_hi{i}"),
                 F.max(f"_fr{i}").alias(f"_fr{i}")]
    cum = cum.select(*keys, *cols)
    hits = None
    for i in range(len(probs)):
        cond = F.col(f"_lo{i}").isNotNull() | F.col(f"_hi{i}").isNotNull()
        hits = cond if hits is None else (hits | cond)
    picked = cum.where(hits).groupBy(*keys).agg(*aggs)   # <= 2 rows per group and probability
    out = [F.col(k) for k in keys]
    for i in range(len(probs)):
        lo, hi, fr = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_fr{i}")
        out.append(F.when(fr == 0, lo).otherwise(lo + (hi - lo) * fr).alias(f"q{i}"))
    return picked.select(*out)


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                      slices: int | None = None) -> DataFrame:
    """Exact quantiles of ``value`` per ``keys`` group: ``(keys..., q0, q1, ...)``."""
    keys = list(keys)
    return quantiles_from_counts(value_counts(df, keys, value), keys, value, probs, slices=slices)


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    return grouped_quantiles(df, keys, value, [0.5]).withColumnRenamed("q0", out)


# ---- exact quantiles without moving all values -----------------------------------

SKETCH_K = 1600   # a sketch's rank error is then well under MARGIN
MARGIN = 0.01     # of the rank, on either side of what is asked for


def _between(df: DataFrame, keys: list[str], value: str, probs: Sequence[float], margin: float, k: int) -> tuple[DataFrame, DataFrame]:
    """(brackets, counts): per group its size and, for every probability, two values that
    should enclose the quantile; and ``(keys, _below, _v, _n)``, the rows counted by their
    value where it is inside a bracket, and only by which brackets are above it elsewhere."""
    rows = df.where(not_missing(df, value)).select(*keys, F.col(value).cast("double").alias("_v"))
    sketch = rows.groupBy(*keys).agg(F.kll_sketch_agg_double("_v", F.lit(k)).alias("_s"), F.count(F.lit(1)).alias("_total"))
    end = lambda p, q, beyond: F.lit(beyond) if not 0 < q < 1 else F.kll_sketch_get_quantile_double("_s", F.lit(float(q)))
    pairs = F.array(*[F.struct(end(p, p - margin, float("-inf")).alias("low"), end(p, p + margin, float("inf")).alias("high")) for p in probs])
    brackets = materialize(sketch.select(*[F.col(c).alias(f"_b_{c}") for c in keys], "_total", pairs.alias("_pairs")))
    side = sized_broadcast(brackets)
    cond = F.lit(True)
    for c in keys:
        cond = cond & rows[c].eqNullSafe(side[f"_b_{c}"])
    placed = rows.join(side, cond) if keys else rows.crossJoin(side)  # without keys one row
    below = F.aggregate(F.transform("_pairs", lambda x, i: F.when(F.col("_v") < x["low"], F.call_function("shiftleft", F.lit(1), i)).otherwise(0)), F.lit(0), lambda a, x: a + x)
    inside = F.exists("_pairs", lambda x: (F.col("_v") >= x["low"]) & (F.col("_v") <= x["high"]))
    counts = placed.groupBy(*keys, below.alias("_below"), F.when(inside, F.col("_v")).alias("_in")).agg(F.count(F.lit(1)).alias("_n"))
    return brackets, materialize(counts)


def bracketed_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], margin: float = MARGIN, k: int = SKETCH_K) -> DataFrame:
    """Exact quantiles as :func:`grouped_quantiles` gives them, by bracket and refine.

    A mergeable sketch per group (one aggregation) gives bounds around every rank that is
    asked for; a second pass counts the rows below them and keeps only the values in
    between, about ``2 * margin`` of a continuous column, for the rank search.  The counts
    tell whether a bracket holds its rank; a group where one does not is done from all its
    values, so the result never depends on a sketch.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    brackets, counts = _between(df, keys, value, probs, margin, k)
    n = len(probs)
    per = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(probs)]))
    bit = lambda c: F.call_function("shiftright", F.col("_below"), F.col(c)).bitwiseAND(F.lit(1)) == 1
    named = [F.col(f"_b_{c}").alias(c) for c in keys]
    wanted = brackets.select(*named, "_total", "_pairs", per.alias("_q")).select(*keys, "_total", "_pairs", "_q.*") \
        .withColumn("_low", F.get("_pairs", F.col("i"))["low"]).withColumn("_high", F.get("_pairs", F.col("i"))["high"]).drop("_pairs")
    wanted = wanted.select(*[F.col(c).alias(f"_w_{c}") for c in keys], "_total", "i", "p", "_low", "_high")
    side = sized_broadcast(materialize(wanted))
    cond = F.lit(True)
    for c in keys:
        cond = cond & counts[c].eqNullSafe(side[f"_w_{c}"])
    met = counts.join(side, cond) if keys else counts.crossJoin(side)  # groups x probabilities on one side
    held = (F.col("_in") >= F.col("_low")) & (F.col("_in") <= F.col("_high"))
    tally = materialize(met.groupBy(*keys, "i").agg(F.first("p").alias("p"), F.first("_total").alias("_total"), F.sum(F.when(bit("i"), F.col("_n")).otherwise(0)).alias("_under"),
                                                    F.sum(F.when(held, F.col("_n")).otherwise(0)).alias("_held")))
    place = F.col("p") * (F.col("_total") - 1)
    good = (F.col("_under") <= F.floor(place)) & (F.ceil(place) < F.col("_under") + F.col("_held"))
    missed = materialize(tally.where(~good).select(*[F.col(c).alias(f"_x_{c}") for c in keys]).distinct()) if keys else tally.where(~good).select(F.lit(1).alias("_x"))
    # the rank search over the values inside, each bracket with the rows under it as its offset
    inner = met.where(held).groupBy(*keys, "i", F.col("_in").alias("_v")).agg(F.sum("_n").alias("_w"))
    cum = ranks.sliced_running_sum(inner.withColumn("_c", F.col("_w")), ["_v"], [*keys, "i"], "_cum", None, ranks.default_slices(inner))
    t = tally.select(*[F.col(c).alias(f"_t_{c}") for c in keys], F.col("i").alias("_t_i"), place.alias("_place"), "_under")
    cond = cum["i"] == t["_t_i"]
    for c in keys:
        cond = cond & cum[c].eqNullSafe(t[f"_t_{c}"])
    at = cum.join(sized_broadcast(t), cond)
    first, last = F.col("_under") + F.col("_cum") - F.col("_c"), F.col("_under") + F.col("_cum")
    holds = lambda rank: (first <= rank) & (rank < last)
    lo, hi = F.max(F.when(holds(F.floor("_place")), F.col("_v"))), F.max(F.when(holds(F.ceil("_place")), F.col("_v")))
    ends = at.groupBy(*keys, "i").agg(lo.alias("_lo"), hi.alias("_hi"), F.max(F.col("_place") - F.floor("_place")).alias("_part"))
    q = F.when(F.col("_part") == 0, F.col("_lo")).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part"))
    wide = ends.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, q)).alias(f"q{i}") for i in range(n)])
    if missed.isEmpty():
        return wide
    if not keys:
        return grouped_quantiles(df, keys, value, probs)
    again = lambda side: [side[c].eqNullSafe(F.col(f"_x_{c}")) for c in keys]
    redone = grouped_quantiles(df.join(sized_broadcast(missed), again(df), "left_semi"), keys, value, probs)
    return wide.join(sized_broadcast(missed), again(wide), "left_anti").unionByName(redone)
