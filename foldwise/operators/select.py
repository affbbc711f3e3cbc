"""Feature scoring and top-k selection.

Mutual information is computed from contingency counts, which are additive:
the long form ``(by..., feature, value, label)`` is reduced by one
aggregation with a map-side combine, whatever the number of rows.

* E5a, discrete plug-in: ``MI = sum p(x,y) ln(p(x,y) / (p(x) p(y)))`` in nats.
  Values absent from the long form count as 0 (sparse one-hot rows).
* E5b, continuous: values are first cut at their learned equal-mass edges,
  then scored as E5a.

Scores are rounded to 12 decimals before ranking so that equal partitions
score equal, and ties go to the later column (the reference's stable order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import learned_bin_code
from ..session import materialize, sized_broadcast
from .fit import inner_edges
from .quantiles import quantiles_from_counts

SCORE_DECIMALS = 12


def class_counts(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_ny"))


def mutual_information(long: DataFrame, label: str, classes: DataFrame, by: Sequence[str] = (),
                       out: str = "mi") -> DataFrame:
    """Plug-in MI per ``(by..., feature)`` from the long form.

    ``classes`` = :func:`class_counts` of the same rows.
    """
    by = list(by)
    # the contingency table is small (features x distinct values x classes) and
    # is read three times below: computed once from the long rows and stored
    c = materialize(long.groupBy(*by, "feature", "value", label).agg(F.count(F.lit(1)).alias("_c")))
    return mi_from_counts(c, label, classes, by, out)


def mi_from_counts(c: DataFrame, label: str, classes: DataFrame, by: Sequence[str] = (), out: str = "mi") -> DataFrame:
    """E5a from a stored contingency table ``(by..., feature, value, label, _c)``."""
    by = list(by)
    # rows missing from the long form are zeros: top up value 0.0 per class
    seen = c.groupBy(*by, "feature", label).agg(F.sum("_c").alias("_seen"))
    zeros = (seen.join(classes, [*by, label], "inner")
             .select(*by, "feature", F.lit(0.0).alias("value"), label,
                     (F.col("_ny") - F.col("_seen")).alias("_c"))
             .where(F.col("_c") > 0))
    c = c.unionByName(zeros).groupBy(*by, "feature", "value", label).agg(F.sum("_c").alias("_c"))
    tot = classes.groupBy(*by).agg(F.sum("_ny").alias("_n"))
    px = c.groupBy(*by, "feature", "value").agg(F.sum("_c").alias("_cx"))
    j = (c.join(px, [*by, "feature", "value"]).join(classes, [*by, label]).join(tot, by) if by
         else c.join(px, ["feature", "value"]).join(classes, [label]).crossJoin(tot))
    c_, n_ = F.col("_c").cast("double"), F.col("_n").cast("double")
    cx, ny = F.col("_cx").cast("double"), F.col("_ny").cast("double")
    term = (c_ / n_) * F.log(c_ * n_ / (cx * ny))
    return j.groupBy(*by, "feature").agg(F.greatest(F.sum(term), F.lit(0.0)).alias(out))


def value_cells(rows: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """``(feature, num, cat, label, _c)``: the rows by value of every column, stored; from
    one read of the rows, and counted before anything is shuffled."""
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("num"), F.lit(None).cast("string").alias("cat")) for c in numeric]
    items += [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("num"), F.col(c).cast("string").alias("cat")) for c in categorical]
    long = rows.select(label, F.explode(F.array(*items)).alias("_s")).select(label, "_s.*").where("num IS NOT NULL OR cat IS NOT NULL")
    return materialize(long.groupBy("feature", "num", "cat", label).agg(F.count(F.lit(1)).alias("_c")))


def mi_of_cells(cells: DataFrame, label: str, classes: DataFrame, continuous: Sequence[str], bins: int = 10) -> DataFrame:
    """E5a/E5b of every numeric column and one-hot category from :func:`value_cells`:
    edges and bins are found on the counts, the rows are not read again."""
    cont = cells.where(F.col("feature").isin(*continuous))
    counts = cont.groupBy("feature", "num").agg(F.sum("_c").alias("_n"))
    edges = inner_edges(quantiles_from_counts(counts, ["feature"], "num", [i / bins for i in range(bins + 1)]), bins, by=["feature"])
    coded = cont.join(sized_broadcast(materialize(edges)), "feature").withColumn("value", learned_bin_code(F.col("num"), F.col("edges"), bins - 1).cast("double"))
    other = cells.where(~F.col("feature").isin(*continuous)).withColumn("value", F.coalesce("num", F.lit(1.0))).withColumn("feature", F.concat_ws("_", "feature", "cat"))
    kept = ["feature", "value", label, "_c"]
    table = coded.select(*kept).unionByName(other.select(*kept)).groupBy("feature", "value", label).agg(F.sum("_c").alias("_c"))
    return mi_from_counts(materialize(table), label, classes)


def rank_features(scores: DataFrame, positions: DataFrame, by: Sequence[str] = (),
                  score: str = "mi") -> DataFrame:
    """O3: ``rank`` 1.. per group by rounded score desc, later column first on ties.

    ``positions`` = ``(feature, position)`` of the encoded column order.
    """
    by = list(by)
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(
        F.desc(F.round(score, SCORE_DECIMALS)), F.desc("position"))
    return scores.join(sized_broadcast(positions), "feature").withColumn("rank", F.row_number().over(w))


def select_k(ranked: DataFrame, k: int | None) -> DataFrame:
    """Features with rank <= k (all when k is None), in column order."""
    return ranked if k is None else ranked.where(F.col("rank") <= k)


# ---------------------------------------------------------------------------
# K-nearest-neighbour MI between a continuous feature and a discrete label
# (Ross 2014, the estimator behind the reference's scores), one dimension.

EULER_GAMMA = 0.5772156649015329


def digamma_int(n):
    """psi(n) for a positive integer column: H(n-1) - gamma; exact below 10,
    asymptotic series above (error < 1e-12)."""
    expr = None
    for m in range(1, 10):
        h = sum(1.0 / i for i in range(1, m)) - EULER_GAMMA
        expr = F.when(n == m, F.lit(h)) if expr is None else expr.when(n == m, F.lit(h))
    x = n.cast("double")
    series = (F.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * F.pow(x, 4))
              - 1 / (252 * F.pow(x, 6)) + 1 / (240 * F.pow(x, 8)))
    return expr.otherwise(series)


def knn_mutual_information(long: DataFrame, key: str, label: str, by: Sequence[str] = (),
                           k: int = 3, out: str = "mi") -> DataFrame:
    """E5c on the long form ``(by..., key, feature, value, label)``.

    For each point: ``r`` = distance to its k-th neighbour of the same class
    (k = min(k, class size - 1); classes of one point are ignored), ``m`` =
    points of any class strictly closer than ``r`` (equal values when r = 0),
    ``MI = psi(N) + <psi(k)> - <psi(N_class)> - <psi(m)>``, floored at 0.
    "Strictly closer" is evaluated on values: ``x - r < v < x + r``.

    Neighbours come from ``lag`` and ``lead`` inside range slices, mended at the
    slices' borders, and ``m`` from one skew-safe running count over the values
    merged with the two query bounds of every point: no window holds a whole class,
    and no pair of points is ever formed.
    """
    from .ranks import neighbours, running_sum

    by = list(by)
    g = [*by, "feature"]
    gl = [*g, label]
    rows = long.where(F.col("value").isNotNull()).select(*g, key, label, F.col("value").cast("double").alias("value"))
    ny = rows.groupBy(*gl).agg(F.count(F.lit(1)).alias("_ny"))
    rows = rows.join(ny, gl).where(F.col("_ny") > 1).withColumn("_k", F.least(F.lit(k), F.col("_ny") - 1))
    p = neighbours(rows, ["value", key], gl, "value", k)
    inf = F.lit(float("inf"))
    x = F.col("value")

    def dist(d: int):
        if d == 0:
            return F.lit(0.0)
        v = F.get(F.col("_before" if d < 0 else "_after"), F.lit(abs(d) - 1))
        return F.coalesce(F.abs(v - x), inf)

    radius = None
    for kk in range(1, k + 1):
        r_kk = F.least(*[F.greatest(dist(-(kk - j)), dist(j)) for j in range(0, kk + 1)]) \
            if kk > 0 else F.lit(0.0)
        radius = F.when(F.col("_k") == kk, r_kk) if radius is None else radius.when(F.col("_k") == kk, r_kk)
    p = materialize(p.select(*gl, "_ny", "_k", "value", "_i", radius.alias("_r")))  # read four times below
    # counts of points strictly inside (x - r, x + r); all points equal to x when r = 0
    pts = p.select(*g, x.alias("_v"), F.lit(1).alias("_t"), F.lit(1).cast("long").alias("_w"))
    zero = F.col("_r") == 0
    up = p.select(*g, (x + F.col("_r")).alias("_v"), F.when(zero, 2).otherwise(0).alias("_t"),
                  F.lit(0).cast("long").alias("_w"), F.col("_i").alias("_q"), F.lit(1).alias("_side"),
                  F.col(label).alias("_lab"), "_ny", "_k")
    lo = p.select(*g, (x - F.col("_r")).alias("_v"), F.when(zero, 0).otherwise(2).alias("_t"),
                  F.lit(0).cast("long").alias("_w"), F.col("_i").alias("_q"), F.lit(-1).alias("_side"),
                  F.col(label).alias("_lab"), "_ny", "_k")
    asked = up.unionByName(lo)
    # equal values are added up first, so that a value with very many copies (a
    # filled-in median) is one row of the running count
    places = pts.unionByName(asked.select(*g, "_v", "_t", "_w")).groupBy(*g, "_v", "_t").agg(F.sum("_w").alias("_w"))
    cum = materialize(running_sum(places, ["_v", "_t"], "_w", g, out="_c"))
    q = asked.drop("_w").join(cum, [*g, "_v", "_t"])
    per_point = q.groupBy(*g, "_lab", "_q", "_ny", "_k").agg(F.sum(F.col("_side") * F.col("_c")).alias("_m"))
    agg = per_point.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(digamma_int(F.col("_k"))).alias("_pk"),
        F.avg(digamma_int(F.col("_ny"))).alias("_pn"),
        F.avg(digamma_int(F.col("_m"))).alias("_pm"))
    mi = digamma_int(F.col("_n")) + F.col("_pk") - F.col("_pn") - F.col("_pm")
    return agg.select(*g, F.greatest(mi, F.lit(0.0)).alias(out))

