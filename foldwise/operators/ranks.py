"""Exact running sums and global row indexes without one-task windows.

A window ``partitionBy(g).orderBy(v)`` puts every row of a group into one task;
with one group holding a third of the table that task becomes the job.  The
forms here range-partition on ``(group keys, order keys)`` so a hot group is
cut into many bounded slices, compute running sums inside each slice, and
stitch the slices together with per-slice totals, which form a table of at most
``#slices + #groups`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, sized_broadcast

_PID = "_slice"


def default_slices(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def running_sum(df: DataFrame, order_by: Sequence[str], weight: str | None = None,
                group_by: Sequence[str] = (), out: str = "cum",
                total_out: str | None = None, slices: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (1 when None) over all rows of the same
    group whose order key is <= the row's (rows with equal keys are ordered by
    the remaining columns of ``order_by``; give a unique tail for a strict index).

    ``total_out`` optionally adds the group total.  Exact, skew-safe, no
    unbounded single-task window and no driver round trip; the same form at
    every size.
    """
    w = F.lit(1).cast("long") if weight is None else F.col(weight)
    return sliced_running_sum(df.withColumn("_w", w), order_by, list(group_by), out, total_out,
                              slices or default_slices(df))


def sliced_running_sum(data: DataFrame, order_by: Sequence[str], group_by: list[str],
                       out: str, total_out: str | None, slices: int) -> DataFrame:
    """:func:`running_sum` for rows that carry their weight in ``_w``."""
    keys = group_by + list(order_by)
    # The slice of a row must be the same for both consumers below.  Range
    # bounds come from sampling (seeded per RDD), so two evaluations could
    # disagree: the tagged rows are materialised once.
    ranged = materialize(data.repartitionByRange(slices, *keys)
                         .withColumn(_PID, F.spark_partition_id()))
    local_w = (Window.partitionBy(_PID, *group_by).orderBy(*order_by)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_local", F.sum("_w").over(local_w))
    # per-slice totals: at most (#slices + #groups) rows
    slice_tot = ranged.groupBy(_PID, *group_by).agg(F.sum("_w").alias("_slice_total"))
    # a window over the slice-total table; its groups hold at most #slices rows
    part = Window.partitionBy(*group_by) if group_by else Window.partitionBy(F.lit(0))
    before = part.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = slice_tot.withColumn("_offset", F.coalesce(F.sum("_slice_total").over(before), F.lit(0)))
    if total_out:
        offsets = offsets.withColumn(total_out, F.sum("_slice_total").over(part))
    offsets = offsets.drop("_slice_total")
    # group keys may be NULL (rolled-up levels), so the join is null-safe
    offsets = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in offsets.columns])
    cond = [local[_PID] == offsets[f"_o_{_PID}"]] + [local[g].eqNullSafe(offsets[f"_o_{g}"]) for g in group_by]
    joined = local.join(offsets, on=cond, how="inner")
    joined = joined.withColumn(out, F.col("_o__offset") + F.col("_local"))
    if total_out:
        joined = joined.withColumnRenamed(f"_o_{total_out}", total_out)
    dropped = [c for c in joined.columns if c.startswith("_o_")] + ["_w", "_local", _PID]
    return joined.drop(*dropped)


def sliced_running_sums(data: DataFrame, order_by: Sequence[str], group_by: list[str], weights: Sequence[str], slices: int) -> DataFrame:
    """``data`` plus, for every column ``w`` of ``weights``, ``_cum<w>`` (its sum over the
    rows of the group up to this one in the order, which must be unique) and ``_total<w>``:
    many running sums from one ordering, sliced as in :func:`sliced_running_sum`."""
    ranged = materialize(data.repartitionByRange(slices, *group_by, *order_by).withColumn(_PID, F.spark_partition_id()))
    up_to_here = Window.partitionBy(_PID, *group_by).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(w).over(up_to_here).alias(f"_local{w}") for w in weights])
    totals = ranged.groupBy(_PID, *group_by).agg(*[F.sum(w).alias(w) for w in weights])
    part = Window.partitionBy(*group_by) if group_by else Window.partitionBy(F.lit(0))
    before = part.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(_PID).alias("_o_slice"), *[F.col(g).alias(f"_o_{g}") for g in group_by],
                            *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"_before{w}") for w in weights],
                            *[F.sum(w).over(part).alias(f"_total{w}") for w in weights])
    cond = [local[_PID] == offsets["_o_slice"]] + [local[g].eqNullSafe(offsets[f"_o_{g}"]) for g in group_by]
    return local.join(offsets, cond).select(*data.columns, *[(F.col(f"_before{w}") + F.col(f"_local{w}")).alias(f"_cum{w}") for w in weights],
                                            *[f"_total{w}" for w in weights])


def global_index(df: DataFrame, order_by: Sequence[str], group_by: Sequence[str] = (),
                 out: str = "idx", slices: int | None = None) -> DataFrame:
    """0-based position of each row in the order ``order_by`` (inside ``group_by``).

    ``order_by`` must be unique within a group for the index to be deterministic.
    """
    res = running_sum(df, order_by, None, group_by, out="_cum", slices=slices)
    return res.withColumn(out, F.col("_cum") - 1).drop("_cum")


def neighbours(data: DataFrame, order_by: Sequence[str], group_by: Sequence[str], value: str, k: int, slices: int | None = None) -> DataFrame:
    """``data`` plus ``_i`` (0-based place in the order of the group, which must be unique),
    ``_before`` and ``_after``: the ``value`` of the k rows on either side, nearest first,
    NULL beyond the ends of the group.

    Rows are dealt to range slices and look at each other inside their slice (``lag`` and
    ``lead`` in one window).  Only the k rows at either border of a slice lack a
    neighbour; these few are stored and meet by their places, across as many slices as it
    takes, so neither a group nor its copies are ever in one task.
    """
    g = list(group_by)
    keys = g + list(order_by)
    ranged = materialize(data.repartitionByRange(slices or default_slices(data), *keys).withColumn(_PID, F.spark_partition_id()))
    inside = Window.partitionBy(_PID, *g).orderBy(*order_by)
    sides = {"_before": F.lag, "_after": F.lead}
    seen = ranged.select("*", F.row_number().over(inside).alias("_row"),
                         *[F.array(*[step(value, d).over(inside) for d in range(1, k + 1)]).alias(s) for s, step in sides.items()])
    sizes = ranged.groupBy(_PID, *g).agg(F.count(F.lit(1)).alias("_rows"))
    part = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    before = part.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(_PID).alias("_o_slice"), *[F.col(c).alias(f"_o_{c}") for c in g], "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
                          F.sum("_rows").over(part).alias("_all"))
    starts = sized_broadcast(materialize(starts))  # so the rows are not shuffled again
    cond = [seen[_PID] == starts["_o_slice"]] + [seen[c].eqNullSafe(starts[f"_o_{c}"]) for c in g]
    placed = materialize(seen.join(starts, cond).withColumn("_i", F.col("_start") + F.col("_row") - 1).drop("_o_slice", "_start", _PID, *[f"_o_{c}" for c in g]))
    at_border = (F.col("_row") <= k) | (F.col("_row") > F.col("_rows") - k)
    own = [F.col(c) for c in data.columns]
    done = placed.where(~at_border)
    short = materialize(placed.where(at_border))  # at most 2k rows of a slice and group
    # places that a row has not met although its group has them
    wanted = F.filter(F.concat(*[_lacking(s, sign) for s, sign in (("_before", -1), ("_after", 1))]), lambda x: (x["at"] >= 0) & (x["at"] < F.col("_all")))
    asked = short.withColumn("_wanted", wanted).select(*[F.col(c).alias(f"_g_{c}") for c in g], F.col("_i").alias("_of"), F.explode("_wanted").alias("_w")).select("*", "_w.side", "_w.d", "_w.at").drop("_w")
    there = short.select(*g, "_i", F.col(value).alias("_v"))  # what lies across a border is itself at one
    met = asked.join(there, [F.col("at") == F.col("_i"), *[F.col(f"_g_{c}").eqNullSafe(F.col(c)) for c in g]]).select("_of", "side", "d", "_v", *[f"_g_{c}" for c in g])
    found = met.groupBy("_of", *[f"_g_{c}" for c in g]).agg(F.collect_list(F.struct("side", "d", "_v")).alias("_found"))  # at most 2k
    patched = short.join(found, [F.col("_i") == F.col("_of"), *[short[c].eqNullSafe(F.col(f"_g_{c}")) for c in g]], "left")
    none = F.array().cast(f"array<struct<side:string,d:int,_v:{data.schema[value].dataType.simpleString()}>>")

    def filled(s: str):
        return F.transform(F.col(s), lambda x, j: F.when(_there(s, j + 1), x).otherwise(
            F.get(F.filter(F.coalesce("_found", none), lambda y: (y["side"] == s) & (y["d"] == j + 1)), F.lit(0))["_v"])).alias(s)

    return done.select(*own, "_i", "_before", "_after").unionByName(patched.select(*[short[c] for c in data.columns], "_i", filled("_before"), filled("_after")))


def _there(side: str, d):
    """Whether a row's own slice holds its neighbour at distance ``d``."""
    return F.col("_row") > d if side == "_before" else F.col("_row") + d <= F.col("_rows")


def _lacking(side: str, sign: int):
    """(side, d, place) of the neighbours that a row has not met in its slice."""
    at = F.transform(F.col(side), lambda x, j: F.struct(F.lit(side).alias("side"), (j + 1).alias("d"), (F.col("_i") + sign * (j + 1)).alias("at"), _there(side, j + 1).alias("there")))
    return F.filter(at, lambda x: ~x["there"])
