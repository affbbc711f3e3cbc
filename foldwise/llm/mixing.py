"""Mixing sources to target weights (DataFrame and SQL functions only).

Tokens are aggregated per source, targets are shared out by weight and turned
into repetition rates, and every document is emitted ``floor(rate)`` times plus
one more time with probability ``rate - floor(rate)``, decided by a hash of a seed,
its identifier, its text and its number among equal rows, so that reruns agree and
rows that share an identifier (or have none) are drawn independently.

Defined results: NULL or empty text has size 0 and is never over-counted; a
NULL source is a source of its own, last in the order; repeated rows are numbered
and drawn one by one (which of them gets which number makes no difference); a source
without tokens has target 0 and its documents are not emitted; an empty table gives an
empty mix.  The caller's columns ride along in one struct, so their names cannot clash.
The order of the sources is found in one task: they are taken to be tens to a million
named corpora, not one per page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sized_broadcast

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_REPEAT = 2
SEED = 17


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
                   max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Sources in code-point order, NULL last, take the weights in turn.  A budget
    of ``budget`` times all tokens is shared by weight; a source stops at
    ``max_repeat`` times its own size and the excess is shared again.  The fixed
    point is ``min(cap, level * weight)``: going up the ratio cap / weight,
    sources fill up until the level left for the rest is below the next ratio.
    The windows run over one row per source, after the aggregation.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(in_order)
    pick = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (per_source.withColumn("place", place)
              .withColumn("weight", F.element_at(pick, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
              .withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    everything = Window.partitionBy()
    rising = Window.orderBy("ratio", "place")
    level = ((F.lit(float(budget)) * F.sum("source_size").over(everything)
              - F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)))
    levelled = ranked.withColumn("level", level)
    open_level = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))).over(everything)["level"]
    target = F.when(F.col("open_level").isNull() | (F.col("ratio") <= F.col("open_level")), F.col("cap")) \
        .otherwise(F.col("open_level") * F.col("weight"))
    return (levelled.withColumn("open_level", open_level)
            .withColumn("target", target)
            .select("source", "source_size", "target",
                    F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate")))


def numbered(rows: DataFrame, same: Column) -> DataFrame:
    """``rows`` plus ``nth``, a number from 1 among the rows with an equal hash
    ``same``.  Only rows that repeat are shuffled, by (hash, partition of the scan), so
    a hash that a third of all rows have is numbered in pieces; the pieces' sizes, one
    row each, give the offsets."""
    tagged = rows.withColumn("mix_same", same)
    again = materialize(tagged.groupBy("mix_same").agg(F.count("*").alias("mix_n")).where("mix_n > 1").select(F.col("mix_same").alias("mix_of")))
    on = F.col("mix_same") == F.col("mix_of")
    alone = tagged.join(sized_broadcast(again), on, "left_anti").withColumn("nth", F.lit(1).cast("long"))
    place = tagged.withColumn("mix_part", F.spark_partition_id()).withColumn("mix_place", F.monotonically_increasing_id())
    repeated = materialize(place.join(sized_broadcast(again), on, "left_semi"))
    piece = repeated.withColumn("mix_in", F.row_number().over(Window.partitionBy("mix_same", "mix_part").orderBy("mix_place")))
    before = Window.partitionBy("mix_same").orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = repeated.groupBy("mix_same", "mix_part").agg(F.count("*").alias("mix_n"))
    offsets = sizes.select("mix_same", "mix_part", F.coalesce(F.sum("mix_n").over(before), F.lit(0)).alias("mix_before"))
    counted = piece.join(offsets, ["mix_same", "mix_part"]).withColumn("nth", F.col("mix_before") + F.col("mix_in"))
    return alone.unionByName(counted.select(*alone.columns)).drop("mix_same")


def same_row(key: Column, text_md5: Column, source: Column) -> Column:
    return F.xxhash64(key, text_md5, source)


def text_digest(text: str) -> Column:
    return F.coalesce(F.md5(F.col(text)), F.lit(""))


def copies_of(key: Column, digest: Column, nth: Column, rate: Column, seed: int = SEED) -> Column:
    """floor(rate) plus one copy with probability frac(rate): the first 52 bits
    of md5(seed | key | digest | nth) as a fraction of 2^52 are compared with the fraction."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")), digest, nth.cast("string")))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("long")


def _with_rates(docs: DataFrame, targets: DataFrame, source: str, prefix: str) -> DataFrame:
    renamed = targets.select(*[F.col(c).alias(prefix + c) for c in targets.columns])
    return docs.join(sized_broadcast(renamed), docs[source].eqNullSafe(renamed[prefix + "source"]), "left")


def plan_mix(docs: DataFrame, seed: int = SEED, **rules) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = materialize(docs.select("doc_id", "source", n_words("text").alias("size"), text_digest("text").alias("digest")))
    targets = materialize(source_targets(sizes, **rules))
    rows = numbered(sizes, same_row(F.col("doc_id"), F.col("digest"), F.col("source")))
    rated = _with_rates(rows, targets, "source", "_")
    return (rated.withColumn("copies", copies_of(F.col("doc_id"), F.col("digest"), F.col("nth"), F.col("_rate"), seed))
            .select("doc_id", "source", "size", F.col("_source_size").alias("source_size"),
                    F.col("_target").alias("target"), "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, seed: int = SEED, copy_column: str = "copy", **rules) -> DataFrame:
    """The mixture itself: every column of ``docs``, one row per emitted copy,
    numbered from 1 in ``copy_column`` (which replaces a column of that name)."""
    targets = materialize(source_targets(docs.select("source", n_words("text").alias("size")), **rules))
    own = [F.col(f"`{c}`") for c in docs.columns if c != copy_column]
    rows = docs.select(F.struct(*own).alias("row"), F.col("doc_id").alias("key"), "source", text_digest("text").alias("digest"))
    rated = _with_rates(numbered(rows, same_row(F.col("key"), F.col("digest"), F.col("source"))), targets, "source", "of_")
    copies = rated.withColumn("copies", copies_of(F.col("key"), F.col("digest"), F.col("nth"), F.col("of_rate"), seed)).where("copies > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth_copy")) \
        .select("row.*", F.col("nth_copy").alias(copy_column))


def query(spark, sf_dir):
    from .common import documents
    planned = plan_mix(documents(spark, sf_dir))
    return planned.select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size, coalesce(md5(text), '') AS digest,
    row_number() OVER (PARTITION BY doc_id, text, source) AS nth FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place, 2.0::DOUBLE * source_size AS cap FROM per_source),
weighted AS (
  SELECT *, (CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight FROM ranked),
levelled AS (
  SELECT *, cap / weight AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER ()
     - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
opened AS (SELECT *, (SELECT arg_min(level, (ratio, place)) FROM levelled WHERE ratio > level) AS open_level FROM levelled),
targets AS (
  SELECT source, source_size, CASE WHEN open_level IS NULL OR ratio <= open_level THEN cap ELSE open_level * weight END AS target
  FROM opened),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    CAST('0x' || substr(md5(concat_ws('|', '17', coalesce(CAST(d.doc_id AS VARCHAR), ''), d.digest, CAST(d.nth AS VARCHAR))), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM rated)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM counted
"""
