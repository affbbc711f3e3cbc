"""Encoding of the clean feature row.

The scale-safe core is the *long* form ``(keys..., feature, value)``: scaled
measures, passthrough numbers, and one row per one-hot feature that is 1
(unknown or NULL categories produce no row = all zeros, no dropped level).
The *wide* form is a generated ``select`` over the learned category list,
which is small by construction (rare categories are pooled before).

Feature names follow ``<column>_<category>`` for one-hot columns, in the order
scaled, passthrough, one-hot (columns in the given order, categories sorted).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path, sized_broadcast
from .fit import category_lists, mean_std


@dataclass
class EncoderParams:
    scale: DataFrame        # (by..., feature, mean, std)
    categories: DataFrame   # (by..., feature, category, position)
    scaled: tuple
    passthrough: tuple
    categorical: tuple
    by: tuple = ()


def fit_encoder(train: DataFrame, scaled: Sequence[str], passthrough: Sequence[str],
                categorical: Sequence[str], by: Sequence[str] = ()) -> EncoderParams:
    """A24 + A25 on the training rows: population mean/std and category lists."""
    by = tuple(by)
    scale = materialize(mean_std(train, list(scaled), by=by))
    cats = materialize(category_lists(train, list(categorical), by=by))
    return EncoderParams(scale, cats, tuple(scaled), tuple(passthrough), tuple(categorical), by)


def _scaled_expr(c: str):
    # zero (or undefined) deviation -> scale 1, as scikit-learn's StandardScaler
    std = F.col(f"_sd_{c}")
    den = F.when(std.isNull() | (std == 0), F.lit(1.0)).otherwise(std)
    return (F.col(c) - F.col(f"_mu_{c}")) / den


def _with_scale_params(df: DataFrame, p: EncoderParams) -> DataFrame:
    if not p.scaled:
        return df
    by = list(p.by)
    wide = p.scale.groupBy(*by).agg(*[
        agg for c in p.scaled for agg in (
            F.max(F.when(F.col("feature") == c, F.col("mean"))).alias(f"_mu_{c}"),
            F.max(F.when(F.col("feature") == c, F.col("std"))).alias(f"_sd_{c}"))])
    wide = sized_broadcast(wide)
    return df.join(wide, by, "left") if by else df.crossJoin(wide)


def encode_long(df: DataFrame, p: EncoderParams, keys: Sequence[str]) -> DataFrame:
    """E1+E3+E4 long form ``(keys..., by..., feature, value)``."""
    by = list(p.by)
    keys = [k for k in keys if k not in by]
    t = _with_scale_params(df, p)
    numeric = [F.struct(F.lit(c).alias("feature"), _scaled_expr(c).cast("double").alias("value"))
               for c in p.scaled]
    numeric += [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                for c in p.passthrough]
    cats = [F.struct(F.lit(c).alias("cfeature"), F.col(c).cast("string").alias("category"))
            for c in p.categorical]
    num_long = t.select(*keys, *by, F.explode(F.array(*numeric)).alias("_s")).select(*keys, *by, "_s.*")
    cat_rows = t.select(*keys, *by, F.explode(F.array(*cats)).alias("_s")).select(*keys, *by, "_s.*")
    known = sized_broadcast(p.categories.select(*by, F.col("feature").alias("cfeature"), "category"))
    hot = (cat_rows.join(known, [*by, "cfeature", "category"], "inner")
           .select(*keys, *by, F.concat_ws("_", "cfeature", "category").alias("feature"),
                   F.lit(1.0).alias("value")))
    return num_long.unionByName(hot)


def one_hot_union(p: EncoderParams) -> list[tuple[str, str]]:
    """All ``(column, category)`` pairs over every ``by`` group, sorted per column
    by the native order of the categories."""
    rows = p.categories.groupBy("feature", "category").agg(F.min("position").alias("position")).collect()
    out = []
    for c in p.categorical:
        cats = sorted((r["position"], r["category"]) for r in rows if r["feature"] == c)
        seen = []
        for _, cat in cats:
            if cat not in seen:
                seen.append(cat)
        out += [(c, cat) for cat in seen]
    return out


def encode_wide(df: DataFrame, p: EncoderParams, keep: Sequence[str],
                one_hot: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """E1-E4 wide form: ``keep`` columns then one DOUBLE column per feature.

    One-hot columns compare with the learned category; a category unseen in
    training is all zeros.  With ``by``, a category learned by another group
    only is zero for this group's rows (the value must also be in this group's
    list), so every group sees exactly its own feature space.
    """
    by = list(p.by)
    one_hot = list(one_hot) if one_hot is not None else one_hot_union(p)
    t = _with_scale_params(df, p)
    if by:
        # a row's value is looked up once per column in its group's learned list
        lists = p.categories.groupBy(*by, "feature").agg(F.collect_set("category").alias("_cats"))
        maps = lists.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("feature", "_cats"))).alias("_known"))
        t = t.join(sized_broadcast(materialize(maps)), by, "left")
        t = t.withColumns({f"_in_{c}": F.coalesce(F.array_contains(F.col("_known")[c], F.col(c).cast("string")), F.lit(False))
                           for c in p.categorical})
    cols = [F.col(k) for k in dict.fromkeys([*keep, *by])]
    cols += [_scaled_expr(c).cast("double").alias(c) for c in p.scaled]
    cols += [F.col(c).cast("double").alias(c) for c in p.passthrough]
    for c, cat in one_hot:
        hit = F.col(c).cast("string") == F.lit(cat)
        if by:
            hit = hit & F.col(f"_in_{c}")
        cols.append(F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{cat}"))
    return t.select(*cols)


def align_columns(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Select ``names`` in order; a column the batch lacks becomes 0.0 and
    NULLs become 0.0 (the fitted list decides the schema, not the batch)."""
    present = set(df.columns)
    cols = [F.col(k) for k in keep]
    cols += [F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) if n in present
             else F.lit(0.0).alias(n) for n in names]
    return df.select(*cols)


# ---- sparse form: no category reaches the driver, no column is made for one --------

def dictionary(p: EncoderParams) -> DataFrame:
    """``(feature, category, id)`` of every encoded column, stored: the numeric columns in
    order (category NULL), then the categories by column and position.  The driver sees
    one number per column."""
    if p.by:
        raise ValueError("a dictionary is made for one training set")
    spark = p.categories.sparkSession
    numeric = [*p.scaled, *p.passthrough]
    sizes = {r["feature"]: r["n"] for r in p.categories.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, at = {}, len(numeric)
    for c in p.categorical:
        starts[c], at = at, at + sizes.get(c, 0)
    start = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("feature")) if starts else F.lit(0)
    listed = p.categories.select("feature", "category", (start + F.col("position")).cast("int").alias("id"))
    plain = spark.createDataFrame([(c, None, i) for i, c in enumerate(numeric)], "feature string, category string, id int")
    return materialize(plain.unionByName(listed))


def encode_sparse(df: DataFrame, p: EncoderParams, ids: DataFrame, keep: Sequence[str]) -> DataFrame:
    """E1-E4 sparse form: ``keep`` columns, ``size``, ``indices`` (rising) and ``values`` of
    the encoded row; zeros, NULLs and categories that the dictionary lacks have no entry.

    Every categorical column looks its id up in the dictionary once: broadcast behind a
    check of that column's size, else a shuffle join, which Spark splits where a
    category is hot."""
    width = ids.agg(F.max("id")).first()[0]
    t = _with_scale_params(df, p)
    for i, c in enumerate(p.categorical):
        own = materialize(ids.where(F.col("feature") == c).select(F.col("category").alias(f"_c{i}"), F.col("id").alias(f"_id{i}")))
        t = t.join(sized_broadcast(own), F.col(c).cast("string") == F.col(f"_c{i}"), "left")
    cells = [F.struct(F.lit(i).alias("i"), e.cast("double").alias("v")) for i, e in
             enumerate([*[_scaled_expr(c) for c in p.scaled], *[F.col(c) for c in p.passthrough]])]
    cells += [F.struct(F.col(f"_id{i}").alias("i"), F.lit(1.0).alias("v")) for i in range(len(p.categorical))]
    held = F.filter(F.array(*cells), lambda x: x["i"].isNotNull() & F.coalesce(x["v"] != 0, F.lit(False)))  # ids rise with the columns
    return t.select(*keep, F.lit(0 if width is None else width + 1).alias("size"), held.alias("_e")).select(
        *keep, "size", F.transform("_e", lambda x: x["i"]).alias("indices"), F.transform("_e", lambda x: x["v"]).alias("values"))


def as_sparse_vectors(encoded: DataFrame, keep: Sequence[str], out: str = "features") -> DataFrame:
    """``keep`` columns and an ML vector column, stored.  The vector's own storage form is
    written and read back under its type, so no row passes through Python."""
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    spark, path = encoded.sparkSession, scratch_path(encoded.sparkSession, "vectors")
    form = F.struct(F.lit(0).cast("byte").alias("type"), "size", "indices", "values")
    plain = encoded.select(*keep, form.alias(out))
    plain.write.parquet(path)
    return spark.read.schema(T.StructType([*[plain.schema[c] for c in keep], T.StructField(out, VectorUDT())])).parquet(path)
