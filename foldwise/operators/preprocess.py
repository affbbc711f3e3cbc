"""The earlier code line: configurable preprocessor
and the batch feature set ``create_all_features`` (F23, P8).

Decisions on the reference's defects (see README): the group-median fallback
is the true overall median; quantile bins are learned in ``fit`` and frozen;
unseen labels encode as -1; exactly the fitted numeric columns are scaled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import materialize, sized_broadcast
from .features import Roles
from .fit import mean_std, mode, quantile_edges, tiered_quantile
from .lookup import join_params, apply_tiered
from .ranks import global_index

FARE_BINS = 5
EMBARKED_DEFAULT = "S"
MISSING_CLASS = "missing"


@dataclass
class SrcParams:
    age: DataFrame | None       # (_tier, _title, sex, cls, median)
    fare_median: DataFrame      # (median)
    port_mode: DataFrame        # (mode)
    labels: DataFrame | None    # (column, value, code)
    scale: DataFrame | None     # (feature, mean, std)
    fare_edges: DataFrame       # (edges)
    scaled: tuple
    flags: dict


def _src_title(r: Roles):
    return X.title_src(r.name).alias("_title")


def fit_src(train: DataFrame, r: Roles, fill_age_by_group: bool = True, encode_categorical: bool = True,
            scale_features: bool = True, extract_deck: bool = True) -> SrcParams:
    """E10 fit: every statistic from ``train`` only."""
    # every statistic below reads these columns: worked out once, not once per statistic
    read = [c for c in dict.fromkeys([r.cls, r.sex, r.age, r.sibsp, r.parch, r.fare, r.embarked]) if c in train.columns]
    d = materialize(X.nan_as_null(train, r.raw_features()).select(*read, _src_title(r)))
    age = None
    if fill_age_by_group:
        age = materialize(tiered_quantile(d, [["_title", r.sex, r.cls], []], r.age))
    fare = materialize(tiered_quantile(d, [[]], r.fare).select("median"))
    port = materialize(mode(d, r.embarked))
    labels = None
    if encode_categorical:
        # sorted distinct classes of both columns, numbered 0.. per column with
        # the skew-safe global index (no single-task window over all values)
        vals = d.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"),
                     F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CLASS)).alias("value"))
            for c in (r.sex, r.embarked)])).alias("_s")).select("_s.*").distinct()
        labels = materialize(global_index(vals, ["value"], group_by=["column"], out="code")
                             .withColumn("code", F.col("code").cast("int")))
    filled = _fill(d, r, age, fare, port)
    scaled = (r.cls, r.age, r.sibsp, r.parch, r.fare)
    scale = materialize(mean_std(filled, list(scaled))) if scale_features else None
    edges = materialize(quantile_edges(filled, r.fare, FARE_BINS))
    flags = dict(fill_age_by_group=fill_age_by_group, encode_categorical=encode_categorical,
                 scale_features=scale_features, extract_deck=extract_deck)
    return SrcParams(age, fare, port, labels, scale, edges, scaled if scale_features else (), flags)


def _fill(d: DataFrame, r: Roles, age, fare, port) -> DataFrame:
    t = d
    if age is not None:
        t = apply_tiered(t, age, [["_title", r.sex, r.cls], []], r.age, "_age_f")
        t = t.withColumn(r.age, F.col("_age_f")).drop("_age_f")
    t = join_params(t, fare, [], "_fm_", ["median"])
    t = join_params(t, port, [], "_pm_", ["mode"])
    t = t.withColumn(r.fare, F.coalesce(F.col(r.fare).cast("double"), F.col("_fm_median")))
    t = t.withColumn(r.embarked, F.coalesce(F.col(r.embarked), F.col("_pm_mode"), F.lit(EMBARKED_DEFAULT)))
    return t.drop("_fm_median", "_pm_mode")


def transform_src(df: DataFrame, p: SrcParams, r: Roles) -> DataFrame:
    """E10 transform: title, deck, fills, label codes, family features, frozen
    fare bins, coded age bands, then standardisation of the fitted columns."""
    t = _fill(X.nan_as_null(df, r.raw_features()).select("*", _src_title(r)), r, p.age, p.fare_median, p.port_mode)
    t = t.withColumnRenamed("_title", "Title")
    if p.flags["extract_deck"]:
        t = t.withColumn("Deck", X.first_letter(r.cabin, X.SRC_CABIN_MISSING))
    if p.labels is not None:
        for c in (r.sex, r.embarked):
            codes = sized_broadcast(p.labels.where(F.col("column") == c).select(
                F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"{c}_encoded")))
            key = F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CLASS))
            t = t.join(codes, key == F.col(f"_v_{c}"), "left").drop(f"_v_{c}") \
                 .withColumn(f"{c}_encoded", F.coalesce(F.col(f"{c}_encoded"), F.lit(-1)).cast("int"))
    fam = X.family_size(r.sibsp, r.parch)
    t = t.withColumn("FamilySize", fam).withColumn("IsAlone", X.flag(fam == 1))
    t = join_params(t, p.fare_edges, [], "_fe_", ["edges"])
    t = t.withColumn("FareBin", F.coalesce(X.learned_bin_code(r.fare, F.col("_fe_edges"), FARE_BINS - 1),
                                           F.lit(X.SRC_FARE_BIN_DEFAULT)).cast("int")).drop("_fe_edges")
    t = t.withColumn("AgeBand", X.cut_right(r.age, X.SRC_AGE_CODE_EDGES, list(range(5)),
                                            X.SRC_AGE_CODE_DEFAULT).cast("int"))
    if p.scale is not None:
        wide = p.scale.groupBy().agg(*[a for c in p.scaled for a in (
            F.max(F.when(F.col("feature") == c, F.col("mean"))).alias(f"_mu_{c}"),
            F.max(F.when(F.col("feature") == c, F.col("std"))).alias(f"_sd_{c}"))])
        t = t.crossJoin(F.broadcast(wide))             # one row
        for c in p.scaled:
            sd = F.col(f"_sd_{c}")
            t = t.withColumn(c, (F.col(c) - F.col(f"_mu_{c}")) /
                             F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd))
        t = t.drop(*[f"_{m}_{c}" for c in p.scaled for m in ("mu", "sd")])
    return t


def create_all_features(df: DataFrame, r: Roles, family: bool = True, title: bool = True,
                        fare_bins: bool = True, age_bands: bool = True, deck: bool = True,
                        interactions: bool = True) -> DataFrame:
    """The batch feature set with optional groups.

    This is a profiling operator: fare quintiles and the fill medians are
    computed on ``df`` itself (one-row aggregates joined back), as the
    original did; use :func:`fit_src` / :func:`transform_src` for models.
    """
    t = X.nan_as_null(df)
    if title:
        t = t.withColumn("Title", X.title_src(r.name))
    if family:
        fam = X.family_size(r.sibsp if r.sibsp in df.columns else None, r.parch if r.parch in df.columns else None)
        t = t.withColumn("FamilySize", fam).withColumn("IsAlone", X.flag(fam == 1))
    from .quantiles import grouped_quantiles
    fare_med = grouped_quantiles(t, [], r.fare, [0.5]).withColumnRenamed("q0", "_fare_med")
    age_med = grouped_quantiles(t, [], r.age, [0.5]).withColumnRenamed("q0", "_age_med")
    t = t.crossJoin(F.broadcast(fare_med)).crossJoin(F.broadcast(age_med))   # one row each
    fare_f = F.coalesce(F.col(r.fare).cast("double"), F.col("_fare_med"))
    age_f = F.coalesce(F.col(r.age).cast("double"), F.col("_age_med"))
    if fare_bins:
        t = t.withColumn("_fare_f", fare_f)
        edges = quantile_edges(t, "_fare_f", FARE_BINS)
        t = t.crossJoin(F.broadcast(edges))            # one row
        code = X.learned_bin_code("_fare_f", F.col("edges"))
        labels = F.array(*[F.lit(v) for v in X.SRC_FARE_BIN_LABELS])
        t = t.withColumn("FareBin", labels[code]).drop("edges", "_fare_f")
    if age_bands:
        t = t.withColumn("AgeBand", X.cut_right(age_f, X.SRC_AGE_BAND_EDGES, X.SRC_AGE_BAND_LABELS))
    if deck:
        t = t.withColumn("Deck", X.first_letter(r.cabin, X.SRC_CABIN_MISSING))
    if interactions:
        t = t.withColumn("Sex_Pclass", X.interaction(r.sex, r.cls, "_"))
        if title:
            t = t.withColumn("Title_Pclass", X.interaction("Title", r.cls, "_"))
        t = t.withColumn("Age_x_Pclass", age_f * F.col(r.cls))
        if family:
            t = t.withColumn("FamilySize_x_Pclass", F.col("FamilySize") * F.col(r.cls))
    return t.drop("_fare_med", "_age_med")
