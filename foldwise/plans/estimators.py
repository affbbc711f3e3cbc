"""``pyspark.ml`` wrappers so the fit/apply pairs compose in ``ml.Pipeline``.

``TransformPipeline(k)`` = feature row -> encoding -> top-k selection by a score
(mutual information unless a callable is given), all learned in ``fit`` from the
rows it is given.  ``k`` is an ml ``Param``, so a ``ParamGridBuilder`` can tune
it.  ``make_model_pipeline(estimator, k)`` appends any MLlib classifier.  The
fitted model exposes its parameter tables and output column names and is saved
as parquet tables plus ml metadata.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from ..operators.encode import EncoderParams, align_columns, encode_wide, fit_encoder, one_hot_union
from ..operators.features import (CATEGORICAL_COLUMNS, PASSTHROUGH_COLUMNS, SCALED_COLUMNS, FeatureParams, Roles,
                                  apply_features, fit_features)
from ..operators.models import baseline_logistic
from ..session import materialize
from ..sources.sinks import read_params, write_params
from .splits import KEY, score_features

# (clean rows, fitted encoder, roles, feature names) -> (feature, position, rank)
Score = Callable[[DataFrame, EncoderParams, Roles, list], DataFrame]
ALL = 0


def mutual_information_score(clean: DataFrame, encoder: EncoderParams, roles: Roles, names: list) -> DataFrame:
    return score_features(clean, roles, names)


class TransformPipelineModel(Model, MLWritable, MLReadable):
    def __init__(self, roles: Roles, features: FeatureParams, encoder: EncoderParams, selected: list[str], vector: bool):
        super().__init__()
        self.roles, self.features, self.encoder = roles, features, encoder
        self.selected, self.vector = selected, vector

    def get_feature_names_out(self) -> list[str]:
        return list(self.selected)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        r = self.roles
        keep = [KEY] + ([r.label] if r.label in dataset.columns else [])
        clean = apply_features(dataset, self.features, r, keep=[c for c in [r.label] if c in dataset.columns])
        wide = align_columns(encode_wide(clean, self.encoder, keep=keep), self.selected, keep=keep)
        if self.vector:
            wide = VectorAssembler(inputCols=self.selected, outputCol="features").transform(wide)
        return wide

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: TransformPipelineModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        extra = {"roles": asdict(m.roles), "selected": m.selected, "vector": m.vector,
                 "encoder": {k: list(getattr(m.encoder, k)) for k in ("scaled", "passthrough", "categorical")}}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=extra)
        write_params(m.features.tables(), f"{path}/features")
        write_params({"scale": m.encoder.scale, "categories": m.encoder.categories}, f"{path}/encoder")


class _ModelReader(MLReader):
    def load(self, path: str) -> TransformPipelineModel:
        spark = SparkSession.builder.getOrCreate()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        own = {k: tuple(v) if isinstance(v, list) else v for k, v in meta["roles"].items()}
        tables = read_params(spark, f"{path}/features", ["age", "fare", "port_mode", "prefixes", "fare_edges"])
        enc = read_params(spark, f"{path}/encoder", ["scale", "categories"])
        encoder = EncoderParams(enc["scale"], enc["categories"], *[tuple(meta["encoder"][k]) for k in ("scaled", "passthrough", "categorical")])
        model = TransformPipelineModel(Roles(**own), FeatureParams(**tables), encoder, list(meta["selected"]), meta["vector"])
        model._resetUid(meta["uid"])
        return model


class TransformPipeline(Estimator):
    """``make_transform_pipeline(k)``; ``k=None`` (or 0) keeps all features."""

    k = Param(Params._dummy(), "k", "number of selected features, 0 for all", typeConverter=TypeConverters.toInt)

    def __init__(self, roles: Roles = Roles(), k: int | None = None, vector: bool = False, score: Score = mutual_information_score):
        super().__init__()
        self.roles, self.vector, self.score = roles, vector, score
        self._setDefault(k=ALL)
        self._set(k=k or ALL)

    def _fit(self, dataset: DataFrame) -> TransformPipelineModel:
        r, k = self.roles, self.getOrDefault(self.k)
        fp = fit_features(dataset, r)
        clean = materialize(apply_features(dataset, fp, r, keep=[r.label]))
        enc = fit_encoder(clean, SCALED_COLUMNS, PASSTHROUGH_COLUMNS, CATEGORICAL_COLUMNS)
        names = list(SCALED_COLUMNS) + list(PASSTHROUGH_COLUMNS) + [f"{c}_{v}" for c, v in one_hot_union(enc)]
        ranked = self.score(clean, enc, r, names).collect()      # one row per feature
        chosen = [x for x in ranked if k == ALL or x["rank"] <= k]
        selected = [x["feature"] for x in sorted(chosen, key=lambda x: x["position"])]
        return TransformPipelineModel(r, fp, enc, selected, self.vector)


def make_model_pipeline(roles: Roles = Roles(), estimator=None, k: int | None = None,
                        n_rows: int = 1, score: Score = mutual_information_score) -> Pipeline:
    """Features -> encoding -> selection -> classifier, as one ``ml.Pipeline``."""
    est = estimator or baseline_logistic(label=roles.label, n_rows=n_rows)
    return Pipeline(stages=[TransformPipeline(roles, k, vector=True, score=score), est])
