"""Sinks (S4-S12): tables, reports, parameters, predictions, models, checksums.

Large tables are written as partitioned files (never gathered into one);
only report tables that are small by construction are coalesced to one file.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .checksums import file_checksums  # noqa: F401  (S12)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Clean / model-ready tables; CSV with a header, no index column."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small report table as one CSV file (coalesce(1): the table is tiny)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def _spelled(value: Column, kind: T.DataType) -> Column:
    """A value for :func:`write_params_json`: what JSON numbers can't say is spelled out."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _spelled(x, kind.elementType))
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return value
    inf = float("inf")
    return F.parse_json(F.when(value == inf, '"inf"').when(value == -inf, '"-inf"').when(F.isnan(value), '"nan"')
                        .when(value.cast("string") == "-0.0", '"-0.0"').otherwise(value.cast("string")))


def _as_text(kind: T.DataType) -> T.DataType:
    """The type that a JSON value is read as before it gets its own."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return T.StringType() if isinstance(kind, (T.DoubleType, T.FloatType)) else kind


def write_params_json(tables: dict[str, DataFrame], path: str) -> None:
    """Each parameter table as JSON lines under ``path/<name>`` with its schema beside
    it, written by the executors (nothing is collected, whatever the number of groups)."""
    for name, df in tables.items():
        row = F.struct(*[_spelled(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])
        df.select(F.to_json(row).alias("value")).write.mode("overwrite").text(f"{path}/{name}")
        df.sparkSession.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}.schema")


def read_params_json(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    """The tables that :func:`write_params_json` has written, with their own schemas."""
    out = {}
    for name in names:
        schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/{name}.schema").first()["value"]))
        plain = T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in schema])
        row = F.from_json("value", plain, {"mode": "FAILFAST"})
        out[name] = spark.read.text(f"{path}/{name}").select(row.alias("r")).select(*[F.col("r").getField(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return out


def write_params(tables: dict[str, DataFrame], path: str) -> None:
    """Each parameter table as parquet under ``path/<name>`` (reload with
    :func:`read_params`)."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def read_params(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def write_predictions(df: DataFrame, path: str) -> None:
    """``(key, fold, prediction)`` rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One value per line (selected feature names; small)."""
    df.select(F.col(column).cast("string")).coalesce(1).write.mode("overwrite").text(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
