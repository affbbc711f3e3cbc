"""Table sources: parquet test tables and schema-checked CSV scans."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; column pruning and filters reach the parquet scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV scan with an explicit schema.

    ``enforceSchema=False`` makes Spark compare the header with the schema and
    fail on a mismatch; a missing path fails at analysis time.  Quoted empty
    strings read as NULL, like pandas' ``read_csv``.
    """
    return (spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .csv(path))


def load_train_test(spark: SparkSession, train_path: str, test_path: str,
                    schema: StructType, label: str) -> tuple[DataFrame, DataFrame]:
    """Paired scan; the test file has the same schema without the label."""
    test_schema = StructType([f for f in schema.fields if f.name != label])
    train = load_csv(spark, train_path, schema)
    test = load_csv(spark, test_path, test_schema)
    from ..functions.exprs import safe_cast
    return train.withColumn(label, safe_cast(label, "int")), test
