"""Frozen parameters applied to a stream (optional extra of the survey, §2.12).

Apply is stateless once parameters are learned, so a stream is transformed by
the same expressions and stream-static broadcast joins as a batch.  The
driver's tables are single parquet files; a file-source stream reads them
through ``pathGlobFilter`` on their folder, one file per trigger.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


def file_stream(spark: SparkSession, folder: str, file_glob: str, schema) -> DataFrame:
    """A streaming DataFrame over the parquet files of ``folder`` matching ``file_glob``."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", 1).parquet(folder))


def drain_to_table(stream: DataFrame, name: str | None = None) -> DataFrame:
    """Run a streaming query until its source is exhausted (append mode, a
    reliable checkpoint under the session's checkpoint directory) and return
    the written rows as a batch DataFrame read from the parquet sink."""
    spark = stream.sparkSession
    name = name or f"stream_{uuid.uuid4().hex[:8]}"
    base = os.path.join(checkpoint_dir(spark), "streams", name)
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{base}/_checkpoint").option("path", f"{base}/data")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/data")
