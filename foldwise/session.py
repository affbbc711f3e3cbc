"""Session construction and lineage helpers.

Everything that materialises intermediate results goes through
:func:`materialize`, which writes a reliable checkpoint into the directory the
cluster names in ``spark.checkpoint.dir``.  A private directory is created only
when the setting is absent and the master is local (tests, benches).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "foldwise") -> SparkSession:
    """Build (or reuse) a session with the settings this library expects."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("FOLDWISE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only for local runs."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
    local = tempfile.mkdtemp(prefix="foldwise-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, store it reliably and cut its lineage.

    The rows are written as a parquet table under the checkpoint directory and
    read back: one job, fault tolerant (a lost executor costs a re-read, not a
    recomputation of the lineage), and the table's size is then known from
    file metadata.  Used for fitted parameter tables, fold tables and other
    intermediate results that several later stages consume.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "tables")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path for ``kind`` of files under the checkpoint directory, deleted by
    :func:`drop_materialized`."""
    path = os.path.join(checkpoint_dir(spark), kind, uuid.uuid4().hex)
    _WRITTEN.append(path)
    return path


_WRITTEN: list[str] = []


def drop_materialized(spark: SparkSession) -> int:
    """Delete the tables and files that this process has written to scratch paths
    and return their number.  For long-lived sessions: call it when every result
    that reads them has been consumed."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    n = len(_WRITTEN)
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(hadoop).delete(path, True)
    return n


def row_count_at_most(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows (counts at most limit+1 rows)."""
    return df.limit(limit + 1).count() <= limit


# Broadcast policy for parameter tables.  Spark's plan statistics give an
# upper bound of a table's size without running a job: for a materialised
# (parquet) table it is the size of its files, and filters or aggregations
# above it only keep or lower that bound.  Files are compressed, a hash table in
# memory is several times as large, so the limit leaves a wide margin.  Up to
# BROADCAST_MAX_BYTES the side is broadcast; above it the join is left to a
# shuffle join (AQE may still demote it to a broadcast at run time from the
# measured size).  Either way the result is the same.
BROADCAST_MAX_BYTES = 16 * 1024 * 1024


def size_upper_bound(df: DataFrame) -> int:
    """Optimizer's size estimate (bytes) of ``df``; for file scans the size of the
    (compressed) files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# fallback bound when plan statistics are not reachable (e.g. a Connect session)
BROADCAST_MAX_ROWS = 500_000


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint behind a size check that needs no Spark job (plan
    statistics); without them, behind a bounded row count."""
    from pyspark.sql import functions as F

    if hasattr(df, "_jdf"):
        small = size_upper_bound(df) <= max_bytes
    else:  # a Connect session has no plan statistics: count at most N+1 rows
        small = row_count_at_most(df, BROADCAST_MAX_ROWS)
    return F.broadcast(df) if small else df


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input volume.

    * scan splits of ``target_partition_bytes`` (parquet is columnar, so the
      bytes actually read per task are usually far fewer);
    * shuffle partitions so that a shuffle of the whole input lands at about
      the same size per partition, rounded up to a multiple of the cores;
    * AQE on, with coalescing and skew-join splitting, so partitions of the
      many small shuffles (parameter tables, contingency counts) collapse and
      a hot key of a shuffle join is split at run time.
    """
    cores = max(executors * cores_per_executor, 1)
    parts = max(cores, -(-input_bytes // target_partition_bytes))
    parts = -(-parts // cores) * cores
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
