"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, sized_broadcast
from ..sources.tables import table

__all__ = ["batches_of", "byte_texts", "documents", "materialize", "pieces", "shuffle_partitions", "sized_broadcast", "table", "under_plain_names",
           "with_own_names", "words_table"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def under_plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named c0, c1, ... and the new name of each, so that no
    name of the caller's can clash with a working column."""
    own = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]), own


def with_own_names(result: DataFrame, df: DataFrame) -> DataFrame:
    """The columns c0, c1, ... of ``result`` under the names of ``df`` again."""
    return result.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, NULL as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def batches_of(texts: Sequence[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges [i, j) of about ``limit`` bytes; one longer text stands alone."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= limit):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


PIECE = 4 << 20  # bytes of rows that a task works on at once


def pieces(batches: Iterator[pa.RecordBatch], limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of about ``limit`` bytes."""
    for batch in batches:
        step = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def words_table(keep: bytes) -> bytes:
    """Translation table for ``bytes.translate``: A-Z lower-cased, every byte
    outside ``keep`` and below 0x80 turned into a space, so that ``split()``
    gives the words of ``[keep, non-ASCII]+``."""
    out = bytearray(b" " * 256)
    for b in range(0x80, 0x100):
        out[b] = b
    for b in keep:
        out[b] = b
    for upper, lower in zip(range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1)):
        out[upper] = out[lower]
    return bytes(out)
