"""Integer vectors shared by the vector operators.

A float vector becomes the integers ``floor(scale * x)`` (``x`` taken as double).
Kept rows get ``rid``, an identifier of the row itself, so that repeated or NULL
identifiers never merge two rows.  Vectors are stored flat, as little-endian
integers of the narrowest width that holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

# larger integers would leave a squared distance or inner product outside a long
MAX_COMPONENT = 1 << 27
WIDTHS = ((1 << 7, "<i1"), (1 << 15, "<i2"), (1 << 31, "<i4"))


def packed(values: np.ndarray) -> bytes:
    """Integers as bytes of the narrowest width that holds them all."""
    top = int(np.abs(values).max(initial=0))
    return values.astype(next((kind for limit, kind in WIDTHS if top < limit), "<i8")).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    """``n`` integers from :func:`packed` bytes."""
    return np.frombuffer(data, f"<i{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def integer_rows(df: DataFrame, scale: int, vector: str, carry: dict[str, str]) -> DataFrame:
    """(rid, carry..., dims, top, v) of the rows whose vector is usable, stored once.

    ``carry`` maps new names to columns of ``df``.  Rows are left out when the
    vector is NULL or empty, or has a NULL or non-finite component, or one whose
    integer is beyond ``MAX_COMPONENT`` in size.  ``v`` is the packed vector, ``top``
    the size of its largest component.
    """
    own = df.select(F.monotonically_increasing_id().alias("rid"), *[F.col(c).alias(n) for n, c in carry.items()],
                    F.col(vector).cast("array<double>").alias("x"))
    kept = own.where((F.size("x") > 0) & F.forall("x", lambda e: F.coalesce(F.abs(e) < float(MAX_COMPONENT) / scale, F.lit(False))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            flat, ends = np.floor(scale * x.flatten().to_numpy(zero_copy_only=False)).astype(np.int64), np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False))
            rows = np.split(flat, ends[:-1]) if len(ends) else []
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("rid", *carry)], x.value_lengths().cast(pa.int32()),
                                              pa.array([int(np.abs(r).max()) for r in rows], pa.int64()), pa.array([packed(r) for r in rows], pa.binary())],
                                             names=["rid", *carry, "dims", "top", "v"])

    schema = T.StructType([f for f in kept.schema if f.name != "x"] + [
        T.StructField("dims", T.IntegerType()), T.StructField("top", T.LongType()), T.StructField("v", T.BinaryType())])
    return materialize(kept.mapInArrow(run, schema))
