"""SHA-256 of files of any size.

A digest is sequential, but its unfinished state is 112 bytes.  Small files are read whole.  Larger
ones are read in the scan's own splits, stored as numbered pieces, and hashed in rounds: in a round
one task per file goes on with the file's state over the next ``SPAN`` bytes, and the states are
stored for the next round.  So no row holds a file and no task reads more than a round's pieces.

Spark reads bytes in splits by its text source only: a file's lines, ended by ``\\n`` alone, with
the start of their split.  What that source hides (a byte-order mark, whether the last line is
ended) follows from the file's length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

WHOLE = 64 << 20  # bytes of a file that is read as one row
SPAN = 128 << 20  # bytes of a file that a round hashes
PIECE = 256 << 10  # bytes of a stored row
CODED = r"(?i)\.(gz|bz2|deflate|snappy|lz4|zst|zstd)$"  # what the text source would unpack: read whole
MARK = b"\xef\xbb\xbf"
CONTEXT = 112  # bytes of an unfinished SHA-256 in libcrypto: SHA256_CTX


def sha256_library() -> ctypes.CDLL | None:
    """The library behind ``hashlib``, whose unfinished digests can be stored; None without it."""
    try:
        import _hashlib
        lib = ctypes.CDLL(_hashlib.__file__)
        lib.SHA256_Init, lib.SHA256_Update, lib.SHA256_Final  # noqa: B018
        return lib
    except (ImportError, AttributeError, OSError):
        return None


class Unfinished:
    """A SHA-256 that goes on from a stored state."""

    def __init__(self, state: bytes | None = None):
        self.lib = sha256_library()
        self.context = ctypes.create_string_buffer(state or b"", CONTEXT)
        if state is None:
            self.lib.SHA256_Init(self.context)

    def update(self, data: bytes) -> None:
        self.lib.SHA256_Update(self.context, data, ctypes.c_size_t(len(data)))

    def state(self) -> bytes:
        return self.context.raw

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        self.lib.SHA256_Final(out, ctypes.create_string_buffer(self.context.raw, CONTEXT))
        return out.raw.hex()


def _pieces(size: int):
    """Lines (path, start of their split, line) in file order, to rows (path, start, no, n, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, no, buffer = None, 0, bytearray()
        out = []

        def cut(rest: bool) -> None:
            nonlocal no
            while len(buffer) >= size or (rest and buffer):
                body = bytes(buffer[:size])
                del buffer[:size]
                out.append((*now, no, len(body), body))
                no += 1

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 5
            out.clear()
            kinds = {"path": pa.string(), "start": pa.int64(), "no": pa.int32(), "n": pa.int64(), "body": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))

        for batch in batches:
            if batch.num_rows == 0:
                continue
            path, start, line = (batch.column(c) for c in ("path", "start", "line"))
            other = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1]))
            edges = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                own = path[a].as_py(), start[a].as_py()
                if own != now:
                    cut(True)
                    now, no = own, 0
                buffer += b"\n".join(line[a:b].to_pylist()) + b"\n"
                cut(False)
            yield rows()
        cut(True)
        yield rows()

    return run


STATE = "path string, length long, mark boolean, done long, body binary"


def _go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per path its state, then pieces in file order, to the state after them."""
    names = ["path", "length", "mark", "done", "body"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
    out, held = [], None

    def close() -> None:
        if held is not None:
            out.append((*held[:4], held[4].state()))

    for batch in batches:
        for path, start, length, mark, done, body in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "length", "mark", "done", "body")]):
            if start < 0:
                close()
                held = [path, length, mark, done, Unfinished(body)]
                if body is None and mark:
                    held[4].update(MARK)
                    held[3] = len(MARK)
                continue
            if held is None or held[0] != path:
                raise ValueError(f"a piece of {path} without the file's state")
            body = body[:held[1] - held[3]]  # the last line's end is added by the reading
            held[4].update(body)
            held[3] += len(body)
    close()
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, kinds)], names=names)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, length, done in zip(*[batch.column(c).to_pylist() for c in ("path", "length", "done")]):
            if length != done:
                raise ValueError(f"{done} of {length} bytes of {path} were read")
        digests = [Unfinished(s).hexdigest() for s in batch.column("body").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(digests, pa.string())], names=["path", "sha256"])


def large_checksums(spark: SparkSession, pattern: str, large, longest: int, listed: DataFrame, span: int, size: int) -> DataFrame:
    """(path, sha256) of the files for which ``large`` holds; ``listed`` (path, length)."""
    lines = spark.read.option("lineSep", "\n").text(pattern).where(large).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    at = scratch_path(spark, "pieces")
    pieces = lines.mapInArrow(_pieces(size), "path string, start long, no int, n long, body binary")
    pieces.withColumn("round", F.floor(F.col("start") / span)).write.partitionBy("round").option("parquet.block.size", 32 << 20).parquet(at)
    stored = spark.read.schema("path string, start long, no int, n long, body binary, round long").parquet(at)
    # every line was given an end: of the last one it is real or not; a mark of 3 bytes is never read
    more = F.col("length") - F.col("read")
    state = stored.groupBy("path").agg(F.sum("n").alias("read")).join(listed, "path").select(
        "path", "length", F.when(more.isin(0, -1, 3, 2), more > 0).otherwise(F.raise_error(F.concat(F.lit("another length was read of "), "path"))).alias("mark"),
        F.lit(0).cast("long").alias("done"), F.lit(None).cast("binary").alias("body"))
    state = materialize(state)
    for i in range(-(-longest // span)):
        own = state.select("path", F.lit(-1).cast("long").alias("start"), F.lit(0).alias("no"), "length", "mark", "done", "body")
        next_ = stored.where(F.col("round") == i).select("path", "start", "no", "body")
        state = materialize(own.unionByName(next_, allowMissingColumns=True).repartition("path").sortWithinPartitions("path", "start", "no").mapInArrow(_go_on, STATE))
    return state.mapInArrow(_finish, "path string, sha256 string")


def file_checksums(spark: SparkSession, pattern: str, whole: int = WHOLE, span: int = SPAN, size: int = PIECE) -> DataFrame:
    """``(file, bytes, sha256)`` of files, computed on the executors; files of more than
    ``whole`` bytes go through the tasks in rounds of ``span`` bytes, unless their name ends like
    that of a compressed file (or this Python's libcrypto can't be reached)."""
    files = spark.read.format("binaryFile").load(pattern)
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    large = (F.col("_metadata.file_size") > whole) & ~F.col("_metadata.file_name").rlike(CODED)
    if sha256_library() is None:
        large = F.lit(False)
    listed = files.where(large).select(F.col("_metadata.file_path").alias("at"), name, F.col("length").alias("bytes"))
    longest = listed.agg(F.max("bytes")).first()[0]
    if longest is None:
        return files.select(name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    found = large_checksums(spark, pattern, large, longest, listed.select(F.col("at").alias("path"), F.col("bytes").alias("length")), span, size)
    whole_files = files.where(~large).select(name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return whole_files.unionByName(listed.join(found, F.col("at") == F.col("path")).select("file", "bytes", "sha256"))
