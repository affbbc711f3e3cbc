"""Exact dedup by a content sort.

Sampled splitters range-partition the documents on their content, an external
sort inside every range places equal texts next to each other, and one pass
over the sorted rows compares each text in full with its neighbour.

The sort key is (first ``HEAD`` characters, SHA-256 of the whole text,
identifier, place in the input).  The digest stands for the bytes behind the head, so the sampled
splitters that reach the driver have a fixed width however long a text is, and
the identifier lets one group of copies spread over any number of ranges.
Whether two rows are equal is decided on the whole texts only.  A group that
crosses a range border is joined up again from the first and last text of every
range: two rows per range, whatever the data.

Defined results: NULL counts as the empty text; of rows with equal text and
equal identifier exactly one stays; a NULL identifier stays only if its text has no other;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, materialize, sized_broadcast, under_plain_names, with_own_names

HEAD = 64

MARKS = T.StructType([
    T.StructField("x_range", T.IntegerType()), T.StructField("x_pos", T.LongType()), T.StructField("x_run", T.LongType()),
    T.StructField("x_last", T.BooleanType()), T.StructField("x_sha", T.StringType()),
    T.StructField("x_edge", T.BooleanType()), T.StructField("x_first_text", T.StringType()), T.StructField("x_last_text", T.StringType())])
MARK_NAMES = MARKS.fieldNames()


def _mark_runs(carried: list[str], text_of_all: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A pass over sorted rows: position, run number and "last of its run"; one
    more row at the end holds the range's first and last text.

    A row is put out once its successor is known, so only one row is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema = held = first = prev = None
        pos = n_run = 0

        def out(table: pa.Table, runs: list[int], start: int, last: list[bool], shas: list[str]) -> pa.RecordBatch:
            n = table.num_rows
            cols = [table.column(c).combine_chunks() for c in carried]
            if not text_of_all:  # texts of rows that go are not needed any more
                cols = [pa.array([v if keep else None for v, keep in zip(c.to_pylist(), last)], c.type) if pa.types.is_string(c.type) or pa.types.is_binary(c.type) else c
                        for c in cols]
            marks = [pa.array([part] * n, pa.int32()), pa.array(range(start, start + n), pa.int64()), pa.array(runs, pa.int64()),
                     pa.array(last, pa.bool_()), pa.array(shas, pa.string()), pa.array([False] * n, pa.bool_()),
                     pa.nulls(n, pa.string()), pa.nulls(n, pa.string())]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c for c in [*cols, *marks]],
                                              names=[*carried, *MARK_NAMES])

        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            texts = batch.column("x_text").to_pylist()
            runs, starts = [], []
            for t in texts:
                same = prev is not None and t == prev
                if prev is None:
                    first = t
                elif not same:
                    n_run += 1
                starts.append(not same)
                runs.append(n_run)
                prev = t
            shas = batch.column("x_dig").to_pylist()
            if held is not None:
                yield out(*held, [starts[0]], held_sha)
            body = pa.Table.from_batches([batch])
            if batch.num_rows > 1:
                yield out(body.slice(0, batch.num_rows - 1), runs[:-1], pos, starts[1:], shas[:-1])
            held, held_sha = (body.slice(batch.num_rows - 1), runs[-1:], pos + batch.num_rows - 1), shas[-1:]
            pos += batch.num_rows
        if held is not None:
            yield out(*held, [True], held_sha)
            empty = [pa.nulls(1, schema.field(c).type) for c in carried]
            marks = [pa.array([part], pa.int32()), pa.array([pos], pa.int64()), pa.array([n_run], pa.int64()), pa.array([False]),
                     pa.nulls(1, pa.string()), pa.array([True]), pa.array([first], pa.string()), pa.array([prev], pa.string())]
            yield pa.RecordBatch.from_arrays([*empty, *marks], names=[*carried, *MARK_NAMES])

    return run


def content_sort(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "max", carry: bool = False) -> DataFrame:
    """The sorted, marked rows, stored.  ``carry``: with every column of
    ``docs`` (texts of rows that go are set to NULL), else the key alone.
    ``keep``: which identifier of equal texts stays, ``max`` or ``min``; it is
    sorted to the end of its run."""
    clash = [c for c in docs.columns if c.startswith("x_")]
    if clash:
        raise ValueError(f"columns {clash} clash with the marks of the content sort")
    carried = list(docs.columns) if carry else [key]
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(*carried, whole.alias("x_text"), F.substring(whole, 1, HEAD).alias("x_head"), F.sha2(whole, 256).alias("x_dig"))
    ident = F.col(key).asc_nulls_first() if keep == "max" else F.col(key).desc_nulls_first()
    # rows that agree in text and identifier are told apart by their place in the input, so that they can be dealt to several ranges
    keyed = keyed.withColumn("x_place", F.monotonically_increasing_id())
    order = [F.col("x_head"), F.col("x_dig"), ident, F.col("x_place")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("x_place")
    schema = T.StructType([*[T.StructField(c, docs.schema[c].dataType) for c in carried], *MARKS.fields])
    return materialize(ordered.mapInArrow(_mark_runs(carried, not carry), schema))


def _borders(marked: DataFrame) -> DataFrame:
    """One row per range: whether its first run continues the range before, where
    that run begins, and whether its last run goes on in the next range."""
    edges = marked.where("x_edge")
    seq = edges.select("x_range", F.row_number().over(Window.orderBy("x_range")).alias("x_seq"))
    texts = edges.join(seq, "x_range").select("x_seq", "x_range", F.col("x_run").alias("n_run"), "x_first_text", "x_last_text")
    before = texts.select((F.col("x_seq") + 1).alias("x_seq"), F.col("x_last_text").alias("before"))
    linked = texts.join(before, "x_seq", "left").select(
        "x_seq", "x_range", "n_run", F.coalesce(F.col("before") == F.col("x_first_text"), F.lit(False)).alias("linked"))
    up = Window.orderBy("x_seq")
    start = F.when((F.col("n_run") > 0) | ~F.col("linked"), F.struct("x_range", F.col("n_run").alias("x_run")))
    return linked.select("x_range", "n_run", "linked",
                         F.last(start, ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, -1)).alias("root"),
                         F.coalesce(F.lead("linked").over(up), F.lit(False)).alias("goes_on"))


def membership(marked: DataFrame, key: str = "doc_id", keep: str = "max") -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256."""
    rows = marked.where("not x_edge").select(key, "x_range", "x_pos", "x_run", "x_sha")
    borders = materialize(_borders(marked))
    linked = borders.where("linked").select(F.col("x_range").alias("b_range"), "root")
    head = rows.join(sized_broadcast(linked), (rows["x_range"] == F.col("b_range")) & (rows["x_run"] == 0), "left")
    placed = head.select(key, "x_range", "x_pos", "x_sha",
                         F.coalesce(F.col("root.x_range"), F.col("x_range")).alias("g_range"),
                         F.coalesce(F.col("root.x_run"), F.col("x_run")).alias("g_run"))
    # the row that stays is the last one of its group in the sort order
    last = F.max(F.struct("x_range", "x_pos", F.col(key).alias("id")))
    groups = placed.groupBy("g_range", "g_run").agg(F.count("*").alias("group_size"), last.alias("top"))
    joined = placed.join(materialize(groups), ["g_range", "g_run"])  # both sides read from tables: a hot group is split
    kept: Column = (F.col("top.x_range") == F.col("x_range")) & (F.col("top.x_pos") == F.col("x_pos"))
    return joined.select(key, F.col("top.id").alias("keep_id"), "group_size", kept.alias("kept"), F.col("x_sha").alias("text_sha256"))


def survivors(marked: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that stay, from a sort that carried all columns: the last row of
    every run, unless the run goes on in the next range."""
    borders = materialize(_borders(marked)).where("goes_on").select(F.col("x_range").alias("b_range"), F.col("n_run").alias("b_run"))
    tops = marked.where("x_last and not x_edge")
    on = (tops["x_range"] == F.col("b_range")) & (tops["x_run"] == F.col("b_run"))
    return tops.join(sized_broadcast(borders), on, "left_anti").select(*columns)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "max") -> DataFrame:
    """``docs`` with one row for every distinct text, all columns kept, whatever their names."""
    plain, own = under_plain_names(docs)
    return with_own_names(survivors(content_sort(plain, own[key], own[text], keep, carry=True), plain.columns), docs)


def query(spark, sf_dir):
    return membership(content_sort(documents(spark, sf_dir)))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
             sha256(body) AS text_sha256 FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
