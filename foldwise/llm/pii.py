"""Personal data replaced by keyed surrogates.

Detected entities (``pii_entities.py``) get replacements of the same kind,
gender, script and format, drawn from a keyed hash of their canonical form, so
every mention of an entity in any document gets the same one (coreference).

Collision checks run over the distinct entities of the whole corpus: a surrogate
is accepted when no other entity of its kind has it or draws it in the same
round with a smaller canonical form, and when it is not itself an entity of the
corpus; the others draw again with the next attempt.  Different entities thus
stay different, and no real entity is put in another's place.

Documents that no pattern can match pass by untouched.  The others are stored once;
the accepted surrogates of their entities are joined to the text, one row per
distinct text; an entity that stands in a large part of the documents is one row
on one side of that join, and the other side is split by Spark when it is hot.

Defined results: NULL stays NULL and empty stays empty; repeated rows get equal
texts; an entity whose format class is used up or has no variable character gets
a longer form of its kind or a keyed mask, checked for collisions like any other;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, materialize, pieces, under_plain_names
from .pii_entities import SIGN, WORDED, mentions, render, surrogate
from .suffix_dedup import text_hashes

KEY = b"foldwise-surrogates"  # a deployment passes its own secret key
MAX_ATTEMPTS = 40


def candidate(text: str) -> Column:
    """Whether any pattern can match; the words are looked for only where the cheap sign is missing."""
    return F.col(text).rlike(SIGN) | F.col(text).rlike(WORDED)


def entity_rows(found: DataFrame, text: str) -> DataFrame:
    """(t1, t2, kind, canonical): distinct entities of every distinct text of ``found``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = [(a, b, kind, canonical) for a, b, t in zip(*[batch.column(c).to_pylist() for c in ("t1", "t2", "body")])
                   for kind, canonical in sorted({(k, c) for _, _, k, c in mentions(t)})]
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                             names=["t1", "t2", "kind", "canonical"])

    bodies = found.select(F.col(text).alias("body"), *text_hashes(F.col(text)))
    return bodies.mapInArrow(run, "t1 long, t2 long, kind string, canonical string").distinct()


def draw(entities: DataFrame, key: bytes, attempt: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [surrogate(key, k, c, attempt) for k, c in zip(batch.column("kind").to_pylist(), batch.column("canonical").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("canonical"), pa.array(drawn, pa.string())], names=["kind", "canonical", "surrogate"])

    return entities.select("kind", "canonical").mapInArrow(run, "kind string, canonical string, surrogate string")


def assign(entities: DataFrame, key: bytes = KEY, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(kind, canonical, surrogate) for distinct entities, without collisions."""
    pending, accepted = entities, None
    real = entities.select("kind", F.col("canonical").alias("surrogate"))
    for attempt in range(max_attempts):
        drawn = materialize(draw(pending, key, attempt))
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if accepted is not None:
            free = free.join(accepted, ["kind", "surrogate"], "left_anti")
        won = materialize(free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")).select("kind", "canonical", "surrogate"))
        pending = materialize(drawn.join(won, ["kind", "canonical"], "left_anti").select("kind", "canonical"))
        accepted = won if accepted is None else accepted.union(won)
        if pending.isEmpty():
            return accepted
    raise RuntimeError(f"entities without a surrogate after {max_attempts} draws")


def replace(docs: DataFrame, key: bytes = KEY, text: str = "text", n_column: str = "n_entities", kinds_column: str = "kinds") -> DataFrame:
    """``docs`` with surrogates in ``text``, the number of replaced mentions and
    their kinds (sorted); columns of these two names are replaced, all others ride along."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (n_column, kinds_column)])
    plain, names = under_plain_names(kept)
    own, body = plain.columns, names[text]
    hit = F.coalesce(candidate(body), F.lit(False))
    found = materialize(plain.where(hit))  # a small part of the corpus, read twice below
    rows = materialize(entity_rows(found, body))
    surrogates = materialize(assign(materialize(rows.select("kind", "canonical").distinct()), key))
    of_text = rows.join(surrogates, ["kind", "canonical"]).groupBy("t1", "t2").agg(F.collect_list(F.struct("kind", "canonical", "surrogate")).alias("map"))
    named = found.withColumns(dict(zip(("h1", "h2"), text_hashes(F.col(body))))).join(
        of_text, (F.col("h1") == F.col("t1")) & (F.col("h2") == F.col("t2")), "left").select(*own, "map")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts, counts, kinds = [], [], []
            for whole, pairs in zip(batch.column(body).to_pylist(), batch.column("map").to_pylist()):
                new = {(x["kind"], x["canonical"]): x["surrogate"] for x in pairs or ()}
                out, upto, n, seen = [], 0, 0, set()
                for a, b, kind, canonical in mentions(whole):
                    out += [whole[upto:a], render(whole[a:b], kind, new[kind, canonical])]
                    upto, n = b, n + 1
                    seen.add(kind.partition("-")[0])
                texts.append("".join([*out, whole[upto:]]))
                counts.append(n)
                kinds.append(",".join(sorted(seen)))
            cols = [pa.array(texts, pa.string()) if c == body else batch.column(c) for c in own]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), pa.array(kinds, pa.string())], names=[*own, "n", "kinds"])

    changed = named.mapInArrow(run, T.StructType([*plain.schema, T.StructField("n", T.LongType()), T.StructField("kinds", T.StringType())]))
    untouched = plain.where(~hit).select("*", F.lit(0).cast("long").alias("n"), F.lit("").alias("kinds"))
    return changed.union(untouched).select(*[F.col(names[c]).alias(c) for c in kept.columns], F.col("n").alias(n_column), F.col("kinds").alias(kinds_column))


def query(spark, sf_dir):
    return replace(documents(spark, sf_dir)).select("doc_id", "text", "n_entities", "kinds")
