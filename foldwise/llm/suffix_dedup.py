"""Removal of repeated byte strings of at least ``W`` bytes (suffix-array dedup).

The repeats are found by the interval expansion of ``bwt.py``; Spark's part is
to bring every pair of equal windows into one block of bounded size:

1. Anchors.  Every ``W``-byte window has an anchor, the leftmost ``K``-byte
   string of least hash in it, so equal windows have equal anchors at equal
   offsets.  A run of windows with one anchor is a *context*, the bytes they
   span.  A row per context carries hashes and positions, no text.
2. Anchors seen once are dropped.  Contexts that are equal as a whole are
   counted together before anything is gathered; an anchor with one such
   context, seen twice or more, is repeated throughout.
3. One text for each distinct context of the remaining anchors is cut out of its
   document; contexts of an anchor meet in a block and the expansion finds the
   repeated windows among them, each context weighing as often as it occurs.
4. An anchor with more than ``GROUP`` distinct contexts (a passage shared by a
   large part of the corpus) is split by the anchor's offset in the window: all
   windows of an offset class share a core of bytes, so contexts are regrouped
   by core, equal ones are counted together, and classes are halved until no
   group is too large (at width one the core is the window itself).
5. Repeated windows go back to every occurrence as byte spans; a last pass cuts
   them out.

Defined results: NULL is the empty text; texts under ``W`` bytes have no window
and stay as they are; repeated rows repeat each other's windows, so both lose
them; an empty table gives an empty result.  Bytes that remain after a cut may
not be valid UTF-8, so ``cut_documents`` returns them as binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES, size_upper_bound
from .bwt import MAX_SYMBOLS, repeated_windows
from .common import batches_of, byte_texts, documents, materialize, sized_broadcast

W = 400
K = 32
GROUP = 1024
CHUNK = 1 << 20  # bytes hashed at a time
BLOCK = 1_300_000  # symbols of a block; one more group of contexts still fits

U = np.uint64
MULTS = [U(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def byte_codes() -> np.ndarray:
    """A random-looking 64-bit number for every byte, from a fixed generator."""
    return np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=U)


def anchors(data: np.ndarray, codes: np.ndarray, w: int = W, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-byte string, anchor position of each w-byte window).  k is
    a power of two up to 32; hashes of doubled lengths come from the halves."""
    h, size, step = codes[data], 1, 0
    while size < k:
        h = h[:-size] * MULTS[step] + h[size:]
        size, step = 2 * size, step + 1
    h ^= h >> U(29)
    h *= MULTS[1]
    h ^= h >> U(32)
    low = (h >> U(24) << U(24)) | np.arange(h.size, dtype=U)  # 40 bits of hash, then the position
    span, size = w - k + 1, 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[:size - span], low[span - size:])
    return h, (low & U((1 << 24) - 1)).astype(np.int64)


def contexts_of(texts: list[bytes], codes: np.ndarray, w: int = W, k: int = K) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (text number, anchor hash, context hash, begin, windows, anchor
    offset from begin) for the contexts of some texts, piece by piece."""
    for i, j in batches_of(texts, CHUNK):
        # a text longer than a chunk is cut into pieces that overlap by w - 1 bytes
        cuts = range(0, max(1, len(texts[i]) - w + 1), CHUNK) if j == i + 1 else (0,)
        for cut in cuts:
            part = [texts[i][cut:cut + CHUNK + w - 1]] if j == i + 1 else texts[i:j]
            joined = b"".join(part)
            if len(joined) < w:
                continue
            sizes = np.array([len(t) for t in part])
            base = np.concatenate([[0], np.cumsum(sizes)])
            h, anchor = anchors(np.frombuffer(joined, np.uint8), codes, w, k)
            owner = np.repeat(np.arange(len(part)), sizes)[:anchor.size]
            whole = np.arange(anchor.size) + w <= base[owner + 1]
            brk = np.ones(anchor.size, bool)
            brk[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])
            lo = np.flatnonzero(brk)
            n = np.diff(np.append(lo, anchor.size))
            lo, n = lo[whole[lo]], n[whole[lo]]
            view, digest = memoryview(joined), xxhash.xxh3_64_intdigest
            ch = np.array([digest(view[a:b]) for a, b in zip(lo.tolist(), (lo + n + (w - 1)).tolist())], U)
            yield owner[lo] + i, h[anchor[lo]].view(np.int64), ch.view(np.int64), lo - base[owner[lo]] + cut, n, anchor[lo] - lo


def text_hashes(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that stand for a whole text."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(7), whole).alias("t2")]


def context_rows(docs: DataFrame, text: str, w: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = byte_codes()
        for batch in batches:
            t1, t2 = batch.column("t1").to_numpy(), batch.column("t2").to_numpy()
            for no, kg, ch, begin, n, off in contexts_of(byte_texts(batch.column("body")), codes, w, k):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kg), pa.array(ch), pa.array(t1[no]), pa.array(t2[no]), pa.array(begin, pa.int64()),
                     pa.array(n.astype(np.int32)), pa.array(off.astype(np.int32))], names=["kg", "ch", "t1", "t2", "begin", "n_win", "off"])

    return docs.select(F.col(text).alias("body"), *text_hashes(F.col(text))).mapInArrow(
        run, "kg long, ch long, t1 long, t2 long, begin long, n_win int, off int")


def _cut_contexts(w: int):
    """Texts with the list of contexts wanted from them, to context rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in ("kg", "ch", "n", "off", "ctx")}
            for body, wanted in zip(byte_texts(batch.column("body")), batch.column("wanted").to_pylist()):
                for x in wanted:
                    for c in ("kg", "ch", "n", "off"):
                        out[c].append(x[c])
                    out["ctx"].append(body[x["begin"]:x["begin"] + x["n_win"] + w - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["kg"], pa.int64()), pa.array(out["ch"], pa.int64()), pa.array(out["n"], pa.int64()),
                 pa.array(out["off"], pa.int32()), pa.array(out["ctx"], pa.binary())], names=list(out))

    return run


CONTEXT = "kg long, ch long, n long, off int, ctx binary"


def split_context(ctx: bytes, off: int, width: int, w: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(class, first window, windows, core) of the offset classes of a context:
    window i has its anchor at offset ``off - i``, class ``offset // width``; the
    core is what all windows of a class share, whichever of them are present."""
    n = len(ctx) - w + 1
    for c in range((off - n + 1) // width, off // width + 1):
        earliest, latest = off - (c * width + width - 1), off - c * width  # starts of the class
        first, last = max(0, earliest), min(n - 1, latest)
        yield c, first, last - first + 1, ctx[latest:earliest + w]



def group_marks(group: list[tuple[int, int, bytes]], width: int, w: int):
    """Contexts (n, off, ctx) of one anchor: windows known to be repeated, as
    (context, first, count), and strings for the block, as lists (one per core)
    of (bytes, weight, [(context, first)])."""
    cores: dict[tuple[int, bytes], dict[bytes, list]] = {}
    for x, (n, off, ctx) in enumerate(group):
        for c, first, count, core in split_context(ctx, off, width, w):
            piece = cores.setdefault((c, core), {}).setdefault(ctx[first:first + count + w - 1], [0, []])
            piece[0] += n
            piece[1].append((x, first))
    known, strings = [], []
    for pieces in cores.values():
        if len(pieces) == 1:
            (text, (weight, of)), = pieces.items()
            if weight > 1:
                known += [(x, first, len(text) - w + 1) for x, first in of]
        else:
            strings.append([(text, weight, of) for text, (weight, of) in pieces.items()])
    return known, strings


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """[begin, end) of the runs of True."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


RUNS = "kg long, ch long, lo int, hi int"


def _block_marks(w: int, k: int):
    """Contexts sorted by anchor, to rows (kg, ch, lo, hi): windows lo ... hi - 1
    of the context are repeated."""
    width = -(-(w - k + 1) // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, weights, places, size = [], [], [], 0
        out = []

        def expand() -> None:
            nonlocal size
            if texts:
                for flags, of in zip(repeated_windows(texts, weights, w), places):
                    for a, b in runs_of(flags):
                        out.extend((kg, ch, first + a, first + b) for kg, ch, first in of)
            texts.clear(), weights.clear(), places.clear()
            size = 0

        def close(kg: int, group: dict) -> None:
            nonlocal size
            chs = list(group)
            known, strings = group_marks(list(group.values()), width, w)
            out.extend((kg, chs[x], first, first + n) for x, first, n in known)
            for core in strings:
                need = sum(len(t) + 1 for t, _, _ in core)
                if size + need > MAX_SYMBOLS:
                    expand()
                for t, weight, of in core:
                    texts.append(t), weights.append(weight)
                    places.append([(kg, chs[x], first) for x, first in of])
                size += need
            if size > BLOCK:
                expand()

        def rows() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[], [], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["kg", "ch", "lo", "hi"])

        now, group = None, {}
        for batch in batches:
            for kg, ch, n, off, ctx in zip(*[batch.column(c).to_pylist() for c in ("kg", "ch", "n", "off", "ctx")]):
                if kg != now:
                    if group:
                        close(now, group)
                    now, group = kg, {}
                group[ch] = (n, off, ctx)
            yield rows()
        if group:
            close(now, group)
        expand()
        yield rows()

    return run


def _split_rows(width: int, w: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            out = {c: [] for c in ("kg", "ch", "n", "off", "ctx", "p_kg", "p_ch", "at")}
            for kg, ch, n, off, ctx in zip(*[batch.column(c).to_pylist() for c in ("kg", "ch", "n", "off", "ctx")]):
                for c, first, count, core in split_context(ctx, off, width, w):
                    piece = ctx[first:first + count + w - 1]
                    values = (digest(core, 1000 * width + c), digest(piece, c), n, off - first, piece, kg, ch, first)
                    for name, v in zip(out, values):
                        out[name].append(v)
            arrays = [pa.array(np.array(out[c], U).view(np.int64)) for c in ("kg", "ch")] + [
                pa.array(out["n"], pa.int64()), pa.array(out["off"], pa.int32()), pa.array(out["ctx"], pa.binary()),
                pa.array(out["p_kg"], pa.int64()), pa.array(out["p_ch"], pa.int64()), pa.array(out["at"], pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=list(out))

    return run


def context_marks(contexts: DataFrame, sizes: DataFrame, width: int, w: int, k: int, group: int) -> DataFrame:
    """(kg, ch, lo, hi) for distinct contexts; ``sizes`` (kg, m): contexts per anchor."""
    crowded = materialize(sizes.where(F.col("m") > group).select(F.col("kg").alias("big")))

    def blocks(some: DataFrame) -> DataFrame:
        return some.repartition("kg").sortWithinPartitions("kg").mapInArrow(_block_marks(w, k), RUNS)

    if crowded.isEmpty():
        return blocks(contexts)
    contexts = materialize(contexts)
    small_side = sized_broadcast(crowded)
    marks = blocks(contexts.join(small_side, contexts["kg"] == F.col("big"), "left_anti"))
    hot = contexts.join(small_side, contexts["kg"] == F.col("big"), "left_semi")
    narrower = -(-width // 2)
    pieces = materialize(hot.mapInArrow(_split_rows(narrower, w), CONTEXT + ", p_kg long, p_ch long, at int"))
    state = pieces.groupBy("kg").agg(F.sum("n").alias("total"), F.min("ch").alias("c0"), F.max("ch").alias("c1")).where("total > 1")
    state = materialize(state.select("kg", (F.col("c0") == F.col("c1")).alias("same")))
    placed = pieces.drop("n", "off", "ctx").join(state, "kg")
    n_win = F.octet_length("ctx") - (w - 1)
    same = pieces.join(state.where("same"), "kg").select(
        F.col("p_kg").alias("kg"), F.col("p_ch").alias("ch"), F.col("at").alias("lo"), (F.col("at") + n_win).cast("int").alias("hi"))
    mixed = state.where("not same").select("kg")
    distinct = pieces.join(mixed, "kg").groupBy("kg", "ch").agg(
        F.sum("n").alias("n"), F.min("off").alias("off"), F.first("ctx").alias("ctx"))
    distinct = materialize(distinct)
    below = context_marks(distinct, distinct.groupBy("kg").agg(F.count("*").alias("m")), narrower, w, k, group)
    back = placed.where("not same").join(below, ["kg", "ch"]).select(
        F.col("p_kg").alias("kg"), F.col("p_ch").alias("ch"), (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi"))
    return marks.union(same).union(back)


def repeated_spans(docs: DataFrame, text: str = "text", w: int = W, k: int = K, group: int = GROUP) -> DataFrame:
    """(t1, t2, spans): byte spans to remove from every text that has some, as
    sorted pieces that may still touch; t1 and t2 stand for the text."""
    rows = materialize(context_rows(docs, text, w, k))
    state = rows.groupBy("kg").agg(F.count("*").alias("total"), F.min("ch").alias("c0"), F.max("ch").alias("c1")).where("total > 1")
    state = materialize(state)  # read from a table, the join below may split a hot anchor
    shared = materialize(rows.join(state, "kg").select("kg", "ch", "t1", "t2", "begin", "n_win", "off", (F.col("c0") == F.col("c1")).alias("same")))
    mixed = shared.where("not same")
    kinds = mixed.groupBy("kg", "ch").agg(F.count("*").alias("n"), F.min(F.struct("t1", "t2", "begin", "n_win", "off")).alias("at"))
    kinds = materialize(kinds.select("kg", "ch", "n", "at.*"))
    wanted = kinds.groupBy("t1", "t2").agg(F.collect_list(F.struct("kg", "ch", "n", "begin", "n_win", "off")).alias("wanted"))
    wanted = materialize(wanted)
    bodies = docs.select(F.col(text).alias("body"), *text_hashes(F.col(text))).where(F.octet_length("body") >= w)
    keys = wanted.select("t1", "t2")
    if size_upper_bound(keys) <= BROADCAST_MAX_BYTES:
        bodies = bodies.join(F.broadcast(keys), ["t1", "t2"], "left_semi")
    # one body per text, chosen before the shuffle too: a text's copies are never gathered
    one = bodies.groupBy("t1", "t2").agg(F.first("body").alias("body"))
    contexts = one.join(wanted, ["t1", "t2"]).select("body", "wanted").mapInArrow(_cut_contexts(w), CONTEXT)
    sizes = kinds.groupBy("kg").agg(F.count("*").alias("m"))
    marks = materialize(context_marks(contexts, sizes, w - k + 1, w, k, group))
    whole = shared.where("same").select("t1", "t2", "begin", (F.col("begin") + F.col("n_win") + (w - 1)).alias("end"))
    some = mixed.select("kg", "ch", "t1", "t2", "begin").join(marks, ["kg", "ch"]).select(
        "t1", "t2", (F.col("begin") + F.col("lo")).alias("begin"), (F.col("begin") + F.col("hi") + (w - 1)).alias("end"))
    return whole.union(some).groupBy("t1", "t2").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"))


def _cut(passed: list[str], rest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for body, spans in zip(byte_texts(batch.column("body")), batch.column("spans").to_pylist()):
                kept, upto, n_spans = [], 0, 0
                for s in spans or ():
                    if n_spans == 0 or s["begin"] > upto:  # runs that touch are one
                        kept.append(body[upto:s["begin"]])
                        n_spans += 1
                    upto = max(upto, s["end"])
                left = b"".join([*kept, body[upto:]])
                for c, v in zip(out, (len(body), len(body) - len(left), n_spans, hashlib.sha256(left).hexdigest(), left if rest else None)):
                    out[c].append(v)
            arrays = [pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")] + [pa.array(out["kept_sha256"]), pa.array(out["kept"], pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], *arrays], names=[*passed, *out])

    return run


def cut_documents(docs: DataFrame, carry: list[str], text: str = "text", w: int = W, k: int = K, group: int = GROUP, rest: bool = True) -> DataFrame:
    """``carry`` columns of every document plus n_bytes, n_removed, n_spans,
    kept_sha256 and, unless ``rest`` is False, the remaining bytes ``kept``."""
    clash = {"n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with the result's")
    spans = materialize(repeated_spans(docs, text, w, k, group)).select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), "spans")
    h1, h2 = text_hashes(F.col(text))
    marked = docs.select(*carry, F.col(text).alias("body"), h1.alias("__h1"), h2.alias("__h2")).join(
        spans, (F.col("__h1") == F.col("__t1")) & (F.col("__h2") == F.col("__t2")), "left").select(*carry, "body", "spans")
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return marked.mapInArrow(_cut(carry, rest), f"{fields}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def query(spark, sf_dir):
    return cut_documents(documents(spark, sf_dir), ["doc_id"], rest=False).drop("kept")
