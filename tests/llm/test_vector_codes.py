import hashlib
import math
import random

import numpy as np
import pytest

from foldwise.llm import vector_codes as vc
from foldwise.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows, parts=3, extra=""):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra.split():
        df = df.selectExpr("*", f"concat('x', vec_id) AS `{name}`")
    return df.repartition(parts) if rows else df


def floats(x):
    return [float(np.float32(v)) for v in x]


def plain(rows, scale=4096, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks straight from the definition, in Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, vectors.packed(np.array(r[1]))))
    w = len(kept[0][1]) // parts
    cut = lambda v: [v[p * w:(p + 1) * w] for p in range(parts)]
    subs = [cut(v) for _, v, _ in kept]
    books = [[subs[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for s in subs:
                members.setdefault(near(s[p], books[p])[1], []).append(s[p])
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else c for e, c in enumerate(books[p])]
    out = []
    for (i, _, lab), s in zip(kept, subs):
        found = [near(s[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(g for g, _ in found), lab))
    return out, books


def sha(books):
    return hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def rows_of(codes):
    return sorted(((r["key"], r["code"], r["error"], r["label"]) for r in codes.collect()), key=str)


def corpus(n, seed=1, dims=16, spread=0.3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(5)]
    return [(i * 3, floats(rng.gauss(c, 0.1) for c in rng.choice(centres)), rng.choice([0, 1, 2, None])) for i in range(n)]


NAN, INF = float("nan"), float("inf")
AWKWARD = [(None, floats([0.1] * 16), 1), (5, None, 1), (6, [], 2), (7, floats([NAN] + [0.0] * 15), 1), (8, floats([INF] + [0.0] * 15), 1),
           (9, [None] + [0.0] * 15, 1), (10, [0.0] * 16, None), (10, [0.0] * 16, None), (10, floats([-0.2] * 16), 1), (1, floats([1000.0] * 16), 3)]


@pytest.mark.parametrize("block", [1, 7, 256])
def test_against_the_definition(spark, block):
    rows = corpus(150) + AWKWARD + [(1000 + i, floats([0.25, -0.5] * 8), 4) for i in range(70)]  # a hot vector
    codes, books = vc.compress(frame(spark, rows, extra="key rid code error part v"), block=block)
    want, want_books = plain(rows)
    assert rows_of(codes) == sorted(want, key=str)
    assert vc.codebooks_sha256(books) == sha(want_books)
    by_label = {}
    for _, _, e, lab in want:
        by_label[lab] = by_label.get(lab, 0) + e
    assert {(r["label"], r["label_error"]) for r in vc.with_label_error(codes).collect()} == set(by_label.items())


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(4, floats([0.5] * 8), 1)], corpus(9, dims=8)])
def test_few_rows(spark, rows):
    codes, books = vc.compress(frame(spark, rows))
    assert rows_of(codes) == sorted(plain(rows)[0], key=str)


def test_lengths_that_cannot_be_cut(spark):
    with pytest.raises(ValueError):
        vc.compress(frame(spark, [(1, [0.5] * 9, 1)]))
    codes, _ = vc.compress(frame(spark, [(1, [0.5] * 8, 1), (2, [0.5] * 16, 1), (3, [3e38] * 8, 1)]))
    assert [r[0] for r in rows_of(codes)] == [1]  # another length, or integers that leave a long: dropped


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (8, 1), (4, 2)])
def test_neighbours_on_the_curve_touch(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    place = vc.hilbert(grid, bits)
    assert sorted(place) == list(range(len(grid)))
    walk = grid[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_keep_every_winner():
    rng = np.random.default_rng(3)
    saved = 0
    for _ in range(300):
        entries = rng.integers(-40, 40, (16, 4))
        entries[rng.integers(16)] = entries[rng.integers(16)]  # equal entries: the first wins
        x = rng.integers(-40, 40, 4) + rng.integers(-6, 7, (20, 4))
        short = vc.shortlist(x.min(axis=0), x.max(axis=0), entries)
        gap = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        entry, least = vc.nearest(x, entries, short)
        assert (entry == gap.argmin(axis=1)).all() and (least == gap.min(axis=1)).all()
        saved += 16 - len(short)
    assert saved > 300 * 8


def test_packed_vectors_come_back():
    for top in (0, 1, 127, 128, 32767, 32768, vectors.MAX_COMPONENT, 1 << 40):
        x = np.array([-top, top, 0, top // 2])
        assert (vectors.unpacked(vectors.packed(x), 4) == x).all()
