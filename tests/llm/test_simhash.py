import random
import re
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from foldwise.llm import simhash as sh
from foldwise.llm.components import components


def plain_fp(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups_of(fps, d):
    """Component of every fingerprint, by comparing all pairs."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in fps:
        for b in fps:
            if a < b and bin(a ^ b).count("1") <= d:
                root[find(a)] = find(b)
    out = defaultdict(set)
    for f in fps:
        out[find(f)].add(f)
    return sorted(map(sorted, out.values()))


TEXTS = [None, "", "  \t\n", "One", "one", "two words", "Three Words Here", "a b c d", "É é A a " * 5, "nbsp stays x y", "w " * 30_000, "a a a a a a"]


def test_fingerprints(spark, make):
    for t in TEXTS:
        assert sh.fingerprint((t or "").encode()) == plain_fp(t), t
    assert spark.sql("SELECT xxhash64('one') AS h").first()["h"] % (1 << 64) == sh.fingerprint(b"One")


def close_fps(rng, n, centres):
    base = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        f = rng.choice(base)
        for _ in range(rng.randint(0, 4)):
            f ^= 1 << rng.randrange(64)
        out.add(f)
    return out


def test_links_in_small_and_large_buckets(spark):
    rng = random.Random(7)
    fps = close_fps(rng, 250, 6)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    for d in (0, 1, 2):
        want = groups_of(fps, d)
        for bucket in (10_000, 2):  # all pairs, and ties through common points
            edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in sh.links(frame, d, bucket).collect()]
            root = {f: f for f in fps}

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x
            for a, b in edges:
                root[find(a)] = find(b)
            got = defaultdict(set)
            for f in fps:
                got[find(f)].add(f)
            assert sorted(map(sorted, got.values())) == want, (d, bucket)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 180)] + [(300, i) for i in range(301, 400)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(90)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {x: find(x) for x in root if find(x) != x}
    assert {k: v for k, v in got.items()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(make):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(150))) for i in range(10, 40)]
    rows += [(100 + i, rows[0][1]) for i in range(20)] + [(200 + i, rows[1][1].replace(rows[1][1].split()[i], "zz", 1)) for i in range(30)]
    rows += [(300 + i, t) for i, t in enumerate(TEXTS)] + [(7, ""), (None, rows[2][1]), (12, rows[2][1]), (12, rows[2][1])]
    docs = make(rows, extra="fp component_id")
    got = sh.near_groups(docs).select("doc_id", sh.hex_fp(F.col("fp")).alias("h"), "component_id").collect()
    fp = [(k, plain_fp(t)) for k, t in rows]
    first = {}
    for group in groups_of({f for _, f in fp}, 2):
        ids = [k for k, f in fp if f in group and k is not None]
        first.update(dict.fromkeys(group, min(ids) if ids else None))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, ((k, f"{f:016x}", first[f]) for k, f in fp)))
    kept = sh.keep_one(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert {r["doc_id"] for r in left} == {first[f] for f in first}
    assert len({plain_fp(r["text"]) for r in left}) == len(groups_of(set(first), 2))  # one document of every group, NULL ids or not
    assert sh.near_groups(make([])).count() == 0 == sh.keep_one(make([])).count()


def test_one_document_of_each_group_stays_when_ids_repeat(spark, make):
    a, b = "alpha beta gamma delta epsilon", "one two three four five six"
    rows = [(5, a), (7, a), (3, b), (5, b), (None, b), (None, "no id here at all"), (None, "no id here at all"), (9, a), (9, a)]
    kept = sorted(((r["doc_id"], r["text"]) for r in sh.keep_one(make(rows)).collect()), key=str)
    assert kept == sorted([(5, a), (3, b), (None, "no id here at all"), (None, "no id here at all")], key=str)


def test_a_third_of_the_rows_on_one_id(make):
    rows = [(1 if i % 3 == 0 else i, f"text number {i} of words {i * 7} and {i * 13} more {i * 3}") for i in range(300)]
    kept = sh.keep_one(make(rows, extra="fp least h1 doc root")).collect()
    groups = groups_of({plain_fp(t) for _, t in rows}, 2)
    assert len(kept) == len(groups)
