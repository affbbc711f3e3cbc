import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from foldwise.llm import suffix_dedup as sd
from foldwise.llm.bwt import repeated_windows


def test_interval_expansion_against_counting():
    rng = random.Random(1)
    for _ in range(120):
        w = rng.choice([1, 2, 5, 9, 30, 60])
        alphabet = rng.choice([b"ab", b"abc", b"abcdefgh"])
        word = lambda n: bytes(rng.choice(alphabet) for _ in range(n))
        texts = [word(rng.randint(1, 300)) for _ in range(rng.randint(1, 6))]
        texts += [t[rng.randint(0, len(t) - 1):] + word(20) for t in texts]
        weights = [rng.choice([1, 1, 2]) for _ in texts]
        count = Counter()
        for t, x in zip(texts, weights):
            for i in range(len(t) - w + 1):
                count[t[i:i + w]] += x
        for t, flags in zip(texts, repeated_windows(texts, weights, w)):
            assert flags.tolist() == [count[t[i:i + w]] >= 2 for i in range(len(t) - w + 1)]


def brute(rows, w):
    count = Counter(b[i:i + w] for _, b in rows for i in range(len(b) - w + 1))
    out = []
    for key, b in rows:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - w + 1):
            if count[b[i:i + w]] > 1:
                gone[i + 1:i + 1 + w] = True
        left = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((key, len(b), len(b) - len(left), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(left).hexdigest(), left))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(30) for _ in range(4)]
    rows = [(i, text(rng.randint(0, 40)) + " " + rng.choice(shared)[rng.randint(0, 60):] + " " + text(rng.randint(0, 20))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "short"), (103, "ab" * 200), (104, rows[3][1]), (104, rows[3][1]), (None, rows[5][1]), (105, text(5) * 9)]
    return rows


@pytest.mark.parametrize("group", [1024, 2])
def test_spans_against_brute_force(make, group):
    """group=2: nearly every anchor takes the way of the crowded ones."""
    rows = corpus(5)
    want = brute([(k, (t or "").encode()) for k, t in rows], 40)
    got = sd.cut_documents(make(rows, extra="begin"), ["doc_id", "begin"], w=40, k=8, group=group).collect()
    assert sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in got], key=str) == want
    assert sum(r["n_removed"] for r in got) > 1000


def test_pieces_of_a_long_text(monkeypatch):
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcd") for _ in range(5000))
    whole = [x for x in sd.contexts_of([text], sd.byte_codes(), 40, 8)]
    monkeypatch.setattr(sd, "CHUNK", 700)
    parts = [x for x in sd.contexts_of([text], sd.byte_codes(), 40, 8)]

    def windows(arrays):
        return {(b + i): (kg, off - i) for _, kgs, _, begins, ns, offs in arrays for kg, b, n, off in zip(kgs, begins, ns, offs) for i in range(n)}
    assert windows(whole) == windows(parts) and len(windows(parts)) == 4961


def test_empty(make):
    assert sd.cut_documents(make([]), ["doc_id"]).count() == 0
    assert sd.cut_documents(make([(1, None), (2, "x")]), ["doc_id"]).agg({"n_removed": "sum"}).first()[0] == 0
