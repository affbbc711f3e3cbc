import math
import random

import numpy as np

from foldwise.llm import langid
from foldwise.llm.common import documents


def test_codewords():
    for n in (2, 3, 4, 7, 12, 40):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n
        assert (code.min(axis=0) == 0).all() and (code.max(axis=0) == 1).all()
    far = min(int((a != b).sum()) for i, a in enumerate(langid.codewords(4)) for b in langid.codewords(4)[:i])
    assert far == 4  # seven bits, one wrong bit is corrected


def test_one_wrong_bit_is_corrected():
    model = langid.Model(list("abcd"), np.random.default_rng(1).integers(1, 50, (4, langid.BINS)).astype(float))
    model.alpha = np.full(7, 1 / 7)
    for i, word in enumerate(model.code):
        for flip in range(7):
            margins = 2.0 * word - 1
            margins[flip] *= -1
            assert model.decode(margins)[0] == "abcd"[i]


def test_held_out_accuracy(spark, sf_dir):
    docs = documents(spark, sf_dir)
    from pyspark.sql import functions as F
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    named = docs.select("doc_id", "text", "lang", langid.held_out(F.col("doc_id")).alias("held_out"))
    got = langid.predict(named, model, ["doc_id", "lang", "held_out"]).where("held_out").collect()
    assert len(got) > 40
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edges(make):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "and", "that"]) for _ in range(20)), "en") for i in range(20)]
    rows += [(50 + i, " ".join(rng.choice(["der", "und", "nicht"]) for _ in range(20)), "de") for i in range(20)]
    model = langid.learn(make([*rows, (90, "zzz qqq", None), (91, None, "xx")]))
    assert model.languages == ["de", "en", "xx"]
    docs = make([(1, None), (2, ""), (3, "12 + 3!"), (4, "the the and"), (4, "the the and"), (None, "nicht und der"), (6, "x" * 200_000), (7, "ж")], extra="label body")
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.predict(docs, model, ["doc_id", "label"]).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "de")} <= got and len(got) == 7
    nothing = langid.learn(make([]))
    assert [tuple(r) for r in langid.predict(make([(1, "abc")]), nothing, ["doc_id"]).collect()] == [(1, "und", 0.0, True)]
    alone = langid.learn(make([(1, "abc abc", "en")]))
    assert langid.predict(make([(2, "xyz")]), alone, ["doc_id"]).first()["lang_pred"] == "en"
    assert langid.predict(make([]), model, ["doc_id"]).count() == 0


def test_query_against_the_definition(spark, sf_dir):
    """Every row of the query's answer from counts, log-odds and decoding written out plainly."""
    import zlib
    from collections import Counter
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1

    def bins(text):
        low = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 97 <= b <= 122 else 32 for b in text.encode())
        codes = (low[i] << 16 | low[i + 1] << 8 | low[i + 2] for i in range(len(low) - 2))
        return [(c * 0x9E3779B1 % (1 << 32)) >> 16 for c in codes if c != 0x202020]

    counts = {}
    for i, text, label in docs:
        if not held(i) and label is not None:
            counts.setdefault(label, Counter()).update(bins(text or ""))
    names = sorted(counts)
    total = {x: counts[x].total() + langid.SMOOTH * langid.BINS for x in names}
    code = langid.codewords(len(names))
    share = lambda x, b: (counts[x][b] + langid.SMOOTH) / total[x]
    weights, alpha = [], []
    for bit in code.T:
        sides = [[x for x, c in zip(names, bit) if c == v] for v in (1, 0)]
        mean = [[sum(share(x, b) for x in side) / len(side) for b in range(langid.BINS)] for side in sides]
        odds = [math.log(p / q) for p, q in zip(*mean)]
        weights.append(odds)
        alpha.append(sum((p - q) * o for p, q, o in zip(*mean, odds)))
    alpha = [a / sum(alpha) for a in alpha]
    got = {r["doc_id"]: r for r in langid.query(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for i, text, _ in docs:
        r = got[i]
        assert r["held_out"] == held(i)
        if text is None or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        own = bins(text)
        margins = [sum(w[b] for b in own) / len(own) if own else 0.0 for w in weights]
        loss = [sum(a * math.log1p(math.exp(-langid.SHARPNESS * (1 if c else -1) * m)) for a, c, m in zip(alpha, row, margins)) for row in code]
        best = min(range(len(names)), key=loss.__getitem__)
        assert r["lang_pred"] == names[best], i
        assert abs(r["score"] - 1 / sum(math.exp(loss[best] - x) for x in loss)) < 1e-4


def test_any_number_of_languages(spark):
    """More than 200: distances are checked, and one learned language after the other is told apart."""
    for n in (150, 201, 700):
        code = langid.codewords(n)
        want = min(int((code[i] != code[i + 1:]).sum(axis=1).min()) for i in range(n - 1))
        assert langid.least_distance(code) == want >= code.shape[1] // 4
    letters = "abcdefghijklmnopqrst"
    words = {f"l{i:03d}": f"{letters[i % 20]}{letters[i // 20]}{letters[(7 * i) % 20]}x{letters[(3 * i + i // 20) % 20]}q" for i in range(230)}
    docs = spark.createDataFrame([(i, f"{w} " * 30, x) for i, (x, w) in enumerate(words.items())], "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert model.languages == sorted(words) and langid.least_distance(model.code) >= model.code.shape[1] // 4
    found = langid.predict(docs, model, ["lang"]).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 225
