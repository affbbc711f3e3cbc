import random
import re

from foldwise.llm import decontam as dc

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return SPLIT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    windows = {}
    for item, t in items:
        ws = plain(t)
        n = min(13, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for key, t in rows:
        ws, hit, of = plain(t), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(ws) - n + 1):
                found = windows.get(tuple(ws[i:i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    of |= found
        out.append((key, len(ws), len(hit), sorted(of), len(hit) > 0 and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    vocab = ["The", "of", "é", "and", "Köln", "x1", "日本", "house", "it's", "a-b"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(14, 40))) for i in range(12)] + [(20, "Rare short one"), (21, "solo"), (22, None), (23, "!!"), (3, "again the same id house"), (None, "no id here")]
    rows = [(i, text(rng.randint(0, 60))) for i in range(30)]
    for i in range(30):
        _, t = rng.choice(items[:12])
        rows.append((100 + i, text(rng.randint(0, 400)) + " " + t.upper() + " " + text(3)))
    rows += [(200, "a rare SHORT one!"), (201, None), (202, ""), (203, "Solo"), (203, "Solo"), (204, "no id here"), (None, "solo " * 5), (205, "rare short " + "w " * 50_000 + "rare short one")]
    return rows, items


def frames(spark, make):
    rows, items = corpus()
    return rows, items, make(rows, extra="begin item_id"), spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark, make):
    rows, items, docs, bench = frames(spark, make)
    for block in (dc.BLOCK_BYTES, 300):  # one block, and many
        got = dc.scan(docs, bench, ["doc_id", "begin"], block_bytes=block).collect()
        assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got], key=str) == brute(rows, items)


def test_removal(spark, make):
    rows, items, docs, bench = frames(spark, make)
    bad = {k for k, *_, x in brute(rows, items) if x}
    out = dc.drop_contaminated(docs, bench)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} == {k for k, _ in rows} - bad
    cut = {r["doc_id"]: r["text"] for r in dc.remove_spans(docs, bench).collect()}
    assert cut[200] == "a !" and cut[201] is None and cut[203] == ""
    again = dc.scan(make([(k, t) for k, t in cut.items()]), bench, ["doc_id"]).collect()
    assert sum(r["n_hit"] for r in again) < 0.1 * sum(b[2] for b in brute(rows, items))


def test_empty(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.scan(make([(1, "a")]), none, ["doc_id"]).first()["contaminated"] is False
    assert dc.scan(make([]), none, ["doc_id"]).count() == 0
