import math
import random
from collections import Counter, defaultdict

import pytest

from foldwise.llm import quality_lm as q


class Plain:
    """Interpolated modified Kneser-Ney straight from the definition."""

    def __init__(self, trusted, asked):
        raw = Counter(g for t in trusted for g in self.grams(t))
        self.c = {q.ORDER: raw}
        for n in range(q.ORDER - 1, 0, -1):
            self.c[n] = Counter(g[1:] for g in self.c[n + 1])
        self.ctx, self.d = {}, {}
        for n, counts in self.c.items():
            rows = defaultdict(Counter)
            for g, c in counts.items():
                rows[g[:-1]][min(c, 3)] += 1
                rows[g[:-1]]["t"] += c
            self.ctx[n] = rows
            m = Counter(counts.values())
            y = m[1] / (m[1] + 2 * m[2]) if m[1] + 2 * m[2] else None
            d = [0.0]
            for i in (1, 2, 3):
                v = i - (i + 1) * y * m[i + 1] / m[i] if m[i] and y is not None else 0.5
                d.append(min(max(v, 0.1), i))
            self.d[n] = d

    @staticmethod
    def grams(t):
        b = bytes(q.ORDER - 1) + t.encode().translate(q.FOLD)
        return [b[i:i + q.ORDER] for i in range(len(b) - q.ORDER + 1)]

    def p(self, g):
        n = len(g)
        if n == 0:
            return 1 / 256
        row = self.ctx[n].get(g[:-1])
        if row is None:
            return self.p(g[1:])
        c, d = self.c[n][g], self.d[n]
        rest = sum(d[i] * row[i] for i in (1, 2, 3)) / row["t"]
        return (c - d[min(c, 3)]) / row["t"] + rest * self.p(g[1:])

    def ppl(self, t):
        gs = self.grams(t)
        return math.exp(-sum(math.log(self.p(g)) for g in gs) / len(gs)) if gs else None


def corpus():
    rng = random.Random(4)
    words = ["the", "and", "tion", "ing", "of", "house", "garden", "élan", "über", "12", "7"]
    good = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))
    rows = [(i, good(), rng.choice(["en", "fr"]), "s", 1) for i in range(80)]
    rows += [(200 + i, "".join(rng.choice("#$%&!XQZ") for _ in range(60)), "en", "s", 1) for i in range(6)]
    rows += [(300, None, "en", "s", 1), (301, "", "fr", "s", 1), (302, good(), None, "s", 1), (303, good(), "xx", "s", 1), (5, "repeated key", "en", "s", 1),
             (None, good(), "en", "s", 1)]
    labels = [(i, 1 if i < 60 else 0, 0) for i in range(70)] + [(1, 0, 0), (None, 1, 0), (999, 1, 0), (203, 0, 0), (302, None, 0)]
    return rows, labels


def test_against_the_definition(spark, make):
    rows, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = q.perplexities(make(rows), marks).collect()
    good = {i for i, x, _ in labels if x == 1 and i is not None}
    model = Plain([t for i, t, *_ in rows if i in good and t], None)
    assert len(scored) == len(rows)
    want = sorted(((i, lang, model.ppl(t or "")) for i, t, lang, *_ in rows), key=str)
    for w, g in zip(want, sorted(((r["x_id"], r["x_lang"], r["x_ppl"]) for r in scored), key=str)):
        assert w[:2] == g[:2] and (w[2] is None and g[2] is None or abs(w[2] - g[2]) < 1e-9 * w[2]), (w, g)
    assert {r["x_id"] for r in scored if r["x_trusted"]} == good & {r[0] for r in rows}


def test_junk_goes_and_clean_stays(spark, make):
    rows, labels = corpus()
    docs = make(rows, extra="kept limit")
    out = q.keep_good(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert out.columns == docs.columns
    kept = {r["doc_id"] for r in out.collect()}
    assert not kept & {200 + i for i in range(6)} and 300 not in kept and 301 not in kept
    assert len(kept & set(range(80))) >= 78 and {302, 303} <= kept


@pytest.mark.parametrize("rows", [[], [(1, "some text"), (2, None)]])
def test_without_trusted_documents(spark, make, rows):
    out = q.judged(q.perplexities(make(rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))).collect()
    assert {r["x_id"]: r["x_keep"] for r in out} == {i: t is not None for i, t in rows}


def test_trusted_documents_are_held_out_for_the_limit(spark, make):
    """x_held is the perplexity under the model of the other half, from the definition."""
    rows, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = q.perplexities(make(rows), marks).collect()
    good = {i for i, x, _ in labels if x == 1 and i is not None}
    text = {i: t for i, t, *_ in rows if i in good and i != 5}
    halves = [[t for i, t, *_ in rows if i in good and t and q.half(t.encode()) == h] for h in (0, 1)]
    assert min(map(len, halves)) > 0
    models = [Plain(halves[1], None), Plain(halves[0], None)]
    for r in scored:
        assert (r["x_held"] is None) == (r["x_id"] not in good)
        if r["x_id"] in text:
            want = models[q.half(text[r["x_id"]].encode())].ppl(text[r["x_id"]])
            assert abs(r["x_held"] - want) < 1e-9 * want


def held_out_share(spark, sf_dir, make, n_trusted):
    """Kept share of good Spanish documents whose labels the classifier did not see."""
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    good = sorted({r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r["quality"] == 1} & set(docs))
    spanish = [i for i in good if docs[i]["lang"] == "es"]
    hidden = set(spanish[n_trusted:])
    marks = spark.createDataFrame([(i, 1, 0) for i in good if i not in hidden], "doc_id long, quality int, toxic int")
    out = q.keep_good(make([tuple(docs[i])[:4] for i in good]), marks)
    kept = {r["doc_id"] for r in out.collect()}
    return len(kept & hidden) / len(hidden)


@pytest.mark.parametrize("n_trusted", [0, 1, 3, 20])
def test_clean_documents_of_scarce_languages_stay(spark, make, n_trusted):
    assert held_out_share(spark, "/root/testdata/sf0.01", make, n_trusted) >= 0.9
