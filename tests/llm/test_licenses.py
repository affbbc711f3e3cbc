import math
import re

from foldwise.llm import licenses as li

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [None, "", "no licence", "Licensed under the MIT License.", "under the mit license under the MIT-license", "Licensed under CC BY-NC 4.0.",
         "Licensed under the Apache License, Version 2.0.", "the mit license under", "GNU General Public License, version 3.", "All rights reserved.",
         "x " * 40_000 + "cc by nc", "cc by cc by nc nc", "Permission is hereby granted, free of charge, to any person obtaining a copy of this thing",
         "the the the under the the mit license", "apache license version 2 0"]


def brute(text):
    ws = SPLIT.findall((text or "").lower())
    out = []
    for phrase, label in li.BASE:
        p = phrase.split()
        out += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]
    return len(ws), sorted(out)


def test_base_places_and_labels(make):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, TEXTS[4])]
    got = li.scan(make(rows, extra="labels2 start"), ["doc_id", "start"]).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, ((r["doc_id"], r["n_words"], [(p["start"], p["label"]) for p in r["places"]]) for r in got))) == \
        sorted(map(str, ((k, *brute(t)) for k, t in rows)))
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert all(set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) for r in got)
    assert labels[8] == ["gpl-3"] and labels[9] == ["all-rights-reserved"] and labels[12] == ["mit"] and labels[2] == []
    assert labels[5] == ["cc-by-nc"] and labels[7] == []


def test_idf_counts_documents(make):
    n, df = li.document_frequencies(make([(1, "mit mit"), (2, "MIT of"), (3, None), (3, "")]), "text", frozenset([b"mit", b"of", b"gnu"]))
    assert (n, df) == (4, {b"mit": 2, b"of": 1})


def test_empty(make):
    assert li.scan(make([]), ["doc_id"]).count() == 0


def test_query_against_every_place_of_every_template(spark, sf_dir):
    """The whole answer on the given documents and some planted ones: all templates tried at all places."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    planted = ["x " * k + p[1] + " tail" for k, p in enumerate(li.PASSAGES)] + [p[1].rsplit(" ", 2)[0] for p in li.PASSAGES]
    planted += [f"said {p[1]} and {q[0]} again {q[0]}" for p, q in zip(li.PASSAGES, li.BASE * 9)]
    planted += [re.sub(r"\b(the|and|is)\b", "zz", p[1]) for p in li.PASSAGES] + ["under the MIT License, under the mit license", "cc by", "", None]
    rows += [(10**6 + i, t) for i, t in enumerate(planted)]
    split = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    docs = {i: split(t) for i, t in rows}
    idf = lambda w: math.log((len(docs) + 1) / (sum(w in set(ws) for ws in docs.values()) + 1)) + 1e-9
    passages = []
    for label, p, key in li.PASSAGES:
        ws = split(p)
        rare = {i: idf(ws[i]) for i in sorted(range(len(ws)), key=lambda i: (-idf(ws[i]), i))[:li.RARE]}  # noqa: B023
        passages.append((label, ws, split(key), rare))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in li.scan(frame, ["doc_id"]).collect()}
    assert len(got) == len(rows)
    seen = set()
    for i, ws in docs.items():
        base = sorted((s, label) for p, label in li.BASE for s in range(len(ws)) if ws[s:s + len(split(p))] == split(p))
        labels = {label: 1.0 for _, label in base}
        for label, p, key, rare in passages:
            for s in range(len(ws)):
                share = sum(w for at, w in rare.items() if s + at < len(ws) and ws[s + at] == p[at]) / sum(rare.values())
                if share > 0 and share >= li.SHARE and any(ws[k:k + len(key)] == key for k in range(s, s + len(p) - len(key) + 1)):
                    labels[label] = max(labels.get(label, 0.0), sum(a == b for a, b in zip(ws[s:s + len(p)], p)) / len(p))
        r = got[i]
        assert (r["n_words"], [tuple(x) for x in r["places"]], r["labels"]) == (len(ws), base, sorted(labels)), i
        assert abs(r["score"] - max(labels.values(), default=0.0)) < 1e-12
        seen |= set(labels)
    assert seen >= {p[0] for p in li.PASSAGES}
