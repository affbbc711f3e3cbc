"""The pipeline and the registered queries against plain versions on small tables."""

import hashlib
import math
import os
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from foldwise.llm import mixing, quality_lm
from foldwise.llm.queries import ORACLES
from tests_llm_helpers import Plain, brute_decontam, groups_of, plain_fp, shared_out

TABLES = "documents pages benchmark labels embeddings".split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_duckdb(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    got = entry.queries()[name](spark, sf_dir)
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    assert sorted(map(str, (tuple(r[c] for c in order) for r in got.collect()))) == sorted(map(str, (tuple(r[names.index(c)] for c in order) for r in cur.fetchall())))


def test_pipeline_against_plain_stages(spark, sf_dir):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r["quality"] == 1}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    # classifier: the model from its definition, the limits from exact ranks of trusted
    # documents, each scored by the model of the half that it is not in
    trusted_texts = [d["text"] for d in docs if d["doc_id"] in good and d["text"]]
    in_half = lambda t: zlib.crc32(t.encode()) & 1
    model = Plain(trusted_texts, None)
    other = [Plain([t for t in trusted_texts if in_half(t) != h], None) for h in (0, 1)]
    for d in docs:
        d["ppl"], d["n"] = model.ppl(d["text"] or ""), len((d["text"] or "").encode())
        d["held"] = other[in_half(d["text"])].ppl(d["text"]) if d["doc_id"] in good and d["text"] else None

    def ranked(values, share):
        values = sorted(values)
        return values[max(0, math.ceil(share * len(values)) - 1)]
    by_lang = {}
    for d in docs:
        by_lang.setdefault(d["lang"], []).append(d)
    kept = []
    for rows in by_lang.values():
        trusted = [d for d in rows if d["held"] is not None]
        if not trusted:  # the limit has no bound
            kept += [d for d in rows if d["ppl"] is not None]
            continue
        middle = ranked([d["held"] for d in trusted], 0.5)
        even = lambda v, n: math.exp((math.log(v) * n + math.log(middle) * quality_lm.PRIOR_BYTES) / (n + quality_lm.PRIOR_BYTES))  # noqa: E731,B023
        wide = quality_lm.TOLERANCE ** (1 + quality_lm.FEW_TRUSTED / len(trusted))
        limit = ranked([even(d["held"], d["n"]) for d in trusted], quality_lm.QUANTILE) * wide
        kept += [d for d in rows if d["ppl"] is not None and even(d["ppl"], d["n"]) <= limit]
    assert 0 < len(kept) < len(docs)
    last = {}
    for d in kept:
        last[d["text"]] = max(last.get(d["text"], -1), d["doc_id"])
    kept = [d for d in kept if last[d["text"]] == d["doc_id"]]
    fps = {d["doc_id"]: plain_fp(d["text"]) for d in kept}
    first = {}
    for group in groups_of(set(fps.values()), 2):
        first.update(dict.fromkeys(group, min(k for k, f in fps.items() if f in group)))
    kept = [d for d in kept if first[fps[d["doc_id"]]] == d["doc_id"]]
    bad = {k for k, *_, x in brute_decontam([(d["doc_id"], d["text"]) for d in kept], items) if x}
    kept = [d for d in kept if d["doc_id"] not in bad]
    size = {d["doc_id"]: len((d["text"] or "").split()) for d in kept}
    sources = {}
    for d in kept:
        sources[d["source"]] = sources.get(d["source"], 0) + size[d["doc_id"]]
    target = shared_out(sources)
    want = []
    for d in kept:
        rate = target[d["source"]] / sources[d["source"]]
        digest = hashlib.md5(d["text"].encode()).hexdigest()
        draw = int(hashlib.md5(f"{mixing.SEED}|{d['doc_id']}|{digest}|1".encode()).hexdigest()[:13], 16) / (1 << 52)
        n = math.floor(rate + 1e-12) + (draw < rate - math.floor(rate + 1e-12))
        want += [(d["doc_id"], i) for i in range(1, n + 1)]
    out = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r["doc_id"], r["copy"]) for r in out.collect()) == sorted(want)


def test_stages_return_the_columns_of_documents(spark, sf_dir, make):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).schema.names == docs.columns
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


CLASHES = "b x_id x_text x_row x_good c0 n_words items n_hit hit_spans contaminated row key h1 copies nth mix_n of_rate fp least"


def test_extra_columns_with_clashing_names_ride_along(spark, sf_dir, make):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(60).collect()]
    more, plain = make(docs, extra=CLASHES), make(docs)
    for _, stage in corpus_pipeline.STAGES:
        out, want = stage(spark, more, sf_dir), stage(spark, plain, sf_dir)
        assert out.columns[:len(more.columns)] == more.columns
        assert sorted(map(str, out.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        assert all(r["b"] == f"x{r['doc_id']}" for r in out.collect())


def test_queries_are_registered():
    names = [n for n in entry.queries() if n == "pipeline" or n.startswith("op") and n[2:3].isdigit()]
    assert len(names) == 14
