import hashlib
from collections import defaultdict

import pytest

from foldwise.llm import exact_dedup


def brute(rows, pick):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        out.append((i, pick(known) if known else None, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, None), (2, ""), (3, "a"), (4, "a "), (5, "a"), (5, "a"), (None, "a"), (6, "é"), (7, "é"), (8, "long " * 3000), (9, "long " * 3000),
        (10, "long " * 2999 + "x"), (None, "only"), *[(100 + i, "hot text") for i in range(400)], *[(1000 + i, f"t{i}") for i in range(60)]]


@pytest.mark.parametrize("keep,pick", [("max", max), ("min", min)])
def test_membership(make, keep, pick):
    marked = exact_dedup.content_sort(make(ROWS, 4), keep=keep)
    got = exact_dedup.membership(marked, keep=keep).collect()
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == brute(ROWS, pick)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({t or "" for _, t in ROWS})  # one of each text, also with repeated identifiers
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


@pytest.fixture(autouse=True)
def small_ranges(spark):
    """Ranges stay apart, as they do on large tables."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_group_spans_ranges(spark, make):
    marked = exact_dedup.content_sort(make(ROWS, 4))
    hot = hashlib.sha256(b"hot text").hexdigest()
    assert marked.where(f"x_sha = '{hot}'").select("x_range").distinct().count() > 1


def test_survivors_keep_all_columns(make):
    docs = make(ROWS, 4, extra="kept group_size")
    out = exact_dedup.dedup(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(r["text"] or "" for r in got) == sorted({t or "" for _, t in ROWS})
    assert {r["text"]: r["doc_id"] for r in got}["hot text"] == 499
    clashing = make(ROWS, 4, extra="x_run x_text x_place c0")
    assert exact_dedup.dedup(clashing).columns == clashing.columns
    assert sorted(map(str, exact_dedup.dedup(clashing).select(*docs.columns[:5]).collect())) == sorted(map(str, out.select(*docs.columns[:5]).collect()))


@pytest.mark.parametrize("key", [7, None])
def test_rows_with_one_identifier_are_dealt_to_several_ranges(spark, make, key):
    rows = [(key, "one text")] * 400 + [(i, f"text {i}") for i in range(300)]
    marked = exact_dedup.content_sort(make(rows, 4))
    same = hashlib.sha256(b"one text").hexdigest()
    assert marked.where(f"x_sha = '{same}'").select("x_range").distinct().count() > 1
    got = [r for r in exact_dedup.membership(marked).collect() if r["text_sha256"] == same]
    assert len(got) == 400 and sum(r["kept"] for r in got) == 1 and {(r["keep_id"], r["group_size"]) for r in got} == {(key, 400)}


def test_empty(make):
    assert exact_dedup.membership(exact_dedup.content_sort(make([]))).count() == 0
    assert exact_dedup.dedup(make([])).count() == 0
