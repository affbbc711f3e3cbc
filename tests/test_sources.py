"""Schema-checked CSV scans (S1) and sinks."""

import gzip
import hashlib
import os
import random
import tempfile

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from foldwise.sources import sinks
from foldwise.sources.tables import load_csv

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType())])


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_header_checked_and_empty_quotes_are_null(spark):
    d = tempfile.mkdtemp(prefix="fw-csv-", dir="/tmp")
    good, bad = os.path.join(d, "good.csv"), os.path.join(d, "bad.csv")
    _write(good, 'id,name\n1,"a"\n2,""\n')
    _write(bad, "name,id\nx,1\n")
    rows = load_csv(spark, good, SCHEMA).orderBy("id").collect()
    assert [(r["id"], r["name"]) for r in rows] == [(1, "a"), (2, None)]
    with pytest.raises(Exception):
        load_csv(spark, bad, SCHEMA).collect()
    with pytest.raises(Exception):
        load_csv(spark, os.path.join(d, "missing.csv"), SCHEMA).collect()


def test_params_come_back_from_json(spark, tmp_path):
    inf = float("inf")
    tables = {
        "edges": spark.createDataFrame([([-inf, 1.5, 0.1 + 0.2, 1e300, 5e-324, inf], "x"), ([], None), (None, 'quote " and | ü\n'), ([None, -0.0], "y")], "edges array<double>, name string"),
        "counts": spark.createDataFrame([(1 << 60, 3, True, 2.0), (None, None, None, None)], "n long, i int, b boolean, d double"),
        "none": spark.createDataFrame([], "a double, b array<string>"),
    }
    sinks.write_params_json(tables, str(tmp_path))
    back = sinks.read_params_json(spark, str(tmp_path), list(tables))
    for name, df in tables.items():
        assert back[name].schema == df.schema
        assert sorted(map(repr, back[name].collect())) == sorted(map(repr, df.collect()))
    text = "\n".join(r["value"] for r in spark.read.text(f"{tmp_path}/edges").collect())
    assert '"-inf"' in text and '"inf"' in text and "1.5" in text and "Infinity" not in text


def test_file_checksums(spark):
    d = tempfile.mkdtemp(prefix="fw-sum-", dir="/tmp")
    _write(os.path.join(d, "a.txt"), "abc")
    r = sinks.file_checksums(spark, os.path.join(d, "*.txt")).first()
    assert r["file"] == "a.txt" and r["bytes"] == 3
    assert r["sha256"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_large_files_are_hashed_in_pieces(spark):
    """No row holds a large file: the whole-file source may not even read one here."""
    d = tempfile.mkdtemp(prefix="fw-sum-", dir="/tmp")
    noise = random.Random(5).randbytes(35_000)
    bodies = {"noise": noise, "mark": b"\xef\xbb\xbf" + noise, "mark_ended": b"\xef\xbb\xbf" + noise + b"\n", "ended": noise + b"\n", "lines": b"\n" * 15_000,
              "returns": b"a\r\n\r" * 4_000, "one_line": b"\0" * 25_000, "limit": noise[:5_000], "above": noise[:5_001], "small": b"abc",
              "late_mark": noise[:9_999] + b"\n\xef\xbb\xbf" + noise, "two_marks": b"\xef\xbb\xbf" * 2 + noise}
    for name, body in bodies.items():
        os.makedirs(os.path.join(d, f"of {name}"))
        with open(os.path.join(d, f"of {name}", f"{name}.parquet"), "wb") as f:
            f.write(body)
    conf = {"spark.sql.sources.binaryFile.maxLength": "5000", "spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = sinks.file_checksums(spark, os.path.join(d, "*", "*.parquet"), whole=5_000, span=10_000, size=700).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(tuple(r) for r in rows) == sorted((f"{n}.parquet", len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items())


def test_compressed_files_are_hashed_as_they_are(spark):
    d = tempfile.mkdtemp(prefix="fw-sum-", dir="/tmp")
    body = gzip.compress(b"abc\n" * 5_000 + random.Random(6).randbytes(5_000))
    with open(os.path.join(d, "a.gz"), "wb") as f:
        f.write(body)
    r = sinks.file_checksums(spark, os.path.join(d, "*"), whole=1_000, span=2_000, size=300).first()
    assert tuple(r) == ("a.gz", len(body), hashlib.sha256(body).hexdigest())
