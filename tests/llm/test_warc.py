import base64
import gzip
import hashlib
import os

import pytest

from foldwise.llm import warc


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain(rows, min_bytes=0):
    """(page_id, bytes, digest, type, refers_to) of pages with distinct ids."""
    first = {}
    for key, _, html in rows:
        data = (html or "").encode()
        first[data] = min(first.get(data, key), key)
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= min_bytes and first[data] != key
        out.append((key, len(data), b32(data), "revisit" if again else "response", first[data] if again else None))
    return sorted(out)


def pages_of(spark, rows, parts=3, extra=""):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in extra.split():
        df = df.selectExpr("*", f"concat('x', page_id) AS `{name}`")
    return df.repartition(parts) if rows else df


def rows_of(result):
    return sorted((r["key"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in result.collect())


AWKWARD = [
    (1, "http://a.example/x", "<p>one</p>"), (2, "http://b.example/ y\nz", "<p>one</p>"), (3, None, None), (4, "", ""),
    (5, "http://c.example/ü", "line\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\r\n\r"),
    (6, "http://d.example/", "http://e.example/ 0.0.0.0 19990101000000 text/html 5\nabcde\n" * 3),
    (7, "-", "\n\n\n"), (8, "http://f.example/", "é" * 70_000 + "\r\n\r\n" * 9_000), (9, "http://g.example/", "<p>one</p>"),
    (10, "http://h.example/", "\r\n\r\n"), (11, "filedesc://x", "x"), (12, "http://i.example/", "\x00\x01 \x7f"),
]


@pytest.mark.parametrize("min_bytes", [0, 1, 11])
def test_round_trip_against_a_plain_version(spark, min_bytes):
    rows = AWKWARD + [(100 + i, f"http://hot.example/{i}", "the same page") for i in range(60)]
    out = warc.round_trip(pages_of(spark, rows, extra="key type first size record value"), min_bytes=min_bytes)
    assert rows_of(out) == plain(rows, min_bytes)
    assert out.where("not intact").count() == 0


def test_empty_table(spark):
    assert warc.round_trip(pages_of(spark, [])).collect() == []


def test_repeated_and_null_keys_give_one_response(spark):
    rows = [(None, "u", "same"), (None, "u", "same"), (7, "u", "same"), (7, "u", "same"), (None, "v", "alone")]
    out = sorted(((r["key"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages_of(spark, rows)).collect()), key=str)
    assert out == sorted([(7, "response", None), (7, "revisit", 7), (None, "revisit", 7), (None, "revisit", 7), (None, "response", None)], key=str)


def test_text_keys(spark):
    df = pages_of(spark, [(1, "u", "a"), (2, "u", "a")]).selectExpr("concat('k\n:', page_id) AS page_id", "url", "html")
    out = sorted((r["key"], r["refers_to"] or "") for r in warc.round_trip(df).collect())
    assert out == [("k\n:1", ""), ("k\n:2", "k\n:1")]


def arc_file(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}.gz", "wb") as f:
        f.write(data)


def version_block(name, version, end=b"\n"):
    about = f"{version} 0 crawler\n{warc.FIELDS[version]}\n".encode()
    more = "200 - - 0 x.arc " if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 19980203 text/plain {more}{len(about)}\n".encode() + about + end


def test_header_lines_of_both_versions(spark, tmp_path):
    page = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n<html>\nold\n</html>"
    bare = b"no head at all"
    one = (version_block("one.arc", 1)
           + b"http://a.example/a b 10.0.0.1 19980203040506 text/html %d\n" % len(page) + page + b"\n"
           + b"dns:a.example 10.0.0.2 199802030405 text/dns %d\n" % len(bare) + bare + b"\n\n"
           + b"this line is damage and has no length\n"
           + b"http://b.example/ 10.0.0.1 19981399000000 text/plain 6\nabc\ndef\n"[:-1] + b"\n"
           + b"http://cut.example/ 10.0.0.1 19980203040506 text/html 500\n" + page)
    two = (version_block("two.arc", 2)
           + b"http://c.example/ 10.0.0.3 20010203040506 text/html 404 CHECK http://to.example/ 217 two.arc %d\n" % len(page) + page + b"\n")
    arc_file(f"{tmp_path}/arc", "one.txt", one)
    arc_file(f"{tmp_path}/arc", "two.txt", two)
    found = {r["uri"]: r for r in warc.read_arc(spark, f"{tmp_path}/arc").collect() if r["type"] != "warcinfo"}
    assert set(found) == {"http://a.example/a%20b", "dns:a.example", "http://b.example/", "http://cut.example/", "http://c.example/"}
    a, c = found["http://a.example/a%20b"], found["http://c.example/"]
    assert (a["version"], a["type"], a["date"], a["ip"], a["block"]) == (1, "response", "1998-02-03T04:05:06Z", "10.0.0.1", page)
    assert (c["version"], c["date"], c["arc"], c["payload_digest"]) == (2, "2001-02-03T04:05:06Z", "two.arc", a["payload_digest"])
    assert a["payload_digest"] == b32(b"<html>\nold\n</html>") and a["block_digest"] == b32(page)
    assert (found["dns:a.example"]["type"], found["dns:a.example"]["date"]) == ("resource", "1998-02-03T04:05:00Z")
    # a date that is none takes the archive's; the damaged line cost nothing after it
    assert found["http://b.example/"]["date"] == "1998-02-03T00:00:00Z"
    assert found["http://cut.example/"]["truncated"] and not a["truncated"]
    # both pages with the same payload, and the cut one too: one response, two revisits
    warc.write_warc(warc.convert(spark, f"{tmp_path}/arc"), f"{tmp_path}/warc")
    back = warc.resolve(warc.read_warc(spark, f"{tmp_path}/warc")).collect()
    assert sorted(r["record_type"] for r in back) == ["response", "revisit", "revisit"] and all(r["intact"] for r in back)
    again = {r["arc"]: r["record_id"] for r in warc.read_arc(spark, f"{tmp_path}/arc").where("version = 2 and type = 'response'").collect()}
    assert again["two.arc"] == c["record_id"]


def test_written_records_are_warc(spark, tmp_path):
    warc.write_arc(pages_of(spark, AWKWARD, parts=1), f"{tmp_path}/arc", versions=(2,))
    warc.write_warc(warc.convert(spark, f"{tmp_path}/arc"), f"{tmp_path}/warc")
    data = b"".join(gzip.open(f"{tmp_path}/warc/{n}").read() for n in sorted(os.listdir(f"{tmp_path}/warc")) if n.startswith("part-"))
    kinds, ids = [], set()
    while data:  # by declared lengths alone, as any reader would
        head, _, data = data.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.0"
        fields = dict(line.split(b": ", 1) for line in lines[1:])
        assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(fields)
        block, data = data[:int(fields[b"Content-Length"])], data[int(fields[b"Content-Length"]):]
        assert fields[b"WARC-Block-Digest"] == b"sha1:" + b32(block).encode()
        assert data.startswith(b"\r\n\r\n")
        data = data[4:]
        kinds.append(fields[b"WARC-Type"].decode())
        ids.add(fields[b"WARC-Record-ID"])
    assert sorted(kinds) == ["response"] * 9 + ["revisit"] * 3 + ["warcinfo"] and len(ids) == 13


def test_a_changed_byte_is_noticed(spark, tmp_path):
    warc.write_arc(pages_of(spark, [(1, "u", "some text here")], parts=1), f"{tmp_path}/arc")
    record = warc.convert(spark, f"{tmp_path}/arc")
    broken = record.selectExpr("cast(replace(cast(record AS string), 'some text', 'same text') AS binary) AS record")
    warc.write_warc(broken, f"{tmp_path}/warc")
    assert [r["intact"] for r in warc.resolve(warc.read_warc(spark, f"{tmp_path}/warc")).collect()] == [False]
