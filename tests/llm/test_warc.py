import gzip
import hashlib
import io

import pytest

from tidemark.llm import warc


def pages(spark):
    big = "<p>hello</p>" * 200
    rows = [(1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (3, None, "<p>x</p>"), (4, "http://a/4", "<p>x</p>"), (5, "u", None), (6, "u", ""),
            (7, "u", big), (8, "u", "é" * 700 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (None, "u", big), (None, "u", "n" * 1000), (9, "u", "m" * 3_000_000),
            (10, "u", "n" * 999), (11, "u", "n" * 999), (12, "u", "o" * 1000), (12, "u", "o" * 1000), (11, "u", "o" * 1000)]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, digest string, top long"), rows


def test_round_trip(spark):
    d, rows = pages(spark)
    a = warc.Archive(file_bytes=4000)
    folder, m = warc.write(d, a)
    members = warc.normalise(folder, m, a)
    got = warc.read(folder, members, with_payload=True).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = []
    for page, _, html in rows:
        p = (html or "").encode()
        same = [x for x, _, h in rows if (h or "").encode() == p and x is not None]
        top = max(same, default=None)
        revisit = len(p) >= 1000 and top is not None and page != top
        want.append((page, hashlib.sha1(p).hexdigest(), len(p), "revisit" if revisit else "response", top if revisit else None))
    have = [(r.page_id, r.payload_digest, r.payload_bytes, r.record_type, r.refers_to) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)
    by = {i: (h or "").encode() for i, _, h in rows if i is not None}
    for r in got:
        if r.record_type == "response" and r.page_id not in (None, 11, 12):
            assert r.payload == by[r.page_id]
    assert {r.url for r in got if r.page_id == 2} == {"http://a/2%0D%0AX: y"}


def test_members_and_index(spark):
    import json
    d, rows = pages(spark)
    folder, m = warc.write(d)
    members = warc.normalise(folder, m, remove=True)
    total = 0
    for r in members.collect():
        data = open(f"{folder.removeprefix('file:')}/{r.file}", "rb").read()
        index = [json.loads(x) for x in open(f"{folder.removeprefix('file:')}/{r.file}.idx")]
        assert sum(x["length"] for x in index) == len(data) == r.bytes and len(index) == r.records
        for x in index:
            warc.parse(gzip.decompress(data[x["offset"]:x["offset"] + x["length"]]))
        total += len(index)
    assert total == len(rows)


def test_streams_of_one_or_many_members_and_broken_ones():
    recs = [warc.build(i, "u", b"x" * i * 1000, hashlib.sha1(b"x" * i * 1000).hexdigest(), None, False, "2024-01-01T00:00:00Z") for i in range(5)]
    one, many = gzip.compress(b"".join(recs)), b"".join(map(gzip.compress, recs))
    for data in (one, many):
        assert list(warc.records(warc.inflate(io.BytesIO(data), 100))) == recs
    with pytest.raises(ValueError):
        list(warc.records(warc.inflate(io.BytesIO(one[:-20]))))
    with pytest.raises(ValueError):
        list(warc.records(iter([b"".join(recs)[:-9]])))


def test_empty_table(spark):
    d = spark.createDataFrame([], "page_id long, url string, html string")
    folder, m = warc.write(d)
    assert warc.read(folder, warc.normalise(folder, m)).count() == 0
