import hashlib
import io
import re

import pytest

from corpuslens.llm import warc
from corpuslens.session import fresh_path

SCHEMA = "page_id LONG, url STRING, html STRING, digest STRING"


def round_trip(spark, rows, with_payload=True):
    df = spark.createDataFrame(rows, SCHEMA)
    folder = fresh_path(spark, "warc-test")
    manifest = warc.write_archives(warc.plan_records(df), folder, archive_bytes=2000)
    return warc.read_archives(manifest, folder, with_payload).collect()


def test_every_record_comes_back(spark):
    big, other = "é" * 600, "z" * 999
    rows = [
        (1, "http://a/1", big, "x"), (2, "http://a/2", big, "x"), (3, None, big, "x"), (4, "u\r\nv", other, "x"),
        (5, "u", other, None), (6, "u", None, None), (7, "u", "", None), (8, "u", "\r\n\r\n" + "w" * 200_000, None),
        (None, "n", big, None), (3, "again", big, None),
    ]
    out = round_trip(spark, rows)
    assert len(out) == len(rows) and all(r.verified for r in out)
    by = {(r.page_id, r.url): r for r in out}
    assert [by[k].record_type for k in ((1, "http://a/1"), (2, "http://a/2"), (3, ""), (3, "again"), (None, "n"))] == [
        "revisit", "revisit", "response", "response", "revisit"]
    assert by[1, "http://a/1"].refers_to == 3 and by[3, ""].refers_to is None
    assert by[4, "uv"].record_type == by[5, "u"].record_type == "response"
    assert by[1, "http://a/1"].payload_bytes == 1200 and by[1, "http://a/1"].stored_bytes == 0
    for page_id, url, html, _ in rows:
        r = by[page_id, (url or "").replace("\r\n", "")]
        payload = (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        if r.record_type == "response":
            assert bytes(r.payload) == payload


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_damage_is_found():
    good = warc.encode_record(1, "u", b"a" * 100_000, None) + warc.encode_record(2, "u", b"", 1)
    read = list(warc.read_archive(io.BytesIO(good), with_payload=True))
    assert [r["record_type"] for r in read] == ["response", "revisit"] and read[0]["payload"] == b"a" * 100_000
    with pytest.raises((EOFError, ValueError, __import__("zlib").error)):
        list(warc.read_archive(io.BytesIO(good[:-20])))
    import gzip

    plain = gzip.decompress(warc.encode_record(1, "u", b"abcdef", None))
    forged = gzip.compress(plain.replace(b"abcdef", b"abcdeg"))
    assert [r["verified"] for r in warc.read_archive(io.BytesIO(forged))] == [False]
    sizes = [int(x) for x in re.findall(rb"Content-Length: (\d+)", plain)]
    short = gzip.compress(plain.replace(b"Content-Length: %d" % sizes[0], b"Content-Length: %d" % (sizes[0] - 1), 1))
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(short)))


def test_query(spark, sf):
    import duckdb

    from corpuslens.llm.queries import QUERIES, SQL
    from tests.compare import difference

    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    assert difference(QUERIES["op2_warc_round_trip"](spark, sf), db.execute(SQL["op2_warc_round_trip"])) is None
