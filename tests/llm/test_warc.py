import gzip
import hashlib

import pytest

from aspectra.llm.warc import assemble, captures_of, parse_archive, read_records, write_captures
from aspectra.session import new_scratch_path

BIG = "<html>" + "päge\r\n\r\nWARC/1.1\r\n" * 90 + "</html>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a.example/x?q=1#f", BIG), (7, "http://b.example/", BIG), (3, "http://c.example", BIG), (4, "http://d.example/\r\nX: y", "small"), (5, None, "small")]
    rows += [(6, "http://e.example/", None), (8, "http://e.example/", ""), (9, "not a url", BIG + "!"), (None, "http://n.example/", BIG), (9, "not a url", BIG + "!"), (7, "http://b.example/", BIG), (5, None, "small")]
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, digest string, rid int")


def test_round_trip(spark, pages):
    got = captures_of(spark, pages, new_scratch_path(spark, "warc")).collect()
    want, seen = [], set()
    for r in pages.collect():
        raw = (r.html or "").encode()
        again = len(raw) >= 1000 and (r.html == BIG and r.page_id != 7 or (r.page_id, r.html) in seen)
        seen.add((r.page_id, r.html))
        leader = (7 if r.html == BIG else r.page_id) if again else None
        want.append((r.page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", leader, True))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)  # a row per page, repeated rows included


def test_records_are_whole_and_join(spark, pages):
    path = new_scratch_path(spark, "warc")
    write_captures(pages, path)
    records = read_records(spark, path, with_payload=True)
    captures = sorted(assemble(records).collect(), key=lambda r: r.response.record_type, reverse=True)
    nested = {r.response.target_uri: r for r in captures}  # of equal pages the response
    assert bytes(nested["http://b.example/"].response.payload).decode() == BIG
    assert nested["http://a.example/x?q=1#f"].response.payload is None and nested["http://a.example/x?q=1#f"].refers_to_page == 7
    for r in nested.values():
        assert r.request.record_type == "request" and r.metadata.fields["page-id"] is not None
    assert "http://d.example/%0D%0AX: y" in nested


def test_plain_and_multi_member_archives_and_damage():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    for content in (record * 2, gzip.compress(record) + gzip.compress(record)):
        assert [r["payload"] for r in parse_archive(content, True)] == [b"body"] * 2
    with pytest.raises(ValueError):
        list(parse_archive(record[:-9], True))
    with pytest.raises(ValueError):
        list(parse_archive(b"HTTP/1.1 200 OK\r\n", True))


def test_lost_partners_and_empty_table(spark, pages):
    path = new_scratch_path(spark, "warc")
    write_captures(pages, path)
    records = read_records(spark, path).where("record_type <> 'request'")
    assert {r.request for r in assemble(records).collect()} == {None}
    assert captures_of(spark, pages.limit(0), new_scratch_path(spark, "warc")).count() == 0
