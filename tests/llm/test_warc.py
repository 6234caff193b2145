import hashlib

import pytest

from clusterloom.llm.warc import (
    CHUNK_BYTES,
    SEGMENT_BYTES,
    archived_pages,
    chunked,
    dechunked,
    page_records,
    read_pages,
    read_records,
    reassembled,
    write_pages,
)

LONG = "<p>é</p>" * 40_000
PAGES = [
    (1, "http://a/1", "x" * 1500),
    (5, "http://a/5", "x" * 1500),
    (3, None, "x" * 1500),
    (2, "http://a/ü WARC/1.1\r\n", "short"),
    (4, "http://a/4", "short"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "http://a/8", LONG),
    (9, "http://a/9", LONG),
    (10, "http://a/10", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 90 + "WARC/1.1"),
    (11, "http://a/11", "0\r\n\r\n" * 100),
    (11, "http://a/11", "0\r\n\r\n" * 100),
    (9, "http://a/9", LONG),
    (9, "http://b/9", LONG),
    (8, "http://a/8", LONG),
    (4, "http://b/4", "short"),
    (4, "http://a/4", "short"),
    (12, "http://a/12", "y" * 1000),
    (13, "http://a/13", "y" * 1000),
    (14, "http://a/14", "z" * 999),
    (15, "http://a/15", "z" * 999),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "?", "?") for r in rows], "page_id long, url string, html string, payload string, same string")


def brute(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        stored = max(p for p, _, h in rows if (h or "").encode() == payload)
        revisit = len(payload) >= 1000 and page != stored
        digest = hashlib.sha1(payload).hexdigest()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", stored if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_equals_brute_force(spark):
    rows = archived_pages(frame(spark)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    ).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(PAGES)
    assert archived_pages(frame(spark, [])).collect() == []


def test_payloads_come_back_whole(spark, tmp_path):
    write_pages(frame(spark), f"{tmp_path}/w")
    found = {r["page_id"]: r for r in read_pages(spark, f"{tmp_path}/w").collect()}
    assert bytes(found[9]["payload"]) == LONG.encode()
    assert bytes(found[10]["payload"]) == PAGES[9][2].encode()
    assert found[8]["payload"] is None and found[8]["refers_to"] == 9
    assert not [r for r in read_records(spark, f"{tmp_path}/w").collect() if r["kind"] == "continuation"]


def test_chunks():
    for payload in (b"", b"a" * (CHUNK_BYTES + 1), b"WARC/1.1" * 5, b"\r\n0\r\n\r\n", bytes(range(256)) * 99):
        assert dechunked(chunked(payload)) == payload
        assert b"WARC/1.1" not in chunked(payload)
    assert dechunked(b"3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc"
    for broken in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            dechunked(broken)


def segments(payload=b"q" * (3 * SEGMENT_BYTES)):
    import pyarrow as pa

    from clusterloom.llm.warc import RECORD_SCHEMA, VERSION, parsed_record

    rows = [parsed_record(r[len(VERSION) + 2 + len(b"WARC-Type: ") :] + b"\r\n\r\n") for r in page_records(1, "u", payload, None)]
    return rows, lambda chosen: [pa.RecordBatch.from_pylist(chosen, RECORD_SCHEMA)]


def test_segments_are_verified():
    rows, batches = segments()
    assert len(rows) == 4
    whole = [b for batch in reassembled(batches(rows)) for b in batch["block"].to_pylist()]
    assert len(whole) == 1 and whole[0].endswith(b"0\r\n\r\n")
    assert [b.num_rows for b in reassembled(batches([rows[0], rows[0], *rows[1:]]))] == [1]
    for broken in (rows[1:], rows[:2] + rows[3:], rows[:3]):
        with pytest.raises(ValueError):
            list(reassembled(batches(broken)))
