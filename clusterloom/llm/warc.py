"""Web archives: written as WARC records, read back and reassembled.

Responses are framed in chunks and cut into segments of bounded size. A
reader groups the continuation records by the identifier of their first
record, orders them by segment number, verifies the total length and decodes
the chunked framing. Records that were not cut need no grouping.

Archives are written and read by Spark's text source, whose line separator
is the mark between records; so files are committed like any table, and a
lost task is simply repeated.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterloom.llm.batches import bound_batches, slices
from clusterloom.storage import snapshot, work_dir

#: Payloads from this size on are stored once.
MIN_SHARED = 1000

CHUNK_BYTES = 16 << 10
SEGMENT_BYTES = 64 << 10

#: Compressed files are read by one task each; with segments this bounds their size.
RECORDS_PER_FILE = 2000

VERSION = b"WARC/1.1"
#: Every record starts with the version and its type; rows of the text source end there.
MARK = "WARC/1.1\r\nWARC-Type: "
RECORD_END = "\r\n\r\n"

DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
)


def chunked(payload: bytes) -> bytes:
    """Chunked transfer framing. No chunk holds the version string whole, so it never occurs in a block."""
    cuts = set(range(0, len(payload), CHUNK_BYTES))
    cuts.update(found.start() + 4 for found in re.finditer(re.escape(VERSION), payload))
    cuts.add(len(payload))
    edges = sorted(cuts | {0})
    parts = [b"%x\r\n%b\r\n" % (end - start, payload[start:end]) for start, end in zip(edges, edges[1:])]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload inside chunked framing; raises ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        line_end = body.find(b"\r\n", at)
        if line_end < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:line_end].split(b";")[0], 16)
        start = line_end + 2
        if size == 0:
            return b"".join(parts)
        if body[start + size : start + size + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        parts.append(body[start : start + size])
        at = start + size + 2


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP response, with the transfer framing removed."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head) else body


def payload_label(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    """A record up to, without, the separator that follows it. The type comes first."""
    lines = [f"{name}: {value}" for name, value in fields.items() if value is not None]
    head = "\r\n".join([f"WARC-Type: {kind}", *lines, f"Content-Length: {len(block)}", "", ""])
    return VERSION + b"\r\n" + head.encode() + block


def page_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)(?:[:/].*)?>", name or "")
    return int(found.group(1)) if found else None


def record_name(page_id: int | None, label: str, row: int) -> str:
    """Versions of a page, and its repetitions, get different names."""
    return f"{page_name(page_id)[:-1]}:{label}:{row}>"


def page_records(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, row: int = 0, refers_row: int | None = None
) -> list[bytes]:
    """The records of a page: a revisit, or a response and its continuations."""
    label = payload_label(payload)
    name = record_name(page_id, label, row)
    target = quote(url or "about:blank", safe=":/?#[]@!$&'()*+,;=%")
    common = {"WARC-Target-URI": target, "WARC-Date": DATE}
    if refers_to is not None:
        fields = {
            "WARC-Record-ID": name,
            **common,
            "WARC-Payload-Digest": label,
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": record_name(refers_to, label, refers_row or 0),
        }
        return [record("revisit", fields, b"")]
    block = HTTP_HEAD + chunked(payload)
    fields = {"WARC-Record-ID": name, **common, "WARC-Payload-Digest": label}
    if len(block) <= SEGMENT_BYTES:
        return [record("response", fields, block)]
    parts = [block[at : at + SEGMENT_BYTES] for at in range(0, len(block), SEGMENT_BYTES)]
    out = [record("response", {**fields, "WARC-Segment-Number": 1}, parts[0])]
    for number, part in enumerate(parts[1:], 2):
        last = number == len(parts)
        fields = {
            "WARC-Record-ID": f"{name[:-1]}/{number}>",
            **common,
            "WARC-Segment-Origin-ID": name,
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if last else None,
        }
        out.append(record("continuation", fields, part))
    return out


def pages_to_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = zip(*(batch[name].to_pylist() for name in ("page_id", "url", "payload", "refers_to", "row", "refers_row")))
        out = [piece for row in rows for piece in page_records(*row)]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_pages(pages: DataFrame, folder: str) -> None:
    """Write pages (page_id, url, html) as compressed archives.

    The payload is the html in UTF-8, empty where missing. Of equal payloads
    of ``MIN_SHARED`` bytes or more the one with the largest page_id becomes
    the response, the others revisit it; smaller ones are all responses. Every
    row gets a record of its own, repeated rows too. Other columns are ignored.
    """
    bound_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    large = F.length("payload") >= MIN_SHARED
    rows = rows.withColumn("same", F.when(large, F.sha2("payload", 256)))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    # Only payloads that occur again can make revisits; what each task knows is combined before the shuffle.
    stored = (
        rows.filter("same is not null")
        .groupBy("same")
        .agg(F.max(F.struct("page_id", (-F.col("row")).alias("place"))).alias("stored"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    revisits = ~F.col("page_id").eqNullSafe(F.col("stored.page_id"))
    placed = rows.join(stored, "same", "left").select(
        "page_id", "url", "payload", "row", F.when(revisits, F.col("stored.page_id")).alias("refers_to"),
        (-F.col("stored.place")).alias("refers_row"),
    )
    records = placed.mapInArrow(pages_to_records, "value binary")
    writer = records.select(F.col("value").cast("string")).write.mode("overwrite")
    writer.options(lineSep=RECORD_END, compression="gzip", maxRecordsPerFile=RECORDS_PER_FILE).text(folder)


RECORD_SCHEMA = pa.schema(
    [
        ("name", pa.string()),
        ("kind", pa.string()),
        ("origin", pa.string()),
        ("segment", pa.int64()),
        ("total", pa.int64()),
        ("label", pa.string()),
        ("refers", pa.string()),
        ("block", pa.binary()),
    ]
)
RECORDS = (
    "name string, kind string, origin string, segment long, total long, label string, refers string, block binary"
)


def parsed_record(data: bytes) -> dict:
    """A record whose mark the reader has taken away; raises ValueError if it was cut at the wrong place."""
    head, _, rest = data.partition(b"\r\n\r\n")
    kind, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    if len(rest) < size or rest[size:].strip():
        raise ValueError(f"{fields.get('warc-record-id')}: the block is not as long as its header says")
    segment, total = fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
    name = fields.get("warc-record-id")
    return {
        "name": name,
        "kind": kind.strip(),
        "origin": fields.get("warc-segment-origin-id") or (name if segment else None),
        "segment": int(segment) if segment else None,
        "total": int(total) if total else None,
        "label": fields.get("warc-payload-digest"),
        "refers": fields.get("warc-refers-to"),
        "block": rest[:size],
    }


def rows_to_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = [parsed_record(data) for data in batch["value"].to_pylist() if data]
        yield pa.RecordBatch.from_pylist(out, RECORD_SCHEMA)


def reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records from segments that come sorted by origin and number; repeated segments count once."""
    first, parts, number = None, [], 0

    def whole() -> dict:
        block = b"".join(parts)
        if first["total"] != len(block):
            raise ValueError(f"{first['name']}: segments of {len(block)} bytes, not {first['total']}")
        return {**first, "segment": None, "total": None, "block": block}

    for batch in slices(batches, 16):
        done = []
        for row in batch.to_pylist():
            if first is None or row["origin"] != first["origin"]:
                if first is not None:
                    done.append(whole())
                if row["segment"] != 1:
                    raise ValueError(f"{row['origin']}: the first segment is missing")
                first, parts, number = row, [row["block"]], 1
            elif row["segment"] == number + 1:
                parts.append(row["block"])
                number += 1
                first["total"] = row["total"] if row["total"] is not None else first["total"]
            elif row["segment"] != number:
                raise ValueError(f"{row['origin']}: segment {number + 1} is missing")
        if done:
            yield pa.RecordBatch.from_pylist(done, RECORD_SCHEMA)
    if first is not None:
        yield pa.RecordBatch.from_pylist([whole()], RECORD_SCHEMA)


PAYLOAD_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("kind", pa.string()),
        ("refers_to", pa.int64()),
        ("label", pa.string()),
        ("payload", pa.binary()),
    ]
)


def records_to_payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for row in batch.to_pylist():
            payload = None
            if row["kind"] == "response":
                payload = http_payload(row["block"])
                if row["label"] and row["label"].startswith("sha1:") and row["label"] != payload_label(payload):
                    raise ValueError(f"{row['name']}: the payload does not match its digest")
            out.append(
                {
                    "page_id": page_of(row["name"]),
                    "kind": row["kind"],
                    "refers_to": page_of(row["refers"]),
                    "label": row["label"],
                    "payload": payload,
                }
            )
        yield pa.RecordBatch.from_pylist(out, PAYLOAD_SCHEMA)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of archives whose records start with the version and the type, segments put together.

    A record that is cut short, lacks a segment or has another total length
    than stated ends the job with a message that names it. Segments of a
    record are sorted by Spark; a task holds one record at a time.
    """
    bound_batches(spark)
    lines = spark.read.option("lineSep", MARK).text(folder).select(F.col("value").cast("binary"))
    records = lines.mapInArrow(rows_to_records, RECORDS)
    cut = records.filter("segment is not null").repartition("origin").sortWithinPartitions("origin", "segment")
    return records.filter("segment is null").unionByName(cut.mapInArrow(reassembled, RECORDS))


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of archives: page_id, kind, refers_to, label (the stated digest) and payload (null for revisits).

    A payload that does not match its stated digest ends the job.
    """
    return read_records(spark, folder).mapInArrow(
        records_to_payloads, "page_id long, kind string, refers_to long, label string, payload binary"
    )


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write pages as archives, read them back and return the facts of each page's full payload.

    Revisits take them from the response they refer to. There is a row for
    every page row, repeated ones included; an empty table gives an empty
    result. Archives lie below the shared folder.
    """
    spark = pages.sparkSession
    folder = work_dir(spark)
    write_pages(pages, f"{folder}/archives")
    facts = read_pages(spark, f"{folder}/archives").select(
        "page_id",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
        "label",
    )
    facts = snapshot(facts, f"{folder}/facts")
    responses = facts.filter("record_type = 'response'")
    sources = responses.select(
        F.col("page_id").alias("refers_to"), "label", "payload_bytes", "payload_digest"
    ).distinct()
    revisits = facts.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    resolved = revisits.join(sources, ["refers_to", "label"], "left")
    return responses.unionByName(resolved).drop("label")
