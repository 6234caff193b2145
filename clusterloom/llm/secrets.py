"""Secret scans that confirm candidates by their structure.

Three pattern kinds are reported as they match. Base64 and hex runs are
candidates only: they are decoded, and reported when the bytes are a key
encoding whose nested lengths fill it exactly, or a signed token whose header
is a JSON object that names an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.batches import bound_batches, slices, text_frame, texts_of

#: In the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "jwt", "der", "ssh")

MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_BASE64 = 8, 16, 32, 32
MAX_DEPTH = 12

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I
)
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
JWT = re.compile(rb"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
PEM = re.compile(
    rb"-----BEGIN [A-Z0-9 ]*(?:KEY|CERTIFICATE)-----([A-Za-z0-9+/=\s]*)-----END [A-Z0-9 ]*(?:KEY|CERTIFICATE)-----"
)


def class_table(members: bytes) -> bytes:
    """A translation table that turns members into 1 and other bytes into a blank."""
    return bytes(49 if byte in members else 32 for byte in range(256))


_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
LOWER_HEX = class_table(_DIGITS + b"abcdef")
ANY_HEX = class_table(_DIGITS + b"abcdefABCDEF")
BASE64 = class_table(_DIGITS + _UPPER + _UPPER.lower() + b"+/=-_")


def runs(data: bytes, table: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least ``least`` bytes of a class."""
    marks = data.translate(table)
    needle = b"1" * least
    start = marks.find(needle)
    while start >= 0:
        end = marks.find(b" ", start + least)
        end = len(marks) if end < 0 else end
        yield start, end
        start = marks.find(needle, end)


def tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the contents of one DER element, or None."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length >= 0x80:
        count = length & 0x7F
        if not 1 <= count <= 4 or at + count > end:
            return None
        length, at = int.from_bytes(data[at : at + count], "big"), at + count
        if length < 0x80:  # the short form was due
            return None
    return (tag, at, at + length) if at + length <= end else None


def filled(data: bytes, at: int, end: int, depth: int = 0) -> bool:
    """Do DER elements, nested ones too, fill the range exactly?"""
    if depth > MAX_DEPTH:
        return False
    while at < end:
        found = tlv(data, at, end)
        if found is None:
            return False
        tag, start, at = found
        if tag & 0x20 and not filled(data, start, at, depth + 1):
            return False
    return True


def is_der_key(data: bytes) -> bool:
    """A sequence that fills the bytes and starts with a version or another sequence."""
    outer = tlv(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data) or len(data) < 24:
        return False
    first = tlv(data, outer[1], outer[2])
    return first is not None and first[0] in (0x02, 0x30) and filled(data, outer[1], outer[2])


def is_ssh_key(data: bytes) -> bool:
    """The private key container, or length-prefixed fields that fill a public key."""
    if data.startswith(b"openssh-key-v1\0"):
        return True
    at, fields = 0, []
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return at == len(data) and len(fields) > 1 and fields[0].startswith((b"ssh-", b"ecdsa-sha2-"))


def key_kind(data: bytes) -> str | None:
    return "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def from_base64(run: bytes) -> bytes | None:
    """Decoded bytes of either alphabet, padded or not."""
    plain = run.translate(bytes.maketrans(b"-_", b"+/")).rstrip(b"=")
    try:
        return base64.b64decode(plain + b"=" * (-len(plain) % 4), validate=True)
    except binascii.Error:
        return None


def may_be_key(run: bytes) -> bool:
    """Do the first bytes fit a key of this length? Spares decoding long runs again and again."""
    head, size = from_base64(run[:24]) or b"", len(run.rstrip(b"=")) * 3 // 4
    if head[:1] == b"\x30":
        count = head[1] & 0x7F if head[1] & 0x80 else 0
        length = int.from_bytes(head[2 : 2 + count], "big") if count else head[1]
        return 2 + count + length == size
    return head.startswith(b"openssh-key-v1") or head[4:].startswith((b"ssh-", b"ecdsa-sha2-"))


def is_token_header(part: bytes) -> bool:
    data = from_base64(part)
    try:
        header = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def base_spans(data: bytes) -> list[tuple[str, int, int]]:
    """Byte spans of the pattern kinds."""
    found = []
    low = data.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        for match in ASSIGN.finditer(data):
            if match.end(2) - match.start(2) >= MIN_VALUE:
                found.append(("assign", *match.span()))
    if b"AKIA" in data:
        for match in ACCESS.finditer(data):
            if match.end() - match.start() >= MIN_ACCESS:
                found.append(("access", *match.span()))
    found.extend(("hex", start, end) for start, end in runs(data, LOWER_HEX, MIN_HEX))
    return found


def confirmed_spans(data: bytes) -> list[tuple[str, int, int]]:
    """Byte spans of candidates whose decoded structure holds."""
    found = []
    if b"eyJ" in data:
        for match in JWT.finditer(data):
            if is_token_header(match.group(1)):
                found.append(("jwt", *match.span()))
    if b"-----BEGIN " in data:
        for match in PEM.finditer(data):
            body = from_base64(b"".join(match.group(1).split()))
            kind = key_kind(body) if body else None
            if kind:
                found.append((kind, *match.span()))
    taken = [(start, end) for _, start, end in found]
    for start, end in runs(data, BASE64, MIN_BASE64):
        if any(start < b and a < end for a, b in taken):
            continue
        # A name or sign may touch the candidate from the left, so later starts are tried after each sign.
        starts = [start] + [start + m.end() for m in re.finditer(rb"[=_-]+", data[start:end]) if m.end() < end - start]
        for begin in starts:
            run = data[begin:end]
            body = from_base64(run) if len(run) >= MIN_BASE64 and may_be_key(run) else None
            kind = key_kind(body) if body else None
            if kind:
                found.append((kind, begin, end))
                break
    for start, end in runs(data, ANY_HEX, 2 * 24):
        run = data[start:end]
        if len(run) % 2 == 0 and (kind := key_kind(binascii.unhexlify(run))):
            found.append((kind, start, end))
    return found


def spans_of(data: bytes) -> list[tuple[str, int, int]]:
    """All spans of a text in code points, by start, then kind."""
    found = base_spans(data) + confirmed_spans(data)
    if not found:
        return found
    if not data.isascii():
        cuts = sorted({cut for _, start, end in found for cut in (start, end)})
        points, place, last = 0, {}, 0
        for cut in cuts:
            points += len(data[last:cut].decode("utf-8", "replace"))
            place[cut], last = points, cut
        found = [(kind, place[start], place[end]) for kind, start, end in found]
    return sorted(set(found), key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def scan_in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in slices(batches):
        rows = [
            [{"kind": k, "start": a, "end": b} for k, a, b in spans_of(data)] for data in texts_of(batch["text"])
        ]
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(rows, kind)], ["id", "spans"])


def scan_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans of secrets in every text: one row per input row with the id and ``spans``.

    Spans are (kind, start, end) in code points, end exclusive, by start, then
    kind in the order of ``KINDS``. A missing or empty text has none. Repeated
    rows are scanned each; other columns are ignored. One pass, no shuffle.
    """
    rows = text_frame(df, id_column, text_column)
    schema = f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}"
    return rows.mapInArrow(scan_in_batches, schema).withColumnRenamed("id", id_column)


def redacted_text(data: bytes, mask: str) -> str:
    """The text with each maximal run of covered code points replaced by ``mask``."""
    text = data.decode("utf-8", "replace")
    kept, last = [], 0
    for _, start, end in spans_of(data):
        if end <= last:
            continue
        if start > last or last == 0:
            kept += [text[last:start], mask]
        last = end
    return "".join([*kept, text[last:]])


def redact_secrets(df: DataFrame, text_column: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with secrets in the text replaced; a missing text stays missing."""

    bound_batches(df.sparkSession)

    def redact(column: pa.Array) -> pa.Array:
        return pa.array(
            [None if data is None else redacted_text(data, mask) for data in column.cast(pa.binary()).to_pylist()],
            pa.string(),
        )

    return df.withColumn(text_column, F.arrow_udf(redact, "string")(F.col(text_column).cast("string")))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets_digest(spans: DataFrame) -> DataFrame:
    """Counts per pattern kind, a digest of their spans, and all spans as text."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return spans.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(spans_text(of(*KINDS[:3])), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        F.size(of(*KINDS[3:])).cast("bigint").alias("n_confirmed"),
    )
