import base64
import json
import re

from clusterloom.llm.secrets import redact_secrets, scan_secrets, secrets_digest, spans_of
from tests.llm.rows import TEXTS, frame


def der(tag, body):
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


KEY = der(0x30, der(2, b"\0") + der(2, bytes(range(1, 130))) + der(2, b"\1\0\1") + der(0x30, der(5, b"")))
SSH = b"".join(len(p).to_bytes(4, "big") + p for p in (b"ssh-ed25519", bytes(range(32))))


def b64(data):
    return base64.b64encode(data).decode()


def token(header):
    parts = [json.dumps(header).encode(), b'{"sub":"1"}', bytes(range(20))]
    return ".".join(base64.urlsafe_b64encode(p).decode().rstrip("=") for p in parts)


def kinds(text):
    return [kind for kind, _, _ in spans_of(text.encode())]


def test_structure_is_confirmed():
    assert kinds(f"é key {b64(KEY)} end") == ["der"]
    assert kinds(f"{b64(SSH)}") == ["ssh"]
    assert kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{b64(KEY)}\n-----END RSA PRIVATE KEY-----") == ["der"]
    assert "der" in kinds(KEY.hex())
    assert kinds(token({"alg": "HS256"})) == ["jwt"]
    assert kinds("id=" + b64(KEY)) == ["der"]


def test_what_only_looks_alike_is_not_reported():
    assert kinds(b64(KEY[:-1])) == []
    assert kinds(b64(bytes(range(60)))) == []
    assert kinds(token({"typ": "JWT"})) == []
    assert kinds(b64(b"\x30\x30" + bytes(48))) == []
    assert kinds("A-" * 50_000) == []


def test_spans_are_code_points():
    text = f"ñé 日本 {b64(KEY)}. password='äx' token: 'abcdefgh'"
    (kind, start, end), assign = spans_of(text.encode())
    assert text[start:end] == b64(KEY)
    assert text[assign[1] : assign[2]] == "token: 'abcdefgh"


def brute(text):
    """The pattern kinds as stated, by code points."""
    found = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, text, re.I | re.A):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 16:
            found.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m.group()) >= 32:
            found.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return ",".join(text for _, _, text in sorted(found))


def test_every_row_equals_brute_force(spark):
    extra = [(20, "API_KEY='é' PassWord := aaaaaaaaaa ſecret=bbbbbbbbbb passwd=short SECRET==12345678é" + "af" * 20)]
    found = secrets_digest(scan_secrets(frame(spark, TEXTS + extra))).collect()
    import hashlib

    expected = [(name, hashlib.sha256(brute(text or "").encode()).hexdigest()) for name, text in TEXTS + extra]
    assert sorted(map(repr, [(r["doc_id"], r["base_sha256"]) for r in found])) == sorted(map(repr, expected))
    assert scan_secrets(frame(spark, [])).collect() == []


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r["doc_id"]: r["spans"] for r in secrets_digest(scan_secrets(docs)).collect()}
    for row in docs.collect():
        base = [s for s in found[row["doc_id"]].split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert ",".join(base) == brute(row["text"] or "")


def test_redaction(spark):
    rows = {r["doc_id"]: r["text"] for r in redact_secrets(frame(spark)).collect()}
    assert rows[-11] == "[SECRET] [SECRET] [SECRET]"
    assert rows[3] is None and rows[4] == ""
    assert redact_secrets(frame(spark)).columns == frame(spark).columns
