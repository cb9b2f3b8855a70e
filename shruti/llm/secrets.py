"""Secret scan with structural confirmation.

Three base patterns (assignments, access key ids, long hex runs) are reported
as they match. Beyond them, candidates are confirmed by structure before they
are reported: base64 and hex runs are decoded and must parse as a private key
(DER with nested lengths that add up, or an OpenSSH key container), tokens must
have a signed-token header, and PEM blocks must hold such a key.

One pass over the rows, no shuffle. Defined results: a null or empty text has
no spans; repeated rows are reported each; an empty table gives no rows; other
columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, per_batch, strings

#: Fixed patterns of the base scan, in their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_HINT = re.compile(r"pass|secret|token|api", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ORDER = ("assign", "access", "hex", "pem", "key_base64", "key_hex", "signed_token")

PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----\s*((?:[A-Za-z0-9-]+:[^\n]*\n(?:[ \t][^\n]*\n)*)*)([A-Za-z0-9+/=\s]+)-----END \1-----")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
LONG_HEX = re.compile(r"(?:[0-9a-f]{64,}|[0-9A-F]{64,})")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
#: Object identifiers of key algorithms (RSA, EC, DSA, Ed25519, X25519), as DER contents.
KEY_OIDS = {bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce3d0201", "2a8648ce380401", "2b6570", "2b656e")}


def der(data: bytes, at: int, end: int, depth: int = 0) -> list | None:
    """The DER values in ``data[at:end]`` as (tag, contents or values), or None if lengths don't add up."""
    out: list = []
    while at < end:
        if at + 2 > end or depth > 8:
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 128:
            k = n & 127
            if not 1 <= k <= 4 or at + k > end:
                return None
            n = int.from_bytes(data[at : at + k], "big")
            at += k
            if n < 128:
                return None
        if at + n > end:
            return None
        value = der(data, at, at + n, depth + 1) if tag & 32 else data[at : at + n]
        if value is None:
            return None
        out.append((tag, value))
        at += n
    return out


def is_private_key(data: bytes) -> bool:
    """PKCS#1, SEC 1 or PKCS#8 (plain or encrypted), or an OpenSSH private key container."""
    if data.startswith(b"openssh-key-v1\0"):
        at = 15
        for _ in range(3):  # cipher, derivation, its options
            if at + 4 > len(data):
                return False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 16
    if len(data) < 32 or data[0] != 0x30:
        return False
    parsed = der(data, 0, len(data))
    if not parsed or len(parsed) != 1:
        return False
    top = parsed[0][1]
    tags = [t for t, _ in top]
    if tags[:9] == [2] * 9 and top[0][1] in (b"\0", b"\1"):
        return True
    if tags[:2] == [2, 4] and top[0][1] == b"\1":
        return True
    if tags[:3] == [2, 0x30, 4] and top[0][1] in (b"\0", b"\1"):
        return bool(top[1][1]) and top[1][1][0][0] == 6 and top[1][1][0][1] in KEY_OIDS
    return tags == [0x30, 4] and bool(top[0][1]) and top[0][1][0][0] == 6 and len(top[1][1]) >= 32


def is_pem_key(headers: str, data: bytes) -> bool:
    """A private key, or one that its headers call encrypted: whole cipher blocks."""
    encrypted = re.search(r"^DEK-Info:\s*[A-Z0-9-]+,\s*(?:[0-9A-Fa-f]{2}){8,16}\s*$", headers, re.M) and re.search(r"^Proc-Type:\s*4,\s*ENCRYPTED\s*$", headers, re.M)
    return len(data) >= 32 and len(data) % 8 == 0 if encrypted else is_private_key(data)


def from_base64(text: str) -> bytes:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def is_signed_token(text: str) -> bool:
    """A JSON header that names an algorithm other than none, a payload and a signature that decode."""
    head, body, signature = text.split(".", 2)
    try:
        header = json.loads(from_base64(head))
    except (ValueError, UnicodeDecodeError, RecursionError):
        return False
    named = isinstance(header, dict) and isinstance(header.get("alg"), str) and header["alg"].lower() != "none"
    return named and bool(from_base64(body)) and bool(from_base64(signature))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    if ASSIGN_HINT.search(text):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    if "-----BEGIN " in text:
        found += [(*m.span(), "pem") for m in PEM.finditer(text) if is_pem_key(m[2], from_base64(re.sub(r"\s", "", m[3])))]
    found += [(*m.span(), "key_base64") for m in BASE64.finditer(text) if is_private_key(from_base64(m[0]))]
    found += [(*m.span(), "key_hex") for m in LONG_HEX.finditer(text) if len(m[0]) % 2 == 0 and is_private_key(bytes.fromhex(m[0]))]
    if "eyJ" in text:
        found += [(*m.span(), "signed_token") for m in JWT.finditer(text) if is_signed_token(m[0])]
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], ORDER.index(s[2]), s[1])))


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (all spans, base ones among them) of each row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[list] = [[], [], [], [], []]
        for text in strings(batch):
            base = base_spans(text)
            kinds = [s[2] for s in base]
            listed = joined(base)
            more = confirmed_spans(text)
            values = (*map(kinds.count, ORDER[:3]), hashlib.sha256(listed.encode()).hexdigest(), joined(base + more) if more else listed)
            for c, v in zip(rows, values):
                c.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(c, k) for c, k in zip(rows, kinds))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(per_batch(run), SCHEMA)
