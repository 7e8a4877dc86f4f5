"""Secrets in texts: base patterns, and candidates confirmed by their inner structure.

Base kinds are assignments to a key-like name, access-key ids and hexadecimal runs.  Beyond
them, long runs of the standard or the URL-safe base64 alphabet or of hexadecimal digits, after
``0x`` or anything else, are decoded and reported only if what they hold parses:

``jwt``     a signed token: header and claims are JSON objects and the header names an algorithm
``key``     a private key: a DER sequence whose nested lengths add up and whose first members
            are those of an RSA, EC or PKCS#8 key, or an OpenSSH key with consistent fields
``pem``     a PEM block of a private key whose body is such a key
``nested``  encoded text that holds a base assignment, an access-key id or, up to ``NESTING``
            levels down, any of the kinds above

A signed token is looked for among every three neighbouring segments of a dotted run, so names
before it do not hide it.  All searches take time in proportion to the text, whatever it holds.

Spans are in code points, end exclusive, ordered by start, then by kind as listed in
``KINDS``, then by end.  A null text counts as empty; an empty text has no spans; texts are
searched whole, and equal texts have equal spans.  An empty table gives an empty result.  Only
the key and the text are read, so other columns play no part.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "jwt", "key", "pem", "nested")
ORDER = {kind: i for i, kind in enumerate(KINDS)}
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that have 16 characters or more
RUN = re.compile(r"[A-Za-z0-9+/_=.-]{24,}")
URL_SAFE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
ALPHABETS = (re.compile(r"[A-Za-z0-9+/]{24,}={0,2}"), re.compile(r"[A-Za-z0-9_-]{24,}={0,2}"))
LONG_HEX = re.compile(r"[0-9a-fA-F]{48,}")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)"
                 r"-----END \1-----")
DEPTH = 16
NESTING = 3

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    if ":" in text or "=" in text:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def der_members(data: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """Tags and contents of consecutive DER values that fill ``data``, else None.

    Lengths must be minimal and constructed values must themselves be filled.
    """
    members, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or depth > DEPTH:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            count = size & 0x7F
            if not 1 <= count <= 4 or at + count > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at:at + count], "big")
            at += count
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        content = data[at:at + size]
        if tag & 0x20 and der_members(content, depth + 1) is None:
            return None
        members.append((tag, content))
        at += size
    return members


def is_der_key(data: bytes) -> bool:
    """A private key of PKCS#1, SEC 1 or PKCS#8, plain or encrypted."""
    outer = der_members(data) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    members = der_members(outer[0][1]) or []
    tags = [tag for tag, _ in members]
    if len(tags) >= 9 and set(tags[:9]) == {0x02}:
        return members[0][1] in (b"\0", b"\1")  # RSA: version and eight numbers
    if tags[:2] == [0x02, 0x04]:
        return members[0][1] == b"\1" and len(members[1][1]) >= 16  # EC
    if tags[:3] == [0x02, 0x30, 0x04]:
        inner = der_members(members[1][1]) or [(0, b"")]
        return members[0][1] in (b"\0", b"\1") and inner[0][0] == 0x06  # PKCS#8
    if tags == [0x30, 0x04]:
        inner = der_members(members[0][1]) or [(0, b"")]
        return inner[0][0] == 0x06 and len(members[1][1]) >= 16  # PKCS#8, encrypted
    return False


def is_openssh_key(data: bytes) -> bool:
    """Magic, then cipher, derivation, its options, a count, public and private parts."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size:at]

    head = [field() for _ in range(3)]
    if None in head:
        return False
    count = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= count <= 64:
        return False
    parts = [field() for _ in range(count + 1)]
    return None not in parts and not data[at:].strip(b"\0")


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def unbase64(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _object(text: str) -> dict | None:
    data = unbase64(text)
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, claims: str) -> bool:
    head = _object(header)
    return bool(head) and isinstance(head.get("alg"), str) and _object(claims) is not None


def holds_secret(data: bytes, level: int) -> bool:
    """Encoded plain text with a base assignment, an access-key id or a confirmed secret."""
    try:
        inner = data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return any(kind != "hex" for kind, _, _ in base_spans(inner)) or bool(
        PEM.search(inner)) or level <= NESTING and bool(confirmed_spans(inner, level))


def signed_tokens(run: str) -> Iterator[tuple[int, int]]:
    """Bounds of signed tokens among the dotted parts of a run: the end of one, a whole one and
    the start of a third."""
    parts, at, last = run.split("."), 0, 0
    for i in range(len(parts) - 2):
        first, second, third = parts[i:i + 3]
        header = len(first.rstrip(URL_SAFE))
        if (at + header >= last and len(first) - header >= 8 and len(second) >= 2
                and not second.strip(URL_SAFE) and is_signed_token(first[header:], second)):
            last = at + len(first) + len(second) + 2 + len(third) - len(third.lstrip(URL_SAFE))
            yield at + header, last
        at += len(first) + 1


def decoded(run: str) -> list[tuple[int, int, bytes]]:
    """Bounds and bytes of the longest runs of either base64 alphabet and of hexadecimal digits,
    the longer ones first."""
    found = {(*m.span(), unbase64(m[0])) for p in ALPHABETS for m in p.finditer(run)}
    found |= {(*m.span(), bytes.fromhex(m[0])) for m in LONG_HEX.finditer(run)
              if len(m[0]) % 2 == 0}
    return sorted(((s, e, data) for s, e, data in found if data),
                  key=lambda f: (f[0] - f[1], f[0]))


def _free(taken: list[tuple[int, int]], start: int, end: int) -> int | None:
    """Where a span goes among sorted ones that it does not overlap, else None."""
    i = bisect_left(taken, (start, end))
    before, after = taken[i - 1:i], taken[i:i + 1]
    clash = before and before[0][1] > start or after and after[0][0] < end
    return None if clash else i


def confirmed_spans(text: str, level: int = 0) -> list[Span]:
    """Candidates whose decoded structure holds a secret; ``level`` encodings further in."""
    spans: list[Span] = []
    if "-----BEGIN " in text:
        for found in PEM.finditer(text):
            data = unbase64("".join(found[2].split()))
            if data and is_key(data):
                spans.append(("pem", *found.span()))
    for run in RUN.finditer(text):
        start, body = run.start(), run[0]
        spans += [("jwt", start + at, start + end) for at, end in signed_tokens(body)]
        taken: dict[str, list[tuple[int, int]]] = {"key": [], "nested": []}
        for at, end, data in decoded(body):
            for kind, own in taken.items():
                i = _free(own, at, end)
                if i is not None and (
                        is_key(data) if kind == "key" else holds_secret(data, level + 1)):
                    own.insert(i, (at, end))
        spans += [(kind, start + at, start + end) for kind, own in taken.items()
                  for at, end in own]
    return spans


def joined(spans: list[Span]) -> str:
    spans = sorted(set(spans), key=lambda s: (s[1], ORDER[s[0]], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, counts of the base kinds, base spans and all spans of each row's text."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body in batch.column(1).to_pylist():
                base = base_spans(body) if body else []
                more = confirmed_spans(body) if body else []
                kinds = [k for k, _, _ in base]
                rows.append((*(kinds.count(k) for k in KINDS[:3]), joined(base),
                             joined(base + more)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]),
                 *(pa.array(c, pa.string()) for c in columns[3:])],
                names=[key, "n_assign", "n_access", "n_hex", "base_spans", "spans"])

    return df.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_assign long, n_access long, n_hex long, "
             "base_spans string, spans string")


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.select(key, "n_assign", "n_access", "n_hex",
                        F.sha2("base_spans", 256).alias("base_sha256"), "spans")
