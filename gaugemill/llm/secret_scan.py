"""Secret scan: patterns propose spans, and what looks encoded is decoded and parsed before it is reported.

Base kinds (assign, access, hex) are reported as matched. Candidates of the method are confirmed by structure:

* ``jwt``: three base64url parts, the first two JSON objects, the header with an ``alg``;
* ``pem``: an armoured block whose body, after header lines if there are any, is base64 of a DER sequence with consistent
  nested lengths, of an OpenSSH key of length-prefixed fields, or, where the headers name a cipher, of whole cipher blocks;
* ``der``: a bare base64 or hex run that decodes to such a sequence with an integer or an object id in it;
* ``basic``: ``Basic`` credentials that decode to ``user:password``, or ``scheme://user:password@`` (the user may be empty).

One pass over the rows, no shuffle; each batch is read with compiled patterns whose repeats can't overlap.

Defined results: a NULL or empty text has no spans; equal rows have equal spans; columns other than the id and the text
are not read. Spans are in code points, end exclusive, by start and then by kind in the order above.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.llm._rows import map_texts, numbered

# The base kinds, their patterns and lengths.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
VALUE_LENGTH = 6

JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40})KEY-----((?:(?!-----).)+)-----END ([A-Z0-9 ]{0,40})KEY-----", re.DOTALL)
HEADER = re.compile(r"([A-Za-z][A-Za-z0-9-]*):[ \t]*(.*)")
CIPHER = re.compile(r"[A-Za-z0-9-]+,[0-9A-Fa-f]{16,}")
ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
BASIC = re.compile(r"(?<![A-Za-z])Basic ([A-Za-z0-9+/]{8,}={0,2})")
URL = re.compile(r"""://[^\s/?#:@"'<>]*:[^\s/?#"'<>]+@""")
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
KINDS = (*BASE, "jwt", "pem", "der", "basic")
DEPTH = 8
OPENSSH = b"openssh-key-v1\0"
LONGEST_SCHEME = 40


def decoded(text: str) -> bytes | None:
    """Bytes of a hex or base64 text in either alphabet; None if it is neither."""
    if len(text) % 2 == 0 and re.fullmatch("[0-9a-fA-F]+", text):
        return bytes.fromhex(text)
    bare = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(bare) % 4 == 1:
        return None
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_tags(data: bytes, depth: int = 0) -> list[int] | None:
    """Tags of a DER value and all values within, None unless every length fits exactly."""
    tags, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > len(data):
            return None
        tags.append(tag)
        if tag & 0x20:
            inner = der_tags(data[at : at + size], depth + 1) if depth < DEPTH else None
            if inner is None:
                return None
            tags += inner
        at += size
    return tags


def is_key(data: bytes | None) -> bool:
    """One DER sequence over all bytes that holds an integer or an object id."""
    if not data or data[0] != 0x30 or len(data) < 16:
        return False
    tags = der_tags(data)
    return bool(tags) and tags.count(0x30) >= 1 and (0x02 in tags or 0x06 in tags) and len(tags) >= 3


def is_openssh_key(data: bytes | None) -> bool:
    """The fields of an OpenSSH private key (cipher, derivation, its options, public keys, private part), nothing after."""
    if not data or not data.startswith(OPENSSH):
        return False
    at, fields, left = len(OPENSSH), 0, 3
    while left:
        if at + 4 > len(data):
            return False
        size, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        at, fields, left = at + size, fields + 1, left - 1
        if at > len(data):
            return False
        if fields == 3:  # the number of public keys, each a field, then the private part
            n, at = int.from_bytes(data[at : at + 4], "big"), at + 4
            if not 1 <= n <= len(data):
                return False
            left = n + 1
    return at == len(data)


def is_armoured_key(body: str) -> bool:
    """Header lines (each may go on in indented lines), then base64 of a key."""
    lines, headers, at = body.strip().splitlines(), {}, 0
    while at < len(lines) and ((m := HEADER.match(lines[at])) or (headers and lines[at][:1] in (" ", "\t") and lines[at].strip())):
        if m:
            headers[m[1].lower()] = m[2].strip()
        at += 1
    data = decoded("".join("".join(lines[at:]).split()))
    if "ENCRYPTED" in headers.get("proc-type", "") and CIPHER.fullmatch(headers.get("dek-info", "")):
        return bool(data) and len(data) % 8 == 0
    return is_key(data) or is_openssh_key(data)


def url_start(text: str, at: int) -> int | None:
    """Where the scheme before ``at`` starts; None if there is none."""
    m = SCHEME.search(text[max(0, at - LONGEST_SCHEME) : at])
    return None if m is None else at - len(m[0])


def is_signed_token(header: str, claims: str) -> bool:
    for part, needed in ((header, "alg"), (claims, None)):
        data = decoded(part + "=" * (-len(part) % 4))
        try:
            value = json.loads(data) if data else None
        except (ValueError, RecursionError):
            return False
        if not isinstance(value, dict) or (needed and needed not in value):
            return False
    return True


def is_credentials(data: bytes | None) -> bool:
    try:
        user, colon, password = data.decode("utf-8").partition(":") if data else ("", "", "")
    except UnicodeDecodeError:
        return False
    return bool(colon and user and password and (user + password).isprintable())


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every span of a text."""
    text = text or ""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= VALUE_LENGTH]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "eyJ" in text:
        found += [("jwt", *m.span()) for m in JWT.finditer(text) if is_signed_token(m[1], m[2])]
    if "-----BEGIN" in text:
        found += [("pem", *m.span()) for m in PEM.finditer(text) if is_armoured_key(m[2])]
    found += [("der", *m.span()) for m in ENCODED.finditer(text) if is_key(decoded(m[0]))]
    if "Basic " in text:
        found += [("basic", *m.span()) for m in BASIC.finditer(text) if is_credentials(decoded(m[1]))]
    if "://" in text:
        found += [("basic", at, m.end()) for m in URL.finditer(text) if (at := url_start(text, m.start())) is not None]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def span_list(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: id, counts and digest of the base kinds, and all spans as text."""

    def start():
        def scan(texts: list) -> list[pa.Array]:
            spans = [find_secrets(t) for t in texts]
            base = [[s for s in found if s[0] in BASE] for found in spans]
            counts = [pa.array([sum(s[0] == k for s in found) for found in base], pa.int64()) for k in BASE]
            digests = [hashlib.sha256(span_list(found).encode()).hexdigest() for found in base]
            return [*counts, pa.array(digests, pa.string()), pa.array([span_list(found) for found in spans], pa.string())]

        return scan

    return map_texts(docs, [doc_id], text, start, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span replaced; overlapping spans become one mark."""
    if not text:
        return text
    out, done = [], 0
    for _, start, end in find_secrets(text):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join(out) + text[done:]


def without_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``, every secret in the text replaced by the mark."""
    rows, names = numbered(docs, text)

    def start():
        return lambda texts: [pa.array([redacted(t, mark) for t in texts], pa.string())]

    done = map_texts(rows, names, "text", start, "redacted string")
    return done.select(*[F.col("redacted" if c == text else n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
