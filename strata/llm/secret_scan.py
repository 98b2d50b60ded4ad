"""Secret scan with structural confirmation.

A pattern match alone says little, so beside the three base patterns a candidate
is reported only after its structure has been parsed: base64 or hex is decoded
and must be a private key whose nested lengths fit exactly, and a dotted token
must have a signed-token header and a JSON payload.  Framed keys may have escaped
line ends and header lines; a body that its headers call encrypted must be base64 of
whole cipher blocks.  Base64 without a frame may go on over single line ends.

Kinds: ``assign``, ``access``, ``hex`` (base patterns) and ``pem``, ``der``,
``openssh``, ``jwt`` (confirmed by parsing).  Spans are code-point offsets, end
exclusive, ordered by start, then by kind as listed.

Defined cases: null and empty texts have no spans; texts are scanned whole, in
time linear in their length; repeated rows are scanned each; other columns pass
through and ``out`` replaces a column of that name.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Order of kinds within one start (fixed values).
KINDS = ("assign", "access", "hex", "pem", "der", "openssh", "jwt")
BASE_KINDS = KINDS[:3]
SPANS_TYPE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))

#: Base patterns (fixed values); letters of the keywords in either case.
ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ ){0,3})PRIVATE KEY-----((?:[^-]++|-(?!----))*+)-----END \1PRIVATE KEY-----")
#: Within a frame: line ends and slashes as source strings escape them, ends of such strings, header lines (RFC 1421).
ESCAPED_END = re.compile(r"\\+(?:[nrt]|u000[aAdD]|x0[aAdD]|(?=\s|$))")
ESCAPED_SLASH = re.compile(r"\\+/")
STRING_ENDS = re.compile(r"[\"'`][\s,;.)(\]\[]*\+?[\s,;.)(\]\[]*(?:[\"'`]|$)")
HEADER = re.compile(r"^[ \t\"'`]*([A-Za-z][A-Za-z0-9-]*):[ \t]*(.*?(?:\\\s*\n.*?)*)[ \t\r]*$", re.M)
DEK_INFO = re.compile(r"[A-Z0-9-]+,(?:[0-9A-Fa-f]{16}|[0-9A-Fa-f]{32})")
#: Base64 wrapped over lines: pieces with one line end, plain or escaped, between them.
LINE_END = r"(?:\r?\n|(?:\\+r)?\\+n)[ \t]*"
WRAPPED = re.compile(rf"(?:(?<![A-Za-z0-9+/_\\-])|(?<=\\[nrt]))[A-Za-z0-9+/_-]{{16,}}+(?:{LINE_END}[A-Za-z0-9+/_-]++)++")
PIECES = re.compile(rf"([A-Za-z0-9+/_-]++)(?:{LINE_END})?")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{40,}")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_KEY = re.compile(r"[0-9A-Fa-f]{64,}")
SEGMENT = re.compile(r"[A-Za-z0-9_-]+")
WORDS_OF_ASSIGN = ("password", "passwd", "secret", "token", "apikey", "api_key")
OPENSSH_MAGIC = b"openssh-key-v1\x00"
#: First characters of base64 of a DER sequence and of an OpenSSH key; elements of a private key at most.
DER_START, OPENSSH_START, MOST_PARTS = "M", "b3BlbnNzaC1rZXktdjE", 16
#: Object identifiers (PKCS#5 and PKCS#12) under which a PKCS#8 key is encrypted.
PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def decode64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, with or without padding; None if it is neither."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of each element; None unless the nested lengths fill ``data`` exactly."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            wide = size & 0x7F
            if not 1 <= wide <= 4 or at + wide > len(data):
                return None
            size, at = int.from_bytes(data[at:at + wide], "big"), at + wide
        if at + size > len(data):
            return None
        items.append((tag, data[at:at + size]))
        at += size
    return items


def is_private_key(data: bytes) -> bool:
    """One DER sequence that is a PKCS#1, PKCS#8 (also encrypted), DSA or EC private key."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    parts = der_items(outer[0][1])
    if parts and [tag for tag, _ in parts] == [0x30, 0x04]:
        scheme = der_items(parts[0][1])
        return bool(scheme) and scheme[0][0] == 0x06 and scheme[0][1].startswith(PBE) and len(parts[1][1]) >= 16
    if not parts or parts[0][0] != 0x02 or len(parts[0][1]) != 1:
        return False
    tags = [tag for tag, _ in parts]
    if tags == [0x02] * 6:  # DSA: version, p, q, g, public, private
        return parts[0][1] == b"\0" and all(len(content) >= 16 for _, content in parts[1:3] + parts[4:])
    if len(parts) >= 9 and tags[:9] == [0x02] * 9:
        return all(content for _, content in parts[:9])
    if tags[1:3] == [0x30, 0x04]:
        algorithm = der_items(parts[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(parts[2][1]) >= 16
    return tags[1:2] == [0x04] and len(parts[1][1]) >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])


def is_openssh_key(data: bytes) -> bool:
    """The magic, then cipher, kdf, options, a key count and that many public blobs, all length-prefixed."""
    if not data.startswith(OPENSSH_MAGIC):
        return False
    at = len(OPENSSH_MAGIC)

    def text(at: int) -> int:
        size = int.from_bytes(data[at:at + 4], "big") if at + 4 <= len(data) else 1 << 40
        return at + 4 + size

    for _ in range(3):
        at = text(at)
    if at + 4 > len(data):
        return False
    keys, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):
        at = text(at)
    return at == len(data)


def key_kind(data: bytes | None) -> str | None:
    if data and data[0] == 0x30 and is_private_key(data):
        return "der"
    return "openssh" if data and is_openssh_key(data) else None


def is_token(header: str, payload: str) -> bool:
    """A header object with a text ``alg`` and a payload object, both base64 of JSON."""
    objects = []
    for part in (header, payload):
        data = decode64(part)
        if not data or data.lstrip()[:1] != b"{":
            return False
        try:
            objects.append(json.loads(data))
        except (ValueError, RecursionError):
            return False
    return isinstance(objects[0], dict) and isinstance(objects[0].get("alg"), str) and isinstance(objects[1], dict)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    low = text.lower()
    if any(word in low for word in WORDS_OF_ASSIGN):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    return spans


def is_framed_key(body: str) -> bool:
    """Whether what a PEM frame holds is a key, or base64 whole blocks of a key that its headers call encrypted."""
    body = ESCAPED_SLASH.sub("/", ESCAPED_END.sub("\n", body))
    headers = {}

    def header(m: re.Match) -> str:
        headers[m[1].lower()] = m[2].strip(" \t\"'`+,;")
        return ""

    data = decode64("".join(STRING_ENDS.sub(" ", HEADER.sub(header, body)).split()))
    if not data:
        return False
    if headers.get("proc-type", "").replace(" ", "") == "4,ENCRYPTED":
        return DEK_INFO.fullmatch(headers.get("dek-info", "").replace(" ", "")) is not None and len(data) >= 32 and len(data) % 8 == 0
    return key_kind(data) is not None


def key_size(chars: str, at: int) -> int:
    """Bytes of the key whose base64 begins at ``at``, read from its lengths alone; 0 if they do not fit one."""

    def read(start: int, size: int) -> bytes:
        first = at + start // 3 * 4
        return (decode64(chars[first:first + (start % 3 + size + 2) // 3 * 4]) or b"")[start % 3:start % 3 + size]

    room = (len(chars) - at) * 3 // 4
    if chars[at] != DER_START:
        place, keys = len(OPENSSH_MAGIC), 0
        for i in range(4 + 17):
            word = int.from_bytes(read(place, 4), "big")
            place += 4 if i == 3 else 4 + word
            keys = word if i == 3 else keys
            if place > room or (i == 3 and not 1 <= keys <= 16):
                return 0
            if i > 3 and i == 4 + keys:
                return place
        return 0

    def element(place: int) -> tuple[int, int]:
        """Where its content begins and ends."""
        head = read(place, 6).ljust(2, b"\0")
        wide = head[1] & 0x7F if head[1] >= 0x80 else 0
        size = int.from_bytes(head[2:2 + wide], "big") if wide else head[1]
        return (place + 2 + wide, place + 2 + wide + size) if wide <= 4 and (wide or head[1] < 0x80) else (0, room + 1)

    place, end = element(0)
    if end > room:
        return 0
    for _ in range(MOST_PARTS):
        place = element(place)[1]
        if place >= end:
            break
    return end if place == end else 0


def wrapped_spans(text: str) -> list[tuple[str, int, int]]:
    """Keys in base64 that goes on over line ends; the key's own lengths say where it ends."""
    spans = []
    for run in WRAPPED.finditer(text):
        chars, starts, places = [], [], []
        total = 0
        for m in PIECES.finditer(text, run.start(), run.end()):
            chars.append(m[1]), starts.append(total), places.append(m.start())
            total += len(m[1])
        joined, done = "".join(chars), 0
        for i, at in enumerate(starts):
            if at < done or not joined.startswith((DER_START, OPENSSH_START), at):
                continue
            size = key_size(joined, at)
            stop = at + -(-size * 4 // 3)
            if not size or stop <= at + len(chars[i]) or not (kind := key_kind(decode64(joined[at:stop]))):
                continue
            last = bisect.bisect_left(starts, stop) - 1
            end = places[last] + stop - starts[last]
            pad = -size % 3
            spans.append((kind, places[i], end + pad if text[end:end + pad] == "=" * pad else end))
            done = stop
    return spans


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    spans = []
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            if is_framed_key(m[2]):
                spans.append(("pem", m.start(), m.end()))
    inside = list(spans)
    spans += [s for s in wrapped_spans(text) if not any(start <= s[1] < end for _, start, end in inside)]
    for run in RUN.finditer(text):
        if any(start <= run.start() < end for _, start, end in inside):
            continue
        for m in HEX_KEY.finditer(run[0]):
            if len(m[0]) % 2 == 0 and (kind := key_kind(bytes.fromhex(m[0]))):
                spans.append((kind, run.start() + m.start(), run.start() + m.end()))
        for m in BASE64.finditer(run[0]):
            if kind := key_kind(decode64(m[0])):
                spans.append((kind, run.start() + m.start(), run.start() + m.end()))
        if run[0].count(".") >= 2:
            parts = list(SEGMENT.finditer(run[0]))
            for a, b, c in zip(parts, parts[1:], parts[2:]):
                dotted = run[0][a.end():b.start()] == "." == run[0][b.end():c.start()]
                if dotted and is_token(a[0], b[0]):
                    spans.append(("jwt", run.start() + a.start(), run.start() + c.end()))
    return spans


def find_spans(text: str | None) -> list[dict]:
    if not text:
        return []
    spans = sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


@F.pandas_udf(SPANS_TYPE)
def _scan(texts: pd.Series) -> pd.Series:
    return texts.map(find_spans)


def scan(docs: DataFrame, text: str = "text", out: str = "secret_spans") -> DataFrame:
    """``docs`` with the secrets of each text as an array of (kind, start, end)."""
    return docs.withColumn(out, _scan(F.coalesce(F.col(text), F.lit(""))))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame, spans: str = "secret_spans") -> DataFrame:
    """doc_id, counts of the base kinds, a hash of the base spans and all spans as text."""
    of = lambda *kinds: F.filter(F.col(spans), lambda s: s["kind"].isin(*kinds))
    return scanned.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(as_text(of(*BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col(spans)).alias("spans"))
