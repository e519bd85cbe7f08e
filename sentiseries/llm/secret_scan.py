"""Secrets in texts: patterns, and candidates confirmed by decoding them.

Three kinds are patterns alone: ``assign`` (a name, a sign and a value of 12 characters
or more), ``access`` and ``hex``. Four are reported only if their structure holds:
``jwt`` (a signed token whose first part decodes to a JSON header with an algorithm),
``pem`` (a block between key markers, up to 16 header lines before it; what a passphrase
locks by its headers has no structure to see and needs 16 bytes), ``der`` (base64 or hex of a private key: nested
lengths that fill each other exactly) and ``ssh`` (base64 of the private key container).

Offsets are code points, ends exclusive. Null and empty texts have no spans. Each row
is scanned by itself, whole, so repeated rows and null ids need no special care.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sentiseries.llm.common import free_name

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "ssh")
SPAN_TYPE = T.ArrayType(T.StructType().add("kind", "string").add("start", "integer").add("end", "integer"))

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(ey[A-Za-z0-9_-]+)\.(ey[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]*")
_EOL = r"(?:\r?\n|(?:\\r)?\\n)"
_PEM = re.compile(
    r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----"
    rf"((?:[ \t]*{_EOL}(?:[ \t]*[A-Za-z][A-Za-z0-9-]*:[^\r\n\\]*{_EOL}){{1,16}})?)([A-Za-z0-9+/=\s\\]*)-----END \1-----"
)
_LOCKED = re.compile(r"Proc-Type:[ \t]*4,[ \t]*ENCRYPTED.*DEK-Info:[ \t]*[A-Za-z0-9-]+,[0-9A-Fa-f]+", re.S)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
_SSH = b"openssh-key-v1\0"
_INTEGER, _OCTETS, _OBJECT, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def unbase64(text: str) -> bytes | None:
    """The bytes of standard or URL-safe base64, padded or not; None if it is neither."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the encoded values that fill ``data[start:end]`` exactly."""
    found = []
    while start < end:
        if end - start < 2:
            return None
        tag, length = data[start], data[start + 1]
        start += 2
        if length >= 0x80:
            width = length & 0x7F
            if not 1 <= width <= 4 or end - start < width:
                return None
            length = int.from_bytes(data[start : start + width], "big")
            start += width
        if length > end - start:
            return None
        found.append((tag, start, start + length))
        start += length
    return found


def is_private_key(data: bytes) -> bool:
    """A sequence over all of ``data`` laid out as an RSA, DSA, EC or PKCS #8 private key."""
    outer = elements(data, 0, len(data)) if len(data) > 16 and data[0] == _SEQUENCE else None
    if not outer or len(outer) != 1:
        return False
    parts = elements(data, outer[0][1], outer[0][2])
    if not parts or len(parts) < 2 or parts[0][0] != _INTEGER or parts[0][2] - parts[0][1] != 1:
        return False
    version, tags = data[parts[0][1]], [p[0] for p in parts]
    if version == 0 and (len(tags) >= 9 and set(tags[:9]) == {_INTEGER} or tags == [_INTEGER] * 6):
        return True
    if version == 1 and tags[1] == _OCTETS and parts[1][2] - parts[1][1] >= 16 and len(tags) <= 4:
        return True
    if version in (0, 1) and tags[1:3] == [_SEQUENCE, _OCTETS]:
        inner = elements(data, parts[1][1], parts[1][2])
        return bool(inner) and inner[0][0] == _OBJECT
    return False


def is_header(part: str) -> bool:
    try:
        header = json.loads(unbase64(part) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def is_object(part: str) -> bool:
    try:
        return isinstance(json.loads(unbase64(part) or b""), dict)
    except (ValueError, RecursionError):
        return False


def key_kind(data: bytes | None) -> str | None:
    if data is None:
        return None
    if data.startswith(_SSH):
        return "ssh"
    return "der" if is_private_key(data) else None


def confirmed(text: str) -> list[tuple[str, int, int]]:
    """Spans whose decoded form is that of a signed token or a private key."""
    spans = []
    if "ey" in text:
        spans += [("jwt", *m.span()) for m in _JWT.finditer(text) if is_header(m[1]) and is_object(m[2])]
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            data = unbase64(re.sub(r"\\[nr]|\s", "", m[3]))
            locked = data and len(data) >= 16 and _LOCKED.search(m[2])
            if key_kind(data) or locked or m[1].startswith("ENCRYPTED") and data and data[0] == _SEQUENCE and elements(data, 0, len(data)):
                spans.append(("pem", *m.span()))
    for m in _BASE64.finditer(text):
        kind = key_kind(unbase64(m[0]))
        if kind:
            spans.append((kind, *m.span()))
    for m in _ANY_HEX.finditer(text):
        kind = key_kind(bytes.fromhex(m[0]))
        if kind:
            spans.append((kind, *m.span()))
    return spans


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of one text, by start, then by the order of ``KINDS``."""
    if not text:
        return []
    spans = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans + confirmed(text), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def masked(text: str | None, spans: list[tuple[str, int, int]], mark: str = "[secret]") -> str | None:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""
    if not spans:
        return text
    out, done = [], 0
    for _, start, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


@F.pandas_udf(SPAN_TYPE)
def span_lists(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)] for t in batch], dtype=object)


@F.pandas_udf(T.StringType())
def masked_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([masked(t, scan(t)) for t in batch], dtype=object)


def find(documents: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """All columns and ``spans``, an array of (kind, start, end); replaces a column of that name."""
    return documents.withColumn(spans, span_lists(text))


def redact(documents: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The same rows and columns with secrets masked and ``length``, if there, counted anew."""
    name = free_name(documents, "masked")
    out = documents.withColumn(name, masked_texts(text))
    changed = ~F.col(name).eqNullSafe(F.col(text))
    columns = {c: F.when(changed, F.length(name).cast(documents.schema[c].dataType)).otherwise(F.col(c)) for c in documents.columns if c == length}
    return out.withColumns(columns | {text: F.col(name)}).select(*documents.columns)


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
