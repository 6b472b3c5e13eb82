"""Secrets in texts, confirmed by their structure.

Candidates of three plain patterns are reported as they are. Further candidates - base64 or hex
runs and dotted tokens - are decoded first and reported only if what comes out is built like a
key or a signed token: nested DER lengths that fit exactly and hold the parts of a private key, the
length-prefixed fields of an OpenSSH key, or a JSON header that names an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.arrow_text import small_batches

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "der", "openssh", "jwt")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
#: Letters without which ASSIGN has no match.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run is greedy and ends at another character, so the shortest length can stand in the pattern.
HEX = re.compile(r"[0-9a-f]{24,}")
ANY_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{2}){32,}(?![0-9A-Za-z])")
#: First line of a key in base64: it starts with a DER sequence or the magic word of OpenSSH.
BASE64 = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\n))(?=M|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/]{40,}")
LETTERS = re.compile(r"[A-Za-z0-9+/]+")
#: Lines end with a line break or, in JSON and env strings, with its escape.
LINE_END = re.compile(r"\r?\n|(?:\\{1,2}r)?\\{1,2}n")
JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of the DER values that fill ``data`` exactly, else None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    """Whether bytes are a private key in DER: PKCS#1, PKCS#8, DSA or an elliptic curve key."""
    outer = der_items(data) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    parts = der_items(outer[0][1])
    if not parts or parts[0][0] != INTEGER or len(parts[0][1]) != 1:
        return False
    tags = [t for t, _ in parts]
    shortest = all(c and (len(c) == 1 or c[0] or c[1] >= 0x80) for t, c in parts[:9] if t == INTEGER)
    if len(parts) >= 9 and tags[:9] == [INTEGER] * 9:
        return shortest
    if tags == [INTEGER] * 6:
        # DSA: version 0, p, q, g, public and private number; q has 160 bits at least, and p is longer.
        p, q, g, public, private = (int.from_bytes(c, "big") for _, c in parts[1:])
        return shortest and parts[0][1] == b"\0" and q.bit_length() >= 160 and p > max(q, g, public) and 0 < private < q
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:
        algorithm = der_items(parts[1][1])
        return bool(algorithm) and algorithm[0][0] == OID and len(parts[2][1]) >= 16
    return parts[0][1] == b"\x01" and len(parts) >= 2 and tags[1] == OCTETS and len(parts[1][1]) >= 16


def is_openssh_key(data: bytes) -> bool:
    """Whether bytes are an OpenSSH private key: its magic word and fields of the lengths they state."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, texts = len(magic), []
    for numbered in (False, False, False, True, False, False):  # cipher, kdf, options, count, public, private
        if at + 4 > len(data):
            return False
        size, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if numbered:
            if not 1 <= size <= 64:
                return False
            continue
        if at + size > len(data):
            return False
        texts.append(data[at : at + size])
        at += size
    return bool(texts[0]) and bool(texts[-1])


def _unbase64(text: str, url: bool = False) -> bytes | None:
    plain = "".join(text.split()).rstrip("=")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


#: Longer values are no keys (an RSA key of 16,384 bits has about 10,000 bytes, its public part 2,100).
KEY_BYTES, PUBLIC_BYTES = 1 << 14, 1 << 12


def der_size(data: bytes) -> int | None:
    """Bytes of the value that ``data`` starts with, if it is a sequence that starts with a version."""
    if len(data) < 12 or data[0] != SEQUENCE:
        return None
    width = data[1] & 0x7F if data[1] >= 0x80 else 0
    if width > 4 or data[1] == 0x80 or data[2 + width : 4 + width] != b"\x02\x01":
        return None
    return 2 + width + (int.from_bytes(data[2 : 2 + width], "big") if width else data[1])


def openssh_size(text: str, at: int) -> int | None:
    """Bytes up to the end of the last field of the OpenSSH key in base64 at this place.

    Reads as far as the next length and no further, so that a line which only starts like a
    key costs little.
    """
    end = len(b"openssh-key-v1\0")
    # Names, their options, the number of keys, and two fields of key material.
    for most in (64, 64, 256, None, PUBLIC_BYTES, KEY_BYTES):
        data = _unbase64(_whole(_letters(text, at, -(-(end + 4) * 4 // 3))[0])) or b""
        if len(data) < end + 4:
            return None
        size = 0 if most is None else int.from_bytes(data[end : end + 4], "big")
        if most is not None and size > most:
            return None
        end += 4 + size
    return end


def _letters(text: str, at: int, most: int) -> tuple[str, int]:
    """Up to ``most`` base64 letters from ``at`` on, over line ends, and where they end."""
    lines, n, end = [], 0, at
    while m := LETTERS.match(text, at, at + most - n):
        lines.append(m[0])
        n, end = n + len(m[0]), m.end()
        gap = LINE_END.match(text, end)
        if n == most or not gap:
            break
        at = gap.end()
    return "".join(lines), end


def base64_key(text: str, at: int) -> tuple[int, int] | None:
    """Kind and end of the key in base64 that starts at ``at``; it ends where its own lengths say."""
    head = _unbase64(text[at : at + 40]) or b""
    if head[:1] == b"\x30":
        size = der_size(head)
    else:
        size = openssh_size(text, at)
    letters = -(-(size or 0) * 4 // 3)
    if not 0 < letters <= min(len(text) - at, 2 * KEY_BYTES):
        return None
    run, end = _letters(text, at, letters)
    key = _unbase64(run) if len(run) == letters else None
    if not key or not (is_der_key(key) or is_openssh_key(key)):
        return None
    pad = -letters % 4
    while pad and text[end : end + 1] == "=":
        end, pad = end + 1, pad - 1
    return (3 if key[:1] == b"\x30" else 4), end


def _whole(letters: str) -> str:
    """Without a last letter that holds no whole byte."""
    return letters[:-1] if len(letters) % 4 == 1 else letters


def is_signed_token(text: str) -> bool:
    """Whether header and payload of a dotted token are JSON objects and the header names an algorithm."""
    try:
        header, payload = (json.loads(_unbase64(x, True) or b"") for x in text.split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(payload, dict)


Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def confirmed_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    for m in ANY_HEX.finditer(text):
        if is_der_key(bytes.fromhex(m[0])):
            spans.append((m.start(), 3, m.end()))
    at = 0
    while m := BASE64.search(text, at):
        found = base64_key(text, m.start())
        if found:
            spans.append((m.start(), *found))
        # Behind a key, or behind the first line of what is none: the next line may start one.
        at = found[1] if found else m.end()
    if "eyJ" in text:
        spans += [(m.start(), 5, m.end()) for m in JWT.finditer(text) if is_signed_token(m[0])]
    return spans


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            text = text or ""
            base = base_spans(text)
            kinds = [k for _, k, _ in base]
            rows.append((
                kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(spelled(base).encode()).hexdigest(),
                spelled(sorted(base + confirmed_spans(text))),
            ))
        columns = list(zip(*rows)) or [[]] * 5
        types = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], [str(i) for i in range(6)]
        )


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` lists kind:start:end in code points, end exclusive, by start and then by kind;
    ``base_sha256`` is the digest of that list for the three plain kinds. Null and empty texts have
    none. Rows that repeat are scanned alike; an empty table gives no rows; other columns are not
    looked at. Whole texts are scanned, one at a time, in time linear in their length. What
    claims to be a key of more than ``KEY_BYTES`` bytes is none.
    """
    kind = docs.schema[key].dataType.simpleString()
    return small_batches(docs).select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).mapInArrow(
        _scan, f"`{key}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )
