"""Operator 5, secret scans with structural confirmation.

Base spans follow fixed patterns (assign, access, hex). Further candidates, runs of base64 or hex and dotted
tokens, are decoded and reported only if their structure holds: ``der`` for a key encoding whose nested lengths
account for every byte (a key in base64 starts at any line start and ends where its length header says), ``ssh`` for a private key in the OpenSSH layout, ``jwt`` for a signed token whose
header is a JSON object naming an algorithm and whose claims are a JSON object. Base spans stay whatever they decode to.

Work is one pass over each text in Arrow batches, nothing is shuffled. A search runs only in texts that hold its
fixed part. Defined results: null or empty text has no spans; repeated rows get the same spans each.
"""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import map_texts

#: The contract's patterns and least lengths, and the words an assignment starts with.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "der", "ssh", "jwt")

#: Candidates: line starts that may begin a key (a sequence tag or a fixed magic), the base64 run from there on, broken by
#: line breaks with indent, also escaped ones, hex runs in one letter case, dotted tokens.
KEY_START = re.compile(r"(?:M(?<![A-Za-z0-9+/]M)|M(?<=\\[nrt]M)|b3(?<![A-Za-z0-9+/]b3)|b3(?<=\\[nrt]b3))[A-Za-z0-9+/]{22,}")
BREAK = r"[\x20\t]*(?:\r?\n|(?:\\+r)?\\+n)(?:[\x20\t]|\\+t)*"
RUN = re.compile(rf"[A-Za-z0-9+/]+(?:{BREAK}[A-Za-z0-9+/]+)*")
LINE = re.compile(rf"([A-Za-z0-9+/]+)(?:{BREAK})?")
PADDING = re.compile(r"={0,2}")
HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}")
TOKEN = re.compile(r"([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
LONG_RUN = re.compile(r"[A-Za-z0-9+/]{24}")
TOKEN_START = re.compile(r"ey(?:(?<![A-Za-z0-9_-]ey)|(?<=\\[nrt]ey))")

#: Fixed value: the first bytes of OpenSSH's private key layout.
SSH_MAGIC = b"openssh-key-v1\0"


def _der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the contents of the DER element at a place, or None if its length is wrong."""
    if at + 2 > end:
        return None
    tag, size = data[at], data[at + 1]
    at += 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end or data[at] == 0:
            return None
        size = int.from_bytes(data[at:at + n], "big")
        if size < 0x80:
            return None
        at += n
    return (tag, at, at + size) if at + size <= end else None


def _der_parts(data: bytes, lo: int, hi: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``data[lo:hi]`` exactly, or None."""
    parts = []
    while lo < hi:
        item = _der_item(data, lo, hi)
        if item is None:
            return None
        parts.append(item)
        lo = item[2]
    return parts


def is_key(data: bytes) -> bool:
    """A DER key: one sequence over all bytes that holds the parts of a PKCS#1, DSA, PKCS#8 (also
    encrypted), SEC1 or public key."""
    outer = _der_parts(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    parts = _der_parts(data, outer[0][1], outer[0][2])
    if not parts:
        return False
    tags = [t for t, _, _ in parts]
    if tags[0] == 0x02 and len(tags) >= 9 and set(tags[:9]) == {0x02}:
        return True  # PKCS#1: version and eight integers
    if tags == [0x02] * 6 and data[parts[0][1]:parts[0][2]] == b"\0":
        return True  # DSA: version 0 and five integers
    if tags[0] == 0x02 and len(tags) >= 2 and tags[1] == 0x04:
        return parts[0][2] - parts[0][1] == 1 and data[parts[0][1]] == 1  # SEC1: version 1, octets
    algorithm = 1 if tags[0] == 0x02 else 0  # PKCS#8 starts with its version
    if len(tags) < algorithm + 2 or tags[algorithm] != 0x30 or tags[algorithm + 1] not in ((0x04,) if algorithm else (0x03, 0x04)):
        return False
    inner = _der_parts(data, parts[algorithm][1], parts[algorithm][2])
    if not algorithm and tags[1] == 0x04 and (len(tags) != 2 or not inner or [t for t, _, _ in inner] != [0x06, 0x30]):
        return False  # encrypted PKCS#8 names its derivation with parameters, unlike a digest
    return bool(inner) and inner[0][0] == 0x06 and inner[0][2] > inner[0][1]


def ssh_size(data: bytes) -> int | None:
    """Size of the key that ``data`` starts with in OpenSSH's layout: magic, cipher, key derivation, options, count, that many
    public keys, the private part, and the tag of a cipher that has one."""
    if not data.startswith(SSH_MAGIC):
        return None
    at, fields, tag = len(SSH_MAGIC), 0, 0

    def field(at: int) -> int | None:
        if at + 4 > len(data):
            return None
        end = at + 4 + int.from_bytes(data[at:at + 4], "big")
        return end if end <= len(data) else None

    for fields in range(3):
        nxt = field(at)
        if nxt is None or fields < 2 and nxt == at + 4:
            return None
        if not fields and (b"gcm@" in data[at + 4:nxt] or b"poly1305" in data[at + 4:nxt]):
            tag = 16
        at = nxt
    if at + 4 > len(data) or not 1 <= (n := int.from_bytes(data[at:at + 4], "big")) <= 16:
        return None
    at += 4
    for _ in range(n + 1):  # public keys, then the private part
        nxt = field(at)
        if nxt is None:
            return None
        at = nxt
    return at + tag if at + tag <= len(data) else None


def is_ssh_key(data: bytes) -> bool:
    return ssh_size(data) is not None


def is_signed_token(header: str, claims: str) -> bool:
    def parsed(part: str):
        try:
            return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
        except (ValueError, RecursionError):
            return None

    head = parsed(header)
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(parsed(claims), dict)


def _structure(data: bytes) -> str | None:
    return "ssh" if is_ssh_key(data) else "der" if data[:1] == b"\x30" and is_key(data) else None


def _bytes(raw: str) -> bytes:
    return base64.b64decode(raw[:-1] if len(raw) % 4 == 1 else raw + "=" * (-len(raw) % 4))


def _size(raw: str) -> int | None:
    """Bytes of the key that starts a run, as its own length header says."""
    if raw[0] == "M":
        head = base64.b64decode(raw[:8])
        if head[0] != 0x30:
            return None
        n = head[1] & 0x7F if head[1] >= 0x80 else 0
        return 2 + n + (int.from_bytes(head[2:2 + n], "big") if n else head[1]) if n <= 4 else None
    return ssh_size(_bytes(raw)) if raw.startswith("b3BlbnNzaC1rZXktdjE") else None


def encoded_keys(text: str) -> list[tuple[int, int, str]]:
    """Keys in base64: each starts at a line start and ends, by its length header, at a line end."""
    out: list[tuple[int, int, str]] = []
    free = end = 0  # end of the last key, end of the run at hand
    raw, places, offsets = "", [], []  # the run without breaks; by line: place in the text, offset in raw
    for m in KEY_START.finditer(text):
        if m.start() < free:
            continue
        if m.start() >= end:
            end = RUN.match(text, m.start()).end()
            lines = list(LINE.finditer(text, m.start(), end))
            places = [x.start() for x in lines]
            offsets = [0, *accumulate(len(x[1]) for x in lines)]
            raw = "".join([x[1] for x in lines])
        at = offsets[bisect_left(places, m.start())]
        # the header is read from a few characters, a key of OpenSSH's from the whole rest
        size = _size(raw[at:at + 8] if m[0][0] == "M" else raw[at:])
        stop = at + -(-size * 4 // 3) if size else 0
        k = bisect_left(offsets, stop)
        if stop > at and k < len(offsets) and offsets[k] == stop:
            kind = _structure(_bytes(raw[at:stop]))
            if kind:
                free = places[k - 1] + stop - offsets[k - 1]
                free = PADDING.match(text, free).end()
                out.append((m.start(), free, kind))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of decoded structures."""
    out = []
    if LONG_RUN.search(text):
        out += encoded_keys(text)
        for m in HEX_BYTES.finditer(text):
            if len(m[0]) % 2 == 0 and (m[0][:2] == "30" or m[0][:4].lower() == "6f70"):
                kind = _structure(bytes.fromhex(m[0]))
                if kind:
                    out.append((m.start(), m.end(), kind))
    if "eyJ" in text or "ey" in text and "." in text:
        free = 0
        for start in TOKEN_START.finditer(text):  # any dotted part may be a header
            m = TOKEN.match(text, start.start()) if start.start() >= free else None
            if m and is_signed_token(m[1], m[2]):
                out.append((m.start(), m.end(), "jwt"))
                free = m.end()
    return out


_ORDER = {k: i for i, k in enumerate(KINDS)}
_FIELD = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType())]))


def _find(texts: pa.Array) -> list[pa.Array]:
    out = []
    for text in texts.to_pylist():
        spans = sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[0], _ORDER[s[2]]))
        out.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
    return [pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]


def secrets(docs: DataFrame, carry: dict[str, object]) -> DataFrame:
    """``carry`` columns plus ``spans`` by start, then kind as listed."""
    return map_texts(docs, _find, [("spans", _FIELD)], carry)


def base_only(spans):
    return F.filter(spans, lambda s: s["kind"].isin("assign", "access", "hex"))
