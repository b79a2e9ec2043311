"""Secret scan: patterns for known assignments and keys, and encoded secrets confirmed by their structure.

Base patterns (fixed values below) report assignments, access keys and long hex runs. Beyond them, runs of
base64 or hex are decoded and reported only where the bytes parse: a DER sequence whose nested lengths fill it
exactly, with an integer or an algorithm identifier first as in private, encrypted and public keys (``der``; the lines of
a body may be indented, or joined by ``\\n`` as in key files); an SSH key
blob whose length-prefixed fields fill it and begin with a key type, or an OpenSSH private key (``ssh``); and
signed tokens of three base64url parts whose first decodes to a JSON object that names an algorithm (``jwt``).

Spans count code points, end exclusive, ordered by start, then by kind in the order of ``KINDS``.

Edge cases: a null text counts as empty; a text without a span has an empty list; repeated rows and clashing columns stay
as they are; very long texts are scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import bounded_batches, packed

#: The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "jwt", "der", "ssh")
#: Shortest value of an assignment, access key and hex run; shortest encoded run that is decoded.
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_RUN = 6, 20, 24, 40

WORDS = ("passw", "secret", "token", "api")
assign_of = re.compile(ASSIGN, re.ASCII).finditer
access_of = re.compile(ACCESS).finditer
#: A greedy run is as long as can be, so asking for its length finds the same runs.
hex_of = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}").finditer
jwt_of = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]*)").finditer
#: Between two lines of one body: a line end, as such or written with a backslash, and blanks around it.
BREAK = r"[ \t]*(?:\r?\n|\\n)[ \t]*"
break_of = re.compile(BREAK)
run_of = re.compile(rf"(?:[A-Za-z0-9+/]{{40,}}(?:{BREAK}[A-Za-z0-9+/]+)*|[A-Za-z0-9_-]{{{LEAST_RUN},}})={{0,2}}").finditer
hexes_of = re.compile(rf"[0-9A-Fa-f]{{{LEAST_RUN},}}").finditer
OPENSSH = b"openssh-key-v1\0"


def _length(data: bytes, at: int) -> tuple[int, int] | None:
    """(length, place after it) of a DER length in its shortest form."""
    if at >= len(data):
        return None
    n, at = data[at], at + 1
    if n < 128:
        return n, at
    size = n & 127
    if not 1 <= size <= 4 or at + size > len(data):
        return None
    n = int.from_bytes(data[at : at + size], "big")
    return (n, at + size) if n >= 128 and n >> 8 * (size - 1) else None


def _fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents that fill ``data`` exactly."""
    out, at = [], 0
    while at < len(data):
        tag, got = data[at], _length(data, at + 1)
        if got is None or got[1] + got[0] > len(data):
            return None
        out.append((tag, data[got[1] : got[1] + got[0]]))
        at = got[1] + got[0]
    return out


def is_der_key(data: bytes) -> bool:
    """One sequence that fills the bytes and holds what a key does: a version or big integers, or an algorithm."""
    outer = _fields(data) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    inner = _fields(outer[0][1])
    if not inner or len(inner) < 2:
        return False
    tags = [t for t, _ in inner]
    algorithm = lambda c: bool((f := _fields(c)) and f[0][0] == 6 and len(f[0][1]) >= 3)
    if tags[0] == 0x30:  # algorithm and bit string of a public key, or octets of an encrypted private one
        return len(inner) == 2 and tags[1] in (3, 4) and algorithm(inner[0][1])
    if tags[0] != 2 or not inner[0][1]:
        return False
    if tags[1] == 0x30:  # version, algorithm, octets
        return len(inner) >= 3 and tags[2] == 4 and algorithm(inner[1][1])
    if tags[1] == 4:  # version, octets, curve
        return inner[0][1] == b"\1" and len(inner[1][1]) >= 16
    return set(tags) == {2} and all(c for _, c in inner) and max(len(c) for _, c in inner) >= 16  # integers


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields that fill the bytes, a key type first; or a private key file."""
    if data.startswith(OPENSSH):
        return True
    fields, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return len(fields) >= 2 and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", fields[0]) is not None


def is_signed_header(part: str) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def _decoded(run: str) -> bytes:
    run = break_of.sub("", run).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4)) if len(run) % 4 != 1 else b""
    except (ValueError, binascii.Error):
        return b""


def _kind(data: bytes) -> str | None:
    return "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret of a whole text."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [("assign", m.start(), m.end()) for m in assign_of(text) if len(m[2]) >= LEAST_VALUE]
    if max(map(len, text.split()), default=0) >= LEAST_ACCESS:  # the rest has no white space but line ends
        if "AKIA" in text:
            out += [("access", m.start(), m.end()) for m in access_of(text) if m.end() - m.start() >= LEAST_ACCESS]
        out += [("hex", m.start(), m.end()) for m in hex_of(text)]
        if "eyJ" in text:
            out += [("jwt", m.start(), m.end()) for m in jwt_of(text) if is_signed_header(m[1])]
        for m in run_of(text):
            whole = m[0]
            if kind := _kind(_decoded(whole)):
                out.append((kind, m.start(), m.end()))
            elif ends := [(b.start(), b.end()) for b in break_of.finditer(whole)]:
                if kind := _kind(_decoded(whole[: ends[-1][0]])):  # the word after a body is no line of it
                    out.append((kind, m.start(), m.start() + ends[-1][0]))
                    continue
                # lines beside each other may be encoded one by one
                for i, j in zip([0, *(e for _, e in ends)], [*(b for b, _ in ends), len(whole)]):
                    if j - i >= LEAST_RUN and (kind := _kind(_decoded(whole[i:j]))):
                        out.append((kind, m.start() + i, m.start() + j))
        for m in hexes_of(text):
            if len(m[0]) % 2 == 0 and (kind := _kind(bytes.fromhex(m[0]))):
                out.append((kind, m.start(), m.end()))
    return sorted(set(out), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, spans array<struct<kind, start, end>>): every row packed, with the secrets of its whole text."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(SPANS)
    def spans_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = ([{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in texts)
            yield pd.Series(list(found), dtype=object)

    return packed(docs).withColumn("spans", spans_of(F.coalesce(F.col(f"row.`{text}`"), F.lit(""))))
