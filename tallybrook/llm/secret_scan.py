"""Secrets in texts: keyword automaton, anchored patterns at its hits, embedded checksums."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import UPPER, per_worker, slices, texts_of

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_LOWER = str.maketrans(UPPER, UPPER.lower())


def crc_ends_it(token: str) -> bool:
    """Whether the last six characters are the CRC-32 of those between prefix and them, in base 62."""
    body, check = token[4:-6], token[-6:]
    value = 0
    for c in check:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body.encode())


def base58_checked(key: str) -> bool:
    """Whether the last four bytes are those of a double SHA-256 of the others."""
    value = 0
    for c in key:
        value = value * 58 + BASE58.index(c)
    raw = value.to_bytes((value.bit_length() + 7) // 8, "big")
    return len(raw) > 4 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def signed_header(token: str) -> bool:
    """Whether the first part is base64url JSON that names an algorithm."""
    head = token.split(".", 1)[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(found, dict) and "alg" in found


_BREAK = r"(?:\s|\\[nr])"
_PEM = (
    rf"-----BEGIN (?:[A-Z]+ ){{0,3}}PRIVATE KEY-----{_BREAK}*"
    rf"(?P<head>(?:[A-Za-z][A-Za-z-]{{0,40}}+: [^\n\\]{{0,200}}+{_BREAK}++)*+)"
    r"(?P<body>(?:[A-Za-z0-9+/=\s]++|\\[nr])++)-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----"
)


def whole_key(m: re.Match) -> bool:
    """Whether a PEM block's bytes are as many as the lengths among them say.

    Line ends may be written out as a backslash and a letter. An OpenSSH key has its own
    lengths; a key encrypted under header lines has whole blocks of its cipher, others are DER.
    """
    try:
        raw = base64.b64decode(re.sub(_BREAK, "", m["body"]), validate=True)
    except (ValueError, binascii.Error):
        return False
    if raw.startswith(_OPENSSH):
        return whole_openssh(raw)
    if "ENCRYPTED" in m["head"]:
        vector = re.search(r"DEK-Info: [A-Z0-9-]+,([0-9A-Fa-f]+)", m["head"])
        return bool(raw) and vector is not None and len(vector[1]) in (16, 32) and len(raw) % (len(vector[1]) // 2) == 0
    return whole_der(raw)


_OPENSSH = b"openssh-key-v1\0"


def whole_openssh(raw: bytes) -> bool:
    """Whether cipher, key derivation, its options, the public keys and the private part fill it."""
    at = len(_OPENSSH)

    def skipped(at: int) -> int:
        return at + 4 + int.from_bytes(raw[at : at + 4], "big")

    for _ in range(3):
        at = skipped(at)
    n = int.from_bytes(raw[at : at + 4], "big")
    at += 4
    for _ in range(n + 1):
        if at + 4 > len(raw):
            return False
        at = skipped(at)
    return n > 0 and at == len(raw)


def whole_der(raw: bytes) -> bool:
    """Whether the bytes are as many as their outer DER length says."""
    if len(raw) < 2 or raw[0] != 0x30:
        return False
    more = raw[1] & 0x7F if raw[1] & 0x80 else 0
    size = int.from_bytes(raw[2 : 2 + more], "big") if more else raw[1]
    return len(raw) == 2 + more + size


class Kind(NamedTuple):
    """A kind of secret: what its text begins with, its pattern there, and what makes it one."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: object


def kinds() -> list[Kind]:
    """All kinds with keywords, in the order in which spans are listed (``hex`` after ``access``)."""
    words = ("password", "passwd", "secret", "token", "apikey", "api_key")
    tail = r"(?![A-Za-z0-9])"
    return [
        Kind(
            "assign",
            words,
            re.compile(
                r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                r"(?-i:([A-Za-z0-9+/_.=-]+))",
                re.ASCII | re.IGNORECASE,
            ),
            lambda m: len(m[1]) >= 6,
        ),
        Kind("access", ("akia",), re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        Kind(
            "github",
            tuple(f"gh{c}_" for c in "oprsu"),
            re.compile(rf"gh[oprsu]_[A-Za-z0-9]{{36}}{tail}"),
            lambda m: crc_ends_it(m[0]),
        ),
        Kind("npm", ("npm_",), re.compile(rf"npm_[A-Za-z0-9]{{36}}{tail}"), lambda m: crc_ends_it(m[0])),
        Kind(
            "xprv",
            ("xprv",),
            re.compile(rf"xprv[{BASE58}]{{107}}{tail}"),
            lambda m: base58_checked(m[0]),
        ),
        Kind(
            "jwt",
            ("eyj",),
            # Only where such a run begins: a long run is then read once.
            re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*"),
            lambda m: signed_header(m[0]),
        ),
        Kind(
            "pem",
            ("-----begin ",),
            re.compile(_PEM),
            whole_key,
        ),
    ]


LISTED = ("assign", "access", "hex", "github", "npm", "xprv", "jwt", "pem")
BASE = LISTED[:3]
# Hexadecimal runs have no keyword; one pass of a plain run pattern finds them.
_HEX = re.compile("[0-9a-f]{24,}")


class Scanner:
    """The automaton over all keywords and what to try at each."""

    def __init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        by_word: dict[str, list[Kind]] = {}
        for kind in kinds():
            for word in kind.keywords:
                by_word.setdefault(word, []).append(kind)
        for word, found in by_word.items():
            self.automaton.add_word(word, (len(word), found))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """``(kind, start, end)`` in code points, end exclusive, by start, then as ``LISTED``.

        Matches of a kind are leftmost and don't overlap; a match that fails its test is dropped
        but still covers its characters. Keywords are found in either case, on a text of the same
        length; the patterns then say which letters may be which.
        """
        lower = text.lower()
        if len(lower) != len(text):
            lower = text.translate(_LOWER)
        found, done = [], {}
        hits = [(end + 1 - size, tried) for end, (size, tried) in self.automaton.iter(lower)]
        for start, tried in sorted(hits, key=lambda h: h[0]):
            for kind in tried:
                if start >= done.get(kind.name, 0) and (m := kind.pattern.match(text, start)):
                    done[kind.name] = m.end()
                    if kind.valid(m):
                        found.append((kind.name, start, m.end()))
        found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
        return sorted(found, key=lambda s: (s[1], LISTED.index(s[0])))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_column`` and ``spans`` (array of ``kind, start, end``), one row per input row.

    Texts are scanned whole; null and empty ones have no spans. Null ids and repeated rows stay,
    extra columns are ignored. No rows give no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = per_worker(Scanner)
        for batch in slices(batches):
            rows = [
                [{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t)]
                for t in texts_of(batch, text)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(rows, pa.list_(span))], [id_column, "spans"]
            )

    schema = f"`{id_column}` {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.select(id_column, text).mapInArrow(run, schema)


def listed(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, comma-joined."""
    one = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(one, ",")
