import base64
import hashlib
import json
import random
import re
import zlib

import pytest

from tallybrook.llm import secret_scan
from tallybrook.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.cases import awkward, documents, empty

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def brute(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secret_scan.BASE.index(s[0])))


def base_spans(text):
    return [s for s in secret_scan.Scanner().spans(text) if s[0] in secret_scan.BASE]


@pytest.fixture(scope="module")
def scanner():
    return secret_scan.Scanner()


def test_documents(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark).collect()}
    for r in QUERIES["op6_secrets"](spark, DATA).collect():
        want = brute(texts[r["doc_id"]])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [
            sum(k == kind for k, _, _ in want) for kind in secret_scan.BASE
        ]
        assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))


def test_mixed_up_parts(scanner):
    parts = ["password", "PASSWD", "Secret", "token", "api_key", "ApiKey", '"', "'", " ", "=", ":", "abc123",
             "AKIA", "ABCDEFGHIJKLMNOP1234", "0123456789abcdef01234567", "İ", "ſecret=", "toKen", "=secret", "x="]
    rnd = random.Random(5)
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert [s for s in scanner.spans(text) if s[0] in secret_scan.BASE] == brute(text), text


def github(body="xY9" * 10):
    check, value = "", zlib.crc32(body.encode())
    for _ in range(6):
        value, i = divmod(value, 62)
        check = secret_scan.BASE62[i] + check
    return f"ghp_{body}{check}"


def kinds_of(scanner, text):
    return [k for k, _, _ in scanner.spans(text)]


def test_checksums(scanner):
    good = github()
    assert scanner.spans(f"é {good}.") == [("github", 2, 42)]
    assert kinds_of(scanner, good[:-1] + ("A" if good[-1] != "A" else "B")) == []
    assert kinds_of(scanner, good + "x") == []
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
    assert kinds_of(scanner, f"{head}.eyJhIjoxfQ.abc") == ["jwt"]
    assert kinds_of(scanner, "eyJhIjoxfQ.eyJhIjoxfQ.abc") == []
    raw = bytes([0x30, 3, 2, 1, 5])
    block = "-----BEGIN PRIVATE KEY-----\n{}\n-----END PRIVATE KEY-----"
    assert kinds_of(scanner, block.format(base64.b64encode(raw).decode())) == ["pem"]
    assert kinds_of(scanner, block.format(base64.b64encode(raw + b"x").decode())) == []


def test_extended_keys(scanner):
    def encode(raw):
        full = raw + hashlib.sha256(hashlib.sha256(raw).digest()).digest()[:4]
        value, out = int.from_bytes(full, "big"), ""
        while value:
            value, i = divmod(value, 58)
            out = secret_scan.BASE58[i] + out
        return out

    key = encode(bytes.fromhex("0488ade4") + bytes(range(74)))
    assert key.startswith("xprv") and len(key) == 111
    assert kinds_of(scanner, f"key {key}") == ["xprv"]
    assert kinds_of(scanner, key[:-1] + ("1" if key[-1] != "1" else "2")) == []


def test_awkward_rows(spark):
    docs = awkward(spark, ["spans", "kind", "row"])
    rows = secret_scan.scan(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in rows if r["doc_id"] is not None}
    assert [k for k, _, _ in by_id[10]] == ["assign", "access"]
    assert by_id[0] == by_id[1] == []
    assert secret_scan.scan(empty(spark)).collect() == []


def test_long_runs_of_a_keyword_stay_fast(scanner):
    assert kinds_of(scanner, "eyJ" * 300_000) == []
    assert kinds_of(scanner, "token" * 100_000) == []


def part(raw):
    return len(raw).to_bytes(4, "big") + raw


def pem(name, raw, head="", end="\n"):
    body = base64.b64encode(raw).decode()
    lines = [f"-----BEGIN {name}PRIVATE KEY-----", *([*head.split("\n"), ""] if head else [])]
    lines += [body[i : i + 70] for i in range(0, len(body), 70)]
    return end.join([*lines, f"-----END {name}PRIVATE KEY-----"])


OPENSSH = (
    b"openssh-key-v1\0" + part(b"none") + part(b"none") + part(b"") + (1).to_bytes(4, "big")
    + part(b"public" * 9) + part(b"private" * 30)
)
ENCRYPTED = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF"


@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", "\\r\\n"])
@pytest.mark.parametrize(
    "name, raw, head",
    [("OPENSSH ", OPENSSH, ""), ("RSA ", bytes(range(64)), ENCRYPTED), ("", b"\x30\x82\x01\x00" + bytes(256), ""),
     ("EC ", b"\x30\x20" + bytes(32), "")],
)
def test_private_keys(scanner, name, raw, head, end):
    block = pem(name, raw, head, end)
    text = f'key = "{block}" after'
    assert ("pem", 7, 7 + len(block)) in scanner.spans(text)


@pytest.mark.parametrize(
    "name, raw, head",
    [("OPENSSH ", OPENSSH[:-1], ""), ("OPENSSH ", OPENSSH + b"x", ""), ("OPENSSH ", OPENSSH[:20], ""),
     ("RSA ", bytes(63), ENCRYPTED), ("RSA ", bytes(64), "Proc-Type: 4,ENCRYPTED"), ("", b"\x30\x82\x01\x00" + bytes(255), "")],
)
def test_broken_private_keys(scanner, name, raw, head):
    assert not [k for k in scanner.spans(pem(name, raw, head)) if k[0] == "pem"]


@pytest.mark.parametrize("line", ["-----BEGIN PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----a: ", "-----BEGIN RSA PRIVATE KEY-----\nA: b\n"])
def test_many_openings_are_quick(scanner, line):
    assert not [k for k in scanner.spans(line * 20_000) if k[0] == "pem"]
