import hashlib
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallybrook.llm import alignment, queries
from tests.conftest import DATA
from tests.llm.cases import CLASHING, awkward, documents, empty

public_tokenizers = pytest.importorskip("public_tokenizers")
A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    None, "", " ", "  ", "a", "a ", " a", "a  b   c ", "\n\n x\t y\r\n", "Hello, world! It's 1234 o'clock.",
    "<|endoftext|> <s> </s> <unk> <0x41> <0x0A>", "mark ▁ in text", "▁", "日本語のテキスト です。 한국어 😀👍🏽 é é",
    "x" * 500, "nul \0 here", "　wide space   x", "İstanbul ıŞ ẞ", "tab\t tab", "trail\n", "a\n b \n c",
]


def byte_characters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in shown):
        out[chr(256 + i)] = b
    return out


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """Ids and bytes by the libraries themselves; none if the bytes differ."""
    if not text:
        return [], []
    a, b = libraries
    chars = byte_characters()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in zip(ids_b, pieces, strict=True)
    ]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], []
    return list(zip(ids_a, bytes_a, strict=True)), list(zip(ids_b, bytes_b, strict=True))


def spans(side):
    at = 0
    for i, raw in side:
        yield i, at, at + len(raw)
        at += len(raw)


def brute(libraries, texts):
    docs, held = [], Counter()
    for text in texts:
        a, b = (list(spans(x)) for x in tokens(libraries, text))
        cuts = {e for *_, e in a} & {e for *_, e in b}
        sides = []
        for side in (a, b):
            parts, part = [], []
            for i, _, e in side:
                part.append(str(i))
                if e in cuts:
                    parts.append(",".join(part))
                    part = []
            sides.append(parts)
        groups = ["|".join(x) for x in zip(*sides, strict=True)]
        links = [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)] if len(a) < 1000 else near(a, b)
        held.update(set(links))
        docs.append((len(a), len(b), len(cuts), links, ";".join(groups)))
    top = {}
    for (i, _), n in held.items():
        top[i] = max(top.get(i, 0), n)
    return [
        (n_a, n_b, n_g, len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links),
         hashlib.sha256(g.encode()).hexdigest() if n_a else "")
        for n_a, n_b, n_g, links, g in docs
    ], held


def near(a, b):
    """The overlapping pairs of two long lists, walked side by side."""
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        out.append((a[i][0], b[j][0]))
        e, f = a[i][2], b[j][2]
        i, j = i + (e <= f), j + (f <= e)
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def run(docs, **settings):
    found, pairs = alignment.aligned(docs, A, B, **settings)
    return found.collect(), pairs


@pytest.mark.parametrize("block", [alignment.BLOCK, 2000])
def test_real_documents_against_the_libraries(spark, libraries, block):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows, pairs = run(docs.repartition(3), block_bytes=block)
    want, held = brute(libraries, texts.values())
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == dict(zip(texts, want, strict=True))
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(held)


def test_awkward_texts(spark, libraries):
    given = spark.createDataFrame(list(enumerate(TEXTS * 2)), "doc_id long, text string").repartition(3)
    rows, _ = run(given, keep_groups=True)
    want, _ = brute(libraries, TEXTS * 2)
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == dict(enumerate(want))
    for r in rows:
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")


def test_long_texts_in_parts(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "SEGMENT", 40)
    parts = list(alignment.segments("ab  c " * 50 + "d", 40))
    assert len(parts) > 3 and " ".join(parts) == "ab  c " * 50 + "d"
    text = "".join(f"word{i % 97}, déjà  vu\n next {i}! " for i in range(2000))
    aligner = alignment.Aligner(A, B)
    for good in (text, text + "▁"):
        block, at = alignment.Block(True), None
        at = block.new_text()
        cut = list(alignment.segments(good, 500))
        for i in range(0, len(cut), 7):
            block.add(alignment.Slice(aligner, cut[i : i + 7], [at] * len(cut[i : i + 7])))
        got = (*(c[0] for c in block.counts.values()), block.digests[0].hexdigest())
        want = brute(libraries, [good])[0][0]
        if good == text:
            assert got == (*want[:4], want[6])
        else:
            assert block.good == [False] and want[:4] == (0, 0, 0, 0)


@pytest.mark.parametrize("values", [[], [0], [254, 255, 256, 0, 1000, 510, 509]])
def test_squeezed(values):
    assert alignment.spread(alignment.squeezed(np.array(values, np.int64))).tolist() == values


def test_given_rows(spark, libraries):
    docs = awkward(spark, CLASHING)
    rows, _ = run(docs)
    texts = [r.text for r in docs.collect()]
    want, _ = brute(libraries, texts)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in rows) == sorted(want)
    rows, pairs = run(empty(spark))
    assert rows == [] and pairs.count() == 0


def test_query(spark, libraries):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    want, _ = brute(libraries, texts.values())
    got = queries.op13_alignment(spark, DATA)
    assert got.columns == ["doc_id", *COLUMNS]
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got.collect()} == dict(zip(texts, want, strict=True))
