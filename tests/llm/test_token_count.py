import random

import pytest
from tokenizers import Tokenizer

from tallybrook.llm import token_count
from tests.llm.cases import awkward, documents, empty

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def transducer():
    return token_count.Transducer(PATH)


def size(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def check(docs, library):
    texts = docs.select("doc_id", "text").collect()
    want = sorted(
        [(r["doc_id"], len((r["text"] or "").encode()), n := size(library, r["text"]), n > 2048) for r in texts], key=repr
    )
    assert sorted(map(tuple, token_count.token_counts(docs, PATH).collect()), key=repr) == want


def test_documents(spark, library):
    check(documents(spark), library)


def test_awkward_rows(spark, library):
    check(awkward(spark, ["n_tokens", "row"]), library)


def test_no_rows(spark):
    assert token_count.token_counts(empty(spark), PATH).collect() == []


def test_texts_in_chunks_of_any_size(library, transducer):
    parts = ["don't", "'s'll", "ÉTÉ", "İstanbul", "Σας", "ΣΑΣ", "12345", "x1y2", "日本語", "<|endoftext|>",
             "<|startoftext|>A", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "!!'s", "café", "é", "abcdef" * 7,
             "aaaa" * 9, "---", "́", "<|EndOfText|>", "_", "''", "'re", "​", "ﬁ", "½", "٣", "\x00", "ǅ"]
    rnd = random.Random(3)
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))
        assert transducer.count(text, chunk=rnd.choice([1, 2, 3, 7, 50])) == size(library, text), text


def test_composition_is_associative(transducer):
    rnd = random.Random(1)
    for _ in range(300):
        a, b, c = (
            transducer.chunk("".join(rnd.choice("ab c\n'!1") for _ in range(rnd.randint(0, 8)))) for _ in range(3)
        )
        left = transducer.compose(transducer.compose(a, b), c)
        assert left == transducer.compose(a, transducer.compose(b, c))


def test_states_are_finite_and_may_be_forgotten(library, monkeypatch):
    monkeypatch.setattr(token_count, "_STATES", 50)
    monkeypatch.setattr(token_count, "_PIECES", 10)
    small = token_count.Transducer(PATH)
    rnd = random.Random(9)
    for _ in range(150):
        text = "".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(1, 90)))
        assert small.count(text) == size(library, text)
    assert len(small.states) <= 52 and len(small.known) <= 10


def test_repeating_input_needs_few_states(library, transducer):
    before = len(transducer.states)
    assert transducer.count("ab" * 50_000) == size(library, "ab" * 50_000)
    assert len(transducer.states) - before < 200
