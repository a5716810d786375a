import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from tallybrook.llm import language_model as lm
from tests.llm.cases import awkward, documents, empty


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check(docs, **options):
    rows = docs.select("doc_id", "text").collect()
    counts = Counter(w for r in rows if not held(r["doc_id"]) for w in words_of(r["text"]))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        [
            (str(r["doc_id"]), held(r["doc_id"]), len(ws := words_of(r["text"])), sum(w in counts for w in ws), n,
             sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
            for r in rows
        ]
    )
    found = lm.scored(docs, **options).collect()
    got = sorted((str(r["doc_id"]), *list(r)[1:6]) for r in found)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    return found


def test_documents(spark):
    found = check(documents(spark), rounds=3, block_bytes=50_000)
    new = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in new) > 0.9 * sum(r["base_score"] for r in new)


def test_awkward_rows(spark):
    check(awkward(spark, ["block", "word", "held"]), rounds=1, states=2, classes=64)


def test_no_rows(spark):
    assert lm.scored(empty(spark), rounds=1).collect() == []


def test_nothing_to_learn_from(spark):
    only = next(i for i in range(100) if held(i))
    docs = spark.createDataFrame([(only, "some words")], "doc_id long, text string")
    row = lm.scored(docs, rounds=2, states=2, classes=8).first()
    assert (row["n_known"], row["train_tokens"]) == (0, 0)
    assert row["score"] == pytest.approx(0.0)


def random_model(rng, states, classes):
    draw = lambda *s: (x := rng.uniform(0.1, 1, s)) / x.sum(axis=-1, keepdims=True)
    return lm.Model(draw(states), draw(states, states), draw(states, classes))


def paths(model, seen):
    """Probability of every path of states together with what is seen."""
    for path in product(range(len(model.start)), repeat=len(seen)):
        p = model.start[path[0]] * model.emit[path[0], seen[0]]
        for a, b, c in zip(path, path[1:], seen[1:], strict=False):
            p *= model.move[a, b] * model.emit[b, c]
        yield path, p


def test_forward_is_the_sum_over_paths():
    rng = np.random.default_rng(2)
    model = random_model(rng, 3, 4)
    texts = [rng.integers(0, 4, n) for n in (1, 5, 3, 6, 3)]
    got = lm.log10_forward(model, np.concatenate(texts), np.array([len(t) for t in texts]))
    want = [math.log10(sum(p for _, p in paths(model, t))) for t in texts]
    assert got.tolist() == pytest.approx(want, rel=1e-10)


def test_expected_counts_are_sums_over_paths(monkeypatch):
    monkeypatch.setattr(lm, "STEP", 8)
    rng = np.random.default_rng(4)
    model = random_model(rng, 2, 3)
    texts = [rng.integers(0, 3, n) for n in (4, 1, 6, 2)]
    want = lm.Model(*(np.zeros(x.shape) for x in model))
    for t in texts:
        every = list(paths(model, t))
        total = sum(p for _, p in every)
        for path, p in every:
            want.start[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                want.move[a, b] += p / total
            for s, c in zip(path, t, strict=True):
                want.emit[s, c] += p / total
    got = lm.Model(*(np.zeros(x.shape) for x in model))
    likelihood = lm.expected(model, np.concatenate(texts), np.array([len(t) for t in texts]), got)
    for g, w in zip(got, want, strict=True):
        np.testing.assert_allclose(g, w, rtol=1e-4)
    assert likelihood == pytest.approx(sum(math.log(sum(p for _, p in paths(model, t))) for t in texts), rel=1e-5)


def test_training_raises_the_likelihood(spark):
    table = lm.encoded(documents(spark), "doc_id", "text", 512, 1 << 20).cache()
    blocks = table.where("kind = 'block'")
    rates = np.full(514, 1 / 513)
    rates[-1] = 0
    totals = lm.Totals(10_000, 500, 100, 100)
    _, seen = lm.trained(blocks, rates, totals, 4, 4, 128)
    assert all(b > a for a, b in zip(seen, seen[1:], strict=False))


def test_the_model_is_a_distribution(spark):
    rates = np.array([0.5, 0.3, 0.2, 0.0])
    emit = lm._emissions(np.array([[3.0, 1, 0, 0], [0, 0, 2, 0]]), rates, 0.1)
    assert emit.sum(axis=1).tolist() == pytest.approx([1, 1])


def test_passages_cover_whole_texts():
    assert lm._passages(np.array([5, 512, 513, 1024, 1]), 512).tolist() == [5, 512, 512, 1, 512, 512, 1]
