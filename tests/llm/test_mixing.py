import re
from collections import defaultdict
from fractions import Fraction

import pytest

from tallybrook.llm import mixing
from tests.llm.cases import COLUMNS, awkward, documents, empty


def brute_targets(sizes):
    """Targets by source: shares by weight, what is above twice a source's size reshared."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_, out = Fraction(3, 2) * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit > 2 * sizes[s]}
        if not full:
            out.update({s: weight[s] * unit for s in open_})
            break
        out.update({s: Fraction(2 * sizes[s]) for s in full})
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return out


def check(docs):
    rows = docs.collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += size(r["text"])
    want = brute_targets(sizes)
    found = mixing.mixed(docs).collect()
    source_of = {r["doc_id"]: r["source"] for r in rows}
    assert len(found) == len(rows)
    taken = defaultdict(int)
    for r in found:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(float(want[s]), rel=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    return found


def test_documents(spark):
    docs = documents(spark)
    first = sorted(map(tuple, check(docs)))
    again = sorted(map(tuple, mixing.mixed(docs.repartition(7)).collect()))
    assert first == again


def test_awkward_rows(spark):
    docs = awkward(spark, ["_size", "_key", "row"]).where("doc_id is not null or source is null")
    check(docs)


def test_many_stretches(spark, monkeypatch):
    whole = sorted(map(tuple, mixing.mixed(documents(spark)).collect()))
    monkeypatch.setattr(mixing, "STRETCH", 3)
    assert sorted(map(tuple, mixing.mixed(documents(spark)).collect())) == whole


def test_no_rows_and_no_words(spark):
    assert mixing.mixed(empty(spark)).collect() == []
    assert mixing.training_order(empty(spark)).collect() == []
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mixed(docs).collect()] == [(0, 0.0, 0)] * 2


def test_sources_that_stop_at_twice_their_size(spark):
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 10), ("b", 1000), ("c", 1000), (None, 4)])]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"))


def test_schedule_inverts(spark):
    from pyspark.sql import functions as F

    for schedule in mixing.SCHEDULES:
        column = F.array(*[F.lit(x) for x in schedule])
        shares = [i / 50 for i in range(51)]
        df = spark.createDataFrame([(s,) for s in shares], "share double")
        times = [r["t"] for r in df.select("share", mixing.time_of(F.col("share"), column).alias("t")).orderBy("share").collect()]

        def given(t, w=schedule):
            steps = 4000
            at = [(k + 0.5) * t / steps for k in range(steps)]
            value = lambda x: w[0] + (w[1] - w[0]) * x / 0.5 if x < 0.5 else w[1] + (w[2] - w[1]) * (x - 0.5) / 0.5
            return sum(map(value, at)) * t / steps / (0.25 * (w[0] + 2 * w[1] + w[2]))

        assert times[0] == 0 and times[-1] == pytest.approx(1)
        for s, t in zip(shares, times, strict=True):
            assert given(t) == pytest.approx(s, abs=1e-6)


def test_all_uses_are_sorted_into_the_mix(spark):
    """Each use has its place: in the order of positions the uses follow each other without a gap."""
    docs = documents(spark)
    found = mixing.mixed(docs).collect()
    assert any(len(r["uses"]) == 2 for r in found) and any(not r["uses"] for r in found)
    for r in found:
        assert sum(u["words"] for u in r["uses"]) == r["taken"]
        assert (r["uses"][0]["position"] if r["uses"] else None) == r["position"]
    uses = sorted((u["start"], u["words"], u["position"]) for r in found for u in r["uses"])
    at = 0
    for start, words, _ in uses:
        assert start == at
        at += words
    assert [u[2] for u in uses if u[1]] == sorted(u[2] for u in uses if u[1])
    assert [r["text"] for r in mixing.training_order(docs).collect()]


def test_training_order(spark):
    docs = documents(spark)
    plan = {r["doc_id"]: r for r in mixing.mixed(docs).collect()}
    out = mixing.training_order(docs)
    assert out.columns == COLUMNS
    rows = out.collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    words = defaultdict(int)
    for r in rows:
        assert texts[r["doc_id"]].startswith(r["text"]) and len(r["text"]) == r["n_chars"]
        words[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert words == {i: r["taken"] for i, r in plan.items() if r["taken"]}
    firsts = {}
    for r in rows:
        firsts.setdefault(r["doc_id"], plan[r["doc_id"]]["position"])
    assert list(firsts.values()) == sorted(firsts.values())


def test_training_order_of_awkward_rows(spark):
    docs = awkward(spark, ["_size", "position", "c0"])
    assert mixing.training_order(docs).columns == docs.columns
    assert mixing.training_order(docs).count() > 0
