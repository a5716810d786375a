from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallybrook.llm import simhash
from tallybrook.llm.components import components
from tests.llm.cases import COLUMNS, awkward, documents, empty


def brute_print(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i : i + n] for i in range(len(words) - n + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=2):
    """Smallest id per fingerprint by searching outwards from every one."""
    near = {p: [q for q in prints if (p ^ q).bit_count() <= most] for p in prints}
    out = {}
    for p in prints:
        seen, todo = {p}, [p]
        while todo:
            new = [q for q in near[todo.pop()] if q not in seen]
            seen.update(new)
            todo += new
        ids = [i for q in seen for i in prints[q] if i is not None]
        out[p] = min(ids) if ids else None
    return out


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = {}
    for r in rows:
        prints.setdefault(brute_print(r["text"]), []).append(r["doc_id"])
    smallest = brute_components(prints)
    want = Counter((r["doc_id"], p := brute_print(r["text"]), smallest[p]) for r in rows)
    found = simhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in found) == want


def test_documents(spark):
    check(documents(spark))


def test_awkward_rows(spark):
    check(awkward(spark, ["fp", "component_id", "row"]))


def test_no_rows(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.one_per_group(empty(spark)).collect() == []


def test_links_connect_all_within_two_bits(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 12, np.uint64)
    # A dense cluster in two bytes, chains of small steps, and strangers.
    cluster = [int(base[0]) ^ int(x) for x in rng.integers(0, 1 << 16, 400)]
    chain = [int(base[1])]
    for i in range(40):
        chain.append(chain[-1] ^ (1 << (i % 64)) ^ (1 << ((i * 7 + 3) % 64)))
    prints = {p: [i] for i, p in enumerate({*cluster, *chain, *map(int, base), 0, 1, (1 << 64) - 1})}
    rows = [(i[0], np.uint64(p).view(np.int64).item()) for p, i in prints.items()]
    table = spark.createDataFrame(rows, "id long, fp long")
    got = {r["fp"] & (1 << 64) - 1: r["first"] for r in simhash.classes(table, "id").collect()}
    assert got == brute_components(prints)


def test_edges_of_a_list_stay_few(spark):
    members = spark.range(0, 1 << 12).select(F.col("id").alias("fp"))
    edges = simhash.links(members).count()
    assert edges < 28 * (1 << 12)


def test_one_per_group(spark):
    docs = awkward(spark, ["fp", "row", "_row"])
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    groups = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(groups)
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()}


def test_one_per_group_of_documents(spark):
    kept = simhash.one_per_group(documents(spark))
    want = {r["component_id"] for r in simhash.near_duplicates(documents(spark)).collect()}
    assert kept.columns == COLUMNS
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_components_of_long_chains(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(500, 501), (900, 900), (None, 3)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges, "a", "b").collect()}
    assert {got[i] for i in range(201)} == {got[0]}
    assert got[500] == got[501] != got[0] and got[900] == 900


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
