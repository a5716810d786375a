import numpy as np
import pytest

from tallybrook.llm import hamming


def brute(rows, queries, k):
    code = {}
    for i, v in rows:
        if i is not None and v is not None:
            code[i] = sum(1 << j for j, x in enumerate(v) if (x or 0) > 0)
    out = []
    for q in queries:
        if q in code:
            near = sorted(((code[q] ^ c).bit_count(), i) for i, c in code.items() if i != q)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, code string, id string")


def check(spark, rows, k, every=5, **options):
    df = table(spark, [(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y") for i, v in rows])
    queries = df.where(f"vec_id % {every} = 0")
    got = hamming.top_k(df, queries, "vec_id", "embedding", k, **options)
    want = brute(rows, [i for i in dict(rows) if i is not None and i % every == 0], k)
    assert sorted(map(tuple, got.collect())) == want


def test_random_vectors_in_shards_and_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 40)))]
    check(spark, rows, 10, shard=70, block=9)


def test_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(4, 16))
    rows = [(i, base[i % 4 if i % 3 else 0].tolist()) for i in range(90)]
    check(spark, rows, 7)


def test_nulls_repeats_and_few_rows(spark):
    rows = [(0, [1, -1, 0, 2]), (0, [1, -1, 0, 2]), (5, None), (10, [None, -1, 0, 2]), (None, [1, 1, 1, 1]), (3, [1, -1, 1, 2])]
    check(spark, rows, 10)


def test_no_rows(spark):
    df = table(spark, [])
    assert hamming.top_k(df, df, "vec_id", "embedding").collect() == []


@pytest.mark.parametrize("size", [1, 3, 50, 3000])
def test_index_finds_all_up_to_the_kth(size):
    rng = np.random.default_rng(size)
    packed = rng.integers(0, 256, (size, 6)).astype(np.uint8)
    index, wanted = hamming.Index(packed), rng.integers(1, 4, size)
    for code in rng.integers(0, 256, (10, 6)).astype(np.uint8):
        apart = np.bitwise_count(packed ^ code).sum(axis=1)
        rows = np.sort(np.repeat(apart, wanted))
        kth = rows[min(5, len(rows)) - 1] if len(rows) >= 5 else 48
        entries, distance = index.nearest(code, wanted, 5)
        got = dict(zip(entries.tolist(), distance.tolist(), strict=True))
        assert got == {i: d for i, d in enumerate(apart.tolist()) if d <= kth}


def test_query_equals_sql(spark):
    from tallybrook.llm.queries import QUERIES
    from tests.conftest import DATA

    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0], 10)
    assert sorted(map(tuple, QUERIES["op5_hamming"](spark, DATA).collect())) == want
