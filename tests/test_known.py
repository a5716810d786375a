from datetime import timedelta
from random import Random

import pytest

from tallybrook.operators.known import first_touches

DAY = int(timedelta(days=1).total_seconds() * 1000)
SCHEMA = "key STRING, at BIGINT, n BIGINT"
KNOWN = "key STRING, last BIGINT"


def frame(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA).repartition(3)


def run(spark, batches, ttl):
    """Keys and times found new in each batch, state carried from one to the next."""
    known, out = spark.createDataFrame([], KNOWN), []
    for rows in batches:
        new, after = first_touches(frame(spark, rows), "key", "at", ttl, known, ["n"])
        out.append(sorted((r.key, r.at) for r in new.collect()))
        left = {r.key: r.last for r in known.collect()} | {r.key: r.last for r in after.collect()}
        known = spark.createDataFrame(list(left.items()), KNOWN)
    return out


def test_each_touch_renews(spark):
    daily = [[("daily", d * DAY)] + ([("silent", d * DAY)] if d in (0, 8) else []) for d in range(10)]
    found = run(spark, daily, 7 * DAY)
    assert found[0] == [("daily", 0), ("silent", 0)]
    assert found[8] == [("silent", 8 * DAY)]
    assert [f for i, f in enumerate(found) if i not in (0, 8)] == [[]] * 8


def test_within_one_batch(spark):
    rows = [("a", 0), ("a", 5), ("a", 16), ("a", 26), ("a", 37), ("b", 40), ("b", 40), (None, 1), ("c", None)]
    assert run(spark, [rows], 10) == [[("a", 0), ("a", 16), ("a", 37), ("b", 40)]]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = Random(seed)
    rows = sorted((rng.randint(-300, 300), rng.choice("abcd")) for _ in range(150))
    want, last = [], {}
    for at, key in rows:
        if key not in last or at - last[key] > 9:
            want.append((key, at))
        last[key] = at
    parts = [[(k, at) for at, k in rows[i : i + 50]] for i in range(0, 150, 50)]
    assert sorted(sum(run(spark, parts, 9), [])) == sorted(want)


def test_late_rows_are_known_and_a_hot_key_is_reduced_first(spark):
    assert run(spark, [[("a", 100)], [("a", 50), ("a", 105)]], 10) == [[("a", 100)], []]
    rows = spark.range(100_000).selectExpr("'hot' AS key", "id % 500 AS at", "id AS n")
    new, after = first_touches(rows, "key", "at", 10, spark.createDataFrame([], KNOWN), ["n"])
    assert [(r.at, r.n) for r in new.collect()] == [(0, 0)] and after.collect()[0].last == 499
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > 0
