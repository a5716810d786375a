"""Shares against a replay of the rule, line by line."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybrook.operators.allocation import allocate_batch, allocate_cents
from tallybrook.operators.running import (
    chunked_running_totals,
    cut_into_ranges,
    running_totals,
)
from tallybrook.operators.skew import HOT_ROWS, by_heat, hot_keys
from tallybrook.plans.tables import LINE_ORDER, number_lines

SCHEMA = (
    "order_id BIGINT, id BIGINT, amount_cents BIGINT, original_cents BIGINT, final_cents BIGINT"
)


def replay(lines):
    """The rule with exact numbers: lines in id order, each sees those before it."""
    seen, out = {}, {}
    for order, line, amount, original, final in sorted(lines, key=lambda r: r[:2]):
        reached, given = seen.get(order, (0, 0))
        if reached + amount == original:
            share = final - given
        elif original == 0:
            share = None
        else:
            share = (2 * final * amount + original) // (2 * original)
        seen[order] = (reached + amount, given + (share or 0))
        out[order, line] = share
    return out


def shares(df):
    return {(r.order_id, r.id): r.final_detail_cents for r in df.collect()}


def orders_of(rnd, n, most=6):
    lines = []
    for order in range(n):
        amounts = [rnd.choice([0, 0, rnd.randint(1, 9999)]) for _ in range(rnd.randint(1, most))]
        original = sum(amounts) + rnd.choice([0, 0, 0, 5])
        final = rnd.randint(0, 20000)
        lines += [(order, order * 100 + i, a, original, final) for i, a in enumerate(amounts)]
    return lines


CASES = {
    "equal lines": ([100, 100, 100], 300, 10000, [3333, 3333, 3334]),
    "one line": ([500], 500, 123, [123]),
    "nothing to pay for": ([0, 0], 0, 777, [777, 0]),
    "zero total, line of value": ([5, 0], 0, 777, [None, None]),
    "zero lines around": ([0, 40, 60, 0], 100, 999, [0, 400, 599, 0]),
    "never complete": ([10, 20], 100, 1000, [100, 200]),
    "half cent goes up": ([1, 1], 2, 1, [1, 0]),
    "beyond 64 bits": ([3 * 10**10, 10**10], 4 * 10**10, 8 * 10**10 + 1, [6 * 10**10 + 1, 2 * 10**10]),
}


@pytest.mark.parametrize("case", CASES)
def test_cases(spark, case):
    amounts, original, final, want = CASES[case]
    lines = [(1, i, a, original, final) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(lines, SCHEMA)
    got = shares(allocate_cents(df, ["id"]))
    assert [got[1, i] for i in range(len(amounts))] == want
    assert got == replay(lines)
    chunked = shares(allocate_cents(df, ["id"], F.floor(F.col("id") / 2)))
    assert chunked == got


def test_random_orders_on_both_routes(spark):
    lines = orders_of(random.Random(1), 300)
    want = replay(lines)
    for parts in (1, 5):
        df = spark.createDataFrame(lines, SCHEMA).repartition(parts)
        assert shares(allocate_cents(df, ["id"])) == want
        assert shares(allocate_cents(df, ["id"], F.floor(F.col("id") / 3))) == want


def test_hot_order_is_split_and_whole(spark):
    rnd = random.Random(2)
    amounts = [rnd.randint(0, 500) for _ in range(4000)]
    hot_lines = [(-1, i, a, sum(amounts), 1_000_003) for i, a in enumerate(amounts)]
    lines = orders_of(rnd, 500) + hot_lines
    df = spark.createDataFrame(lines, SCHEMA)
    hot = hot_keys(df, "order_id", hot_rows=1000)
    assert [r.order_id for r in hot.collect()] == [-1]
    out = by_heat(
        df,
        "order_id",
        hot,
        lambda d: allocate_cents(d, ["id"]),
        lambda d: allocate_cents(d, ["id"], F.floor(F.col("id") / 256)),
    )
    got = shares(out)
    assert got == replay(lines)
    assert sum(v for (order, _), v in got.items() if order == -1) == 1_000_003


def test_no_hot_keys(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert hot_keys(df, "k") is None


@pytest.mark.parametrize("quantity", ["1.0", "cast(id % 5 as double)"])
def test_one_order_of_a_million_lines_with_the_shipped_settings(spark, quantity):
    """Lines that compress to nothing, all of them equal or nearly so."""
    n = HOT_ROWS + 200_000
    lines = spark.range(n).selectExpr(
        "case when id % 100 = 0 then id else 7 end as order_id", "1 as l_linenumber", "5L as l_partkey",
        "5L as l_suppkey", f"{quantity} as l_quantity", "1.0D as l_extendedprice",
    )
    assert hot_keys(lines.where("id < 1000"), "order_id") is None
    hot = hot_keys(lines, "order_id")
    assert [r.order_id for r in hot.collect()] == [7]
    mine = lines.where("order_id = 7")
    ranges, _ = cut_into_ranges(mine, "order_id", LINE_ORDER)
    assert ranges.groupBy("_chunk").count().agg({"count": "max"}).first()[0] < n / 2
    out = number_lines(mine, split=True).agg(F.count("*"), F.min("seq"), F.max("seq"), F.countDistinct("seq"))
    size = mine.count()
    assert tuple(out.first()) == (size, 1, size, size)


def test_line_numbers_on_both_routes(spark):
    rnd = random.Random(4)
    rows = [
        (rnd.randint(1, 5), rnd.randint(1, 3), rnd.randint(1, 5000), i, 1.0, 2.0)
        for i in range(2000)
    ]
    cols = ", ".join(
        f"{c} {t}"
        for c, t in zip(["order_id", *LINE_ORDER], ["BIGINT", "INT", "BIGINT", "BIGINT", "DOUBLE", "DOUBLE"])
    )
    lines = spark.createDataFrame(rows, cols)
    want, seen = {}, {}
    for r in sorted(rows):
        seen[r[0]] = seen.get(r[0], 0) + 1
        want[r[0], r[3]] = seen[r[0]]
    for split in (False, True):
        got = {(r.order_id, r.l_suppkey): r.seq for r in number_lines(lines, split).collect()}
        assert got == want


def test_running_totals_with_group_sums(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 3), i, rnd.randint(-5, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g BIGINT, i BIGINT, v BIGINT")
    args = ("g", ["i"], {"run": F.col("v")})
    plain = running_totals(df, *args, overall={"total": F.col("v")})
    split = chunked_running_totals(
        df, *args, F.floor(F.col("i") / 50), overall={"total": F.col("v")}
    )
    assert sorted(plain.collect()) == sorted(split.select(plain.columns).collect())


def shared_one_by_one(lines, original, final, state):
    """Shares of lines in the order given; ``state`` is what earlier ones left: lines, cents, given."""
    out = []
    for amount in lines:
        n, reached, given = state
        if reached + amount == original and (amount or n == 0):
            share = final - given
        elif reached + amount == original:
            share = 0
        else:
            share = (2 * final * amount + original) // (2 * original) if original else None
        state = (n + 1, reached + amount, given + (share or 0))
        out.append(share)
    return out, state


@pytest.mark.parametrize("hot_rows", [1_000_000, 20])
def test_lines_of_several_batches_in_any_order(spark, hot_rows):
    rng = random.Random(7)
    orders = {}
    for o in range(12):
        lines = [(o * 1000 + i, rng.choice([0, 1, 333, 1999, 100_000])) for i in range(rng.choice([1, 3, 90]))]
        orders[o] = (lines, sum(a for _, a in lines), rng.randint(0, 10**7))
    sums = spark.createDataFrame([], "order_id LONG, lines LONG, cents LONG, given LONG")
    want, got, states = {}, {}, {o: (0, 0, 0) for o in orders}
    for k in range(3):
        rows = []
        for o, (lines, original, final) in orders.items():
            part = lines[k::3]
            shares, states[o] = shared_one_by_one([a for _, a in part], original, final, states[o])
            want |= {i: s for (i, _), s in zip(part, shares, strict=True)}
            rows += [(o, i, Decimal(a) / 100, 1, Decimal(original) / 100, Decimal(final) / 100) for i, a in part]
        rng.shuffle(rows)
        wide = spark.createDataFrame(
            rows,
            "order_id LONG, order_detail_id LONG, sku_price DECIMAL(18,2), sku_num LONG, "
            "original_total_amount DECIMAL(18,2), final_total_amount DECIMAL(18,2)",
        ).repartition(5)
        shared, left = allocate_batch(wide, sums, hot_rows=hot_rows)
        got |= {
            r.order_detail_id: None if r.final_detail_amount is None else int(r.final_detail_amount * 100)
            for r in shared.collect()
        }
        kept = {r.order_id: tuple(r) for r in sums.collect()} | {
            r.order_id: (r.order_id, r.lines, r.cents, r.given) for r in left.collect()
        }
        sums = spark.createDataFrame(list(kept.values()), sums.schema)
    assert got == want
    assert {o: tuple(r)[1:] for o, r in kept.items()} == {o: s for o, s in states.items() if s[0]}
