"""Queries over tables in which one key holds a third of all rows."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from tallybrook.operators.skew import hot_keys
from tallybrook.plans import queries, tables
from tallybrook.session import work_path
from tests.conftest import DATA
from tools.check import compare, connect

KEYS = {
    "lineitem": {"l_orderkey": ("l_suppkey", 3), "l_partkey": ("l_linenumber", 5)},
    "orders": {"o_custkey": ("o_orderkey", 7)},
    "events": {"user_id": ("event_id", 1)},
}
OTHERS = ["customer", "part", "nation", "supplier"]
NAMES = [
    "dau_first_visit",
    "dim_upsert_latest",
    "first_order_flag",
    "user_state_upsert",
    "order_user",
    "detail_sku",
    "order_wide_join",
    "order_wide_dedup",
    "order_amount_split",
    "spu_amount_sum",
    "trademark_amount_sum",
    "sliding_window_join",
]


@pytest.fixture(scope="module")
def skewed(spark):
    """The test tables, rewritten so that a third of the rows share a key."""
    folder = work_path(spark, "skewed")
    for name in [*KEYS, *OTHERS]:
        df = spark.read.parquet(f"{DATA}/{name}.parquet")
        for key, (by, value) in KEYS.get(name, {}).items():
            hot = F.when(F.xxhash64(by, key) % 3 == 0, F.lit(value).cast("bigint"))
            df = df.withColumn(key, F.coalesce(hot, F.col(key)))
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def duck(skewed):
    con = connect(skewed)
    for name in [*KEYS, *OTHERS]:
        con.execute(
            f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{skewed}/{name}.parquet/*.parquet'"
        )
    return con


@pytest.fixture()
def hot_route(monkeypatch):
    """Orders of 200 lines are hot already and are cut every 64 ids."""
    eager = partial(hot_keys, hot_rows=200)
    monkeypatch.setattr(tables, "hot_keys", eager)
    monkeypatch.setattr(queries, "CHUNK_IDS", 64)


def test_the_hot_order_is_found(spark, skewed, hot_route):
    hot = tables.Tables(spark, skewed).hot_orders()
    assert [r.order_id for r in hot.collect()] == [3]


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, skewed, duck, hot_route, name):
    assert compare(spark, duck, name, skewed) == ""
