import pytest

from tallybrook.operators.keyed import distinct_by_key, first_by_key, latest_by_key
from tallybrook.operators.lookup import add_province, enrich_sku, lookup, rows_for_keys


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id BIGINT, sku_id BIGINT")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(10, "a:b"), (30, "c")], "id BIGINT, name STRING")


def test_unknown_keys(facts, dim):
    out = lookup(facts, dim, "sku_id", {"name": "sku_name"})
    assert sorted((r.id, r.sku_name) for r in out.collect()) == [(1, "a:b"), (2, None), (3, None)]
    out = lookup(facts, dim, "sku_id", {"name": "sku_name"}, on_missing="drop")
    assert [(r.id, r.sku_name) for r in out.collect()] == [(1, "a:b")]
    with pytest.raises(Exception, match="no dimension row"):
        lookup(facts, dim, "sku_id", {"name": "sku_name"}, on_missing="fail").collect()
    with pytest.raises(ValueError):
        lookup(facts, dim, "sku_id", {}, on_missing="ignore")


def test_fail_passes_when_all_keys_are_known(facts, dim):
    known = facts.where("sku_id = 10")
    out = lookup(known, dim, "sku_id", {"name": "sku_name"}, on_missing="fail")
    assert out.columns == ["id", "sku_id", "sku_name"]
    assert out.count() == 1


def test_rows_for_keys_once_each(facts, dim):
    twice = facts.union(facts)
    assert [r.id for r in rows_for_keys(dim, "id", twice, "sku_id").collect()] == [10]


def test_province_and_sku_names(spark, dim):
    orders = spark.createDataFrame([(1, 1), (2, 9)], "id BIGINT, province_id BIGINT")
    province = spark.createDataFrame([(1, "P", "R", "A")], "id BIGINT, name STRING, region_id STRING, area_code STRING")
    got = {r.id: (r.province_name, r.province_area_code) for r in add_province(orders, province).collect()}
    assert got == {1: ("P", "A"), 2: (None, None)}
    sku = spark.createDataFrame([(1, 10, 30, 77)], "id BIGINT, category3_id BIGINT, tm_id BIGINT, spu_id BIGINT")
    tm = dim.withColumnRenamed("name", "tm_name")
    spu = dim.withColumnRenamed("name", "spu_name")
    row = enrich_sku(sku, dim, tm, spu).first()
    assert (row.category3_name, row.tm_name, row.spu_name) == ("a:b", "c", None)


def test_one_row_per_key(spark):
    rows = [("x", 2, "b"), ("x", 1, "a"), ("x", 3, "c"), ("y", 1, "d")]
    df = spark.createDataFrame(rows, "k STRING, at INT, v STRING")
    for parts in (1, 4):
        d = df.repartition(parts)
        assert sorted(r.v for r in first_by_key(d, ["k"], ["at"]).collect()) == ["a", "d"]
        assert sorted(r.v for r in latest_by_key(d, ["k"], ["at"]).collect()) == ["c", "d"]
    twice = df.union(df)
    once = distinct_by_key(twice, ["k", "at"])
    assert sorted(once.collect()) == sorted(df.collect())
    assert distinct_by_key(once, ["k", "at"]).count() == 4
