import json

import pytest
from pyspark.sql import functions as F

from tallybrook import schemas
from tallybrook.operators.cdc import DEAD_LETTER_TOPIC, route_canal, route_maxwell
from tallybrook.operators.records import parse_json, topic_rows


def _values(spark, *envelopes):
    rows = [(e if isinstance(e, str) else json.dumps(e),) for e in envelopes]
    return spark.createDataFrame(rows, "value STRING")


def test_canal_unfolds_rows_and_drops_empty_envelopes(spark):
    df = _values(
        spark,
        {"table": "order_info", "type": "INSERT", "data": None},
        {"table": "order_info", "type": "INSERT", "data": []},
        {"table": "order_info", "type": "DELETE", "data": [{"id": "1", "a": 5}, {"id": 2}]},
        "no json",
    )
    out = sorted(route_canal(df).collect(), key=lambda r: r.key)
    assert [(r.topic, r.key) for r in out] == [("ODS_T_ORDER_INFO", "1"), ("ODS_T_ORDER_INFO", "2")]
    assert json.loads(out[0].value) == {"id": "1", "a": 5}


def test_maxwell_predicate(spark):
    row = {"id": 1}
    kept = [
        {"table": "order_info", "type": "insert", "data": row},
        {"table": "sku_info", "type": "update", "data": row},
        {"table": "order_detail", "type": "bootstrap-insert", "data": row},
    ]
    dropped = [
        {"table": "order_info", "type": "update", "data": row},
        {"table": "order_info", "type": "delete", "data": row},
        {"table": "sku_info", "type": "delete", "data": row},
        {"table": "SKU_INFO", "type": "insert", "data": row},
        {"table": "unknown", "type": "insert", "data": row},
        {"table": "sku_info", "type": "insert", "data": {}},
        {"table": "sku_info", "type": "insert", "data": None},
        {"table": "sku_info", "type": "insert"},
    ]
    out = route_maxwell(_values(spark, *kept, *dropped)).collect()
    assert sorted((r.topic, r.type) for r in out) == [
        ("ODS_T_ORDER_DETAIL", "bootstrap-insert"),
        ("ODS_T_ORDER_INFO", "insert"),
        ("ODS_T_SKU_INFO", "update"),
    ]


def test_key_field_per_table(spark):
    df = _values(
        spark,
        {"table": "base_trademark", "type": "insert", "data": {"tm_id": 9, "tm_name": "x"}},
        {"table": "spu_info", "type": "insert", "data": {"id": 3}},
    )
    keyed = route_maxwell(df, key_fields={"base_trademark": "tm_id"}).collect()
    assert sorted(r.key for r in keyed) == ["3", "9"]


def test_typed_record_ignores_extra_and_nulls_missing(spark):
    df = _values(
        spark,
        {"id": 7, "order_price": 12.5, "create_time": "2020-05-12 10:11:12", "other": [1]},
    )
    row = parse_json(df, schemas.ORDER_DETAIL).first()
    assert (row.id, str(row.order_price), row.create_time.hour) == (7, "12.50", 10)
    assert row.sku_name is None


def test_quoted_numbers_are_read(spark):
    df = _values(
        spark,
        {"id": "9223372036854775807", "order_price": "12.5", "sku_num": 3},
        {"id": "x", "sku_num": "99999999999999999999", "sku_name": "kept"},
    )
    first, second = parse_json(df, schemas.ORDER_DETAIL).collect()
    assert (first.id, str(first.order_price), first.sku_num) == (2**63 - 1, "12.50", 3)
    assert (second.id, second.sku_num, second.sku_name) == (None, None, "kept")


def test_topic_rows_leave_out_nulls(spark):
    df = spark.createDataFrame([(1, None)], "id INT, name STRING")
    row = topic_rows(df, "T", F.col("id")).first()
    assert (row.topic, row.key, row.value) == ("T", "1", '{"id":1}')
    assert topic_rows(df, "T").first().key is None


def test_envelope_is_parsed_once(spark):
    for route in (route_canal, route_maxwell):
        plan = route(_values(spark, {}))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1 and "from_json" not in plan


def test_amounts_keep_their_digits(spark):
    row = '{"id": 12345678901234567, "order_price": 1234567890123456.78, "sku_name": "1.10", "sku_num": 5}'
    for route, data in ((route_canal, f"[{row}]"), (route_maxwell, row)):
        text = f'{{"table": "order_detail", "type": "insert", "data": {data}}}'
        out = route(_values(spark, text))
        assert out.first().key == "12345678901234567"
        record = parse_json(out, schemas.ORDER_DETAIL).first()
        assert (record.id, str(record.order_price)) == (12345678901234567, "1234567890123456.78")
        assert record.sku_name == "1.10"


def test_envelopes_that_cannot_be_routed(spark):
    bad = ["no json", '{"type": "insert", "data": [{"id": 1}]}', "[1]", '{"table": null, "data": {"id": 1}}']
    for route in (route_canal, route_maxwell):
        assert route(_values(spark, *bad)).collect() == []
        rows = route(_values(spark, *bad), dead_letter=DEAD_LETTER_TOPIC).collect()
        assert sorted(r.value for r in rows) == sorted(bad)
        assert {(r.topic, r.key) for r in rows} == {(DEAD_LETTER_TOPIC, None)}


def test_deletes_become_tombstones(spark):
    row = {"id": 1, "spu_name": "x"}
    canal = _values(
        spark,
        {"table": "spu_info", "type": "DELETE", "data": [row, None]},
        {"table": "spu_info", "type": "INSERT", "data": [row]},
    )
    found = {(r.key, r.value is None) for r in route_canal(canal, tombstones=True).collect()}
    assert found == {("1", True), ("1", False)}
    assert all(r.value for r in route_canal(canal).collect())
    maxwell = _values(
        spark,
        {"table": "spu_info", "type": "delete", "data": row},
        {"table": "order_info", "type": "delete", "data": row},
        {"table": "spu_info", "data": row},
    )
    assert [(r.key, r.value) for r in route_maxwell(maxwell, tombstones=True).collect()] == [("1", None)]
    assert route_maxwell(maxwell).count() == 0


def test_fields_in_place_of_text(spark):
    rows = [
        {"id": 1, "n": 5, "m": 1.25, "s": "a"}, {"id": 2, "n": "6", "m": "2.50", "s": 7}, {"id": 3},
        {"id": 4, "n": "x", "m": None, "s": None}, {"id": 5, "n": 12345678901, "m": 3, "s": "é"},
    ]
    df = _values(spark, {"table": "order_detail", "type": "INSERT", "data": rows}, "no json")
    fields = "n BIGINT, m DECIMAL(18,2), s STRING"
    typed = sorted(route_canal(df, record=fields).collect(), key=lambda r: r.key)
    text = parse_json(route_canal(df), fields, keep=["topic", "key"])
    assert typed == sorted(text.collect(), key=lambda r: r.key)
    with pytest.raises(ValueError):
        route_canal(df, record=fields, dead_letter="D")
