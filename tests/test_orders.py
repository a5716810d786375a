import datetime as dt
import random

from pyspark.sql import functions as F

from tallybrook.operators.orders import add_date_parts, consumed_users, flag_first_orders
from tallybrook.operators.users import label_users


def _orders(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, user_id BIGINT, create_time STRING").withColumn(
        "create_time", F.col("create_time").cast("timestamp_ntz")
    )


def test_first_order_flags(spark):
    orders = _orders(
        spark,
        [
            (1, 10, "2020-01-02 00:00:00"),
            (2, 10, "2020-01-01 00:00:00"),
            (3, 10, "2020-01-03 00:00:00"),
            (4, 20, "2020-01-01 00:00:00"),
            (5, 20, "2020-01-02 00:00:00"),
            (7, 30, "2020-01-01 00:00:00"),
            (6, 30, "2020-01-01 00:00:00"),
            (8, 40, "2020-01-01 00:00:00"),
        ],
    )
    state = spark.createDataFrame([(20, "1"), (40, "0")], "user_id BIGINT, if_consumed STRING")
    flagged = flag_first_orders(orders, state)
    first = {r.id for r in flagged.collect() if r.if_first_order == "1"}
    assert flagged.count() == 8
    assert first == {2, 6, 8}
    assert {r.user_id for r in consumed_users(flagged).collect()} == {10, 30, 40}


def test_first_order_with_one_user_holding_most_rows(spark):
    rnd = random.Random(3)
    rows = [
        (i, 1 if i % 3 == 0 else i % 50, f"2020-01-{rnd.randint(1, 28):02d} 00:00:00")
        for i in range(3000)
    ]
    want = {}
    for i, user, at in rows:
        want[user] = min(want.get(user, (at, i)), (at, i))
    for parts in (1, 7):
        flagged = flag_first_orders(_orders(spark, rows).repartition(parts))
        got = {r.id for r in flagged.where("if_first_order = '1'").collect()}
        assert got == {i for _, i in want.values()}


def test_date_parts_of_text_and_timestamp(spark):
    text = spark.createDataFrame([("2020-05-12 09:08:07",), ("2020-05-12",)], "create_time STRING")
    assert [(r.create_date, r.create_hour) for r in add_date_parts(text).collect()] == [
        ("2020-05-12", "09"),
        ("2020-05-12", None),
    ]
    stamp = text.limit(1).select(F.col("create_time").cast("timestamp_ntz"))
    row = add_date_parts(stamp).first()
    assert (row.create_date, row.create_hour) == ("2020-05-12", "09")


def test_user_labels(spark):
    as_of = dt.date(2020, 5, 12)

    def born(years, extra_days=0):
        return as_of - dt.timedelta(days=365 * years + extra_days)

    rows = [
        ("19", born(20, -1), "M"),
        ("20", born(20), "F"),
        ("30", born(31, -1), None),
        ("31", born(31), "m"),
        ("unknown", None, "M"),
    ]
    users = spark.createDataFrame(rows, "id STRING, birthday DATE, gender STRING")
    got = {
        r.id: (r.age_group, r.gender_name)
        for r in label_users(users, F.lit(as_of)).collect()
    }
    assert got == {
        "19": ("20岁及以下", "男"),
        "20": ("21岁到30岁", "女"),
        "30": ("21岁到30岁", "女"),
        "31": ("30岁以上", "女"),
        "unknown": (None, "男"),
    }
