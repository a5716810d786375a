import random

from pyspark.sql import functions as F

from tallybrook.operators.window_join import sliding_window_join, slide_index


def windows_shared(a, b, windows):
    """Sliding windows that hold both slides, counted one by one."""
    return sum(
        1
        for end in range(min(a, b) - windows, max(a, b) + windows + 1)
        if end - windows < a <= end and end - windows < b <= end
    )


def test_pairs_and_counts(spark):
    rnd = random.Random(6)
    left = [(rnd.randint(0, 5), i, rnd.randint(-40, 40)) for i in range(120)]
    right = [(rnd.randint(0, 5), i, rnd.randint(-40, 40)) for i in range(150)]
    a = spark.createDataFrame(left, "k INT, a_id INT, sa BIGINT")
    b = spark.createDataFrame(right, "k INT, b_id INT, sb BIGINT")
    for windows in (1, 3, 20):
        want = {
            (x[1], y[1]): windows_shared(x[2], y[2], windows)
            for x in left
            for y in right
            if x[0] == y[0] and windows_shared(x[2], y[2], windows)
        }
        rows = sliding_window_join(a, b, "k", "sa", "sb", windows).collect()
        assert len(rows) == len(want)
        assert {(r.a_id, r.b_id): r.n_emits for r in rows} == want


def test_without_counts(spark):
    a = spark.createDataFrame([(1, 5)], "k INT, sa BIGINT")
    b = spark.createDataFrame([(1, 7), (1, 8)], "k INT, sb BIGINT")
    out = sliding_window_join(a, b, "k", "sa", "sb", emits=None)
    assert [tuple(r) for r in out.collect()] == [(1, 5, 7)]


def test_slide_index(spark):
    df = spark.sql("SELECT timestamp_seconds(s) AS ts FROM VALUES (-1L), (0L), (4L), (5L), (14L) v(s)")
    assert [r[0] for r in df.select(slide_index(F.col("ts"), 5)).collect()] == [-1, 0, 0, 1, 2]
