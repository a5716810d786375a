import random

import pytest
from pyspark.sql import functions as F

from tallybrook.operators.search import match_search
from tallybrook.operators.text_index import build_index, search_index
from tallybrook.sources.tables import bucket_of


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(60)] + ["The", "the", "Étude", "国家", "a-b", "x_y", ""]
    rows = [(i, rng.randint(0, 9), " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(600)]
    rows += [(1000, 3, None), (1001, 3, ""), (1002, None, "the word1")]
    df = spark.createDataFrame(rows, "id LONG, rank INT, text STRING").repartition(4)
    path = str(tmp_path_factory.mktemp("index") / "i")
    build_index(df, "text", ["rank", "id"], path, buckets=16)
    return df, path


@pytest.mark.parametrize("query", ["the", "word1 word2 WORD3", "étude", "家", "a", "nothing here", "", "b-a"])
@pytest.mark.parametrize("size", [1, 10, None])
def test_index_equals_the_scan(spark, texts, query, size):
    df, path = texts
    want = match_search(df, "text", query, ["rank", "id"], size).select("rank", "id").collect()
    assert search_index(spark, path, query, size).select("rank", "id").collect() == want


def test_only_buckets_of_the_terms_are_opened(spark, texts):
    _, path = texts
    found = search_index(spark, path, "word7", 5)
    (bucket,) = [r[0] for r in spark.createDataFrame([("word7",)], "t STRING").select(bucket_of(["t"], 16)).collect()]
    assert {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()} == {str(bucket)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,word7)" in plan and "text" not in plan.split("ReadSchema")[1]


def test_other_columns_and_no_index(spark, tmp_path):
    df = spark.createDataFrame([(1, "x y", "k")], "id LONG, text STRING, more STRING")
    build_index(df.where("false"), "text", ["id"], str(tmp_path / "none"))
    assert search_index(spark, str(tmp_path / "none"), "x").count() == 0
    build_index(df, "text", ["id"], str(tmp_path / "one"), keep=["more", "id"])
    assert search_index(spark, str(tmp_path / "one"), "y").select(F.col("more")).collect()[0][0] == "k"
    with pytest.raises(ValueError, match="no index"):
        search_index(spark, str(tmp_path / "gone"), "x")
