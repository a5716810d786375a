"""An inverted index over a text column: which rows hold a term, in the order of results.

Postings lie in buckets by a hash of their term, sorted by term and then as results are. A search
opens the buckets of its terms, skips the row groups of others, and never reads a text.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybrook.functions.text import query_terms, terms
from tallybrook.sources import manifests
from tallybrook.sources.tables import BUCKET, bucket_of

TERM = "term"


def build_index(
    df: DataFrame, text: str, sort_by: list[str], path: str, keep: list[str] | None = None, buckets: int | None = None
) -> None:
    """Index ``df`` under ``path``, a folder that must hold no index yet.

    ``sort_by`` orders results and has to name a row; ``keep`` are further columns that
    results show. A row has one posting per distinct term. A bucket is written by as many tasks as its
    size asks for, so a term that most rows hold does not go to one. The index counts
    once all of it is written.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = list(dict.fromkeys([*sort_by, *(keep or [])]))
    postings = df.select(*columns, F.explode(F.array_distinct(terms(F.col(text)))).alias(TERM))
    (
        postings.withColumn(BUCKET, bucket_of([TERM], n))
        .hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, TERM, *sort_by)
        .write.partitionBy(BUCKET)
        .parquet(f"{path}/data")
    )
    schema = postings.schema.json()
    manifests.put(spark, f"{path}/_index.json", {"buckets": n, "sort_by": sort_by, "schema": schema})


def search_index(spark: SparkSession, path: str, query: str, size: int | None = 10) -> DataFrame:
    """Rows that hold any term of ``query``, lowest in the order of the index first.

    A result page has ``size`` rows; ``None`` gives all matches. The first ``size`` rows of all
    are among the first ``size`` of each term, so that many are taken of each.
    """
    index = manifests.newest(spark, f"{path}/_index.json")
    if index is None:
        raise ValueError(f"no index in {path}")
    schema = StructType.fromJson(json.loads(index["schema"]))
    words = sorted(query_terms(spark, query))
    asked = spark.createDataFrame([(w,) for w in words], f"{TERM} STRING")
    held = {r[0] for r in asked.select(bucket_of([TERM], index["buckets"])).collect()}
    paths = [f"{path}/data/{BUCKET}={b}" for b in sorted(held)]
    paths = [p for p in paths if manifests.exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema).drop(TERM)
    rows = spark.read.schema(schema).parquet(*paths)
    order = index["sort_by"]
    if size is None:
        return rows.where(F.col(TERM).isin(words)).drop(TERM).distinct().orderBy(*order)
    firsts = [rows.where(F.col(TERM) == w).drop(TERM).orderBy(*order).limit(size) for w in words]
    return reduce(DataFrame.unionByName, firsts).distinct().orderBy(*order).limit(size)
