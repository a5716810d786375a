"""Reading relations from tables or databases, with lower-case column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_query(spark: SparkSession, sql: str) -> DataFrame:
    """Rows of a query over registered tables and views."""
    return _lower(spark.sql(sql))


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    split_by: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
    **more: str,
) -> dict[str, str]:
    """Options of a JDBC read.

    With ``split_by`` and ``bounds`` executors read ranges of that column side by
    side; without them a single task reads everything, which suits small
    dimensions only.
    """
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    if (split_by is None) != (bounds is None):
        raise ValueError("split_by and bounds go together")
    opts = {"url": url, "fetchsize": str(fetch_size), **more}
    if split_by is None:
        opts["dbtable" if table else "query"] = table or query
        return opts
    opts["dbtable"] = table or f"({query}) q"
    opts["partitionColumn"] = split_by
    opts["lowerBound"], opts["upperBound"] = (str(b) for b in bounds)
    opts["numPartitions"] = str(partitions)
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """A database table or query; literal filters on it are pushed to the database."""
    return _lower(spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load())
