"""Result sinks that take a batch twice and keep it once."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.sources import manifests


def write_result(
    rows: DataFrame, path: str, query_id: str, batch_id: int, commit: str | None = None
) -> None:
    """Write one batch of results under its query and batch, replacing an earlier try.

    Rows go to a fresh folder, which a manifest then names in one step: readers see the earlier
    try or this one, whole. With ``commit`` that step is the commit of the whole batch.
    """
    own = quote(query_id, safe="")
    name = f"data/query_id={own}/batch_id={batch_id}/try={uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{name}")
    manifest = {"name": name, "commit": commit}
    log = f"{path}/_log/{own}/{batch_id:020d}.json"
    manifests.put(rows.sparkSession, log, manifest, replace=True)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result rows of all queries and batches, with ``query_id`` and ``batch_id``."""
    found = [manifests.read(spark, s) for s in manifests.listed(spark, f"{path}/_log/*/*.json")]
    live = [f"{path}/{m['name']}" for m in found if manifests.counts(spark, m)]
    if not live:
        raise ValueError(f"no results in {path}")
    rows = spark.read.option("basePath", f"{path}/data").parquet(*live).drop("try")
    return rows.withColumn("query_id", F.col("query_id").cast("string"))


def swap_statements(table: str, staging: str, columns: list[str]) -> list[str]:
    """SQL that moves one staged batch into a result table; run as one transaction."""
    names = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE query_id = ? AND batch_id = ?",
        f"INSERT INTO {table} ({names}, query_id, batch_id) "
        f"SELECT {names}, query_id, batch_id FROM {staging}",
    ]


def write_result_jdbc(
    rows: DataFrame,
    query_id: str,
    batch_id: int,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    connect=None,
) -> None:
    """Write one batch of results to a database, all or nothing.

    Executors fill a staging table; one transaction then replaces the batch in the
    result table by it. Rows never pass through the driver. The result table has
    the columns of ``rows`` plus ``query_id`` and ``batch_id``; each query has a
    staging table of its own, ``<table>_staging_<query_id>``.
    """
    spark = rows.sparkSession
    staging = f"{table}_staging_{query_id}"
    stamped = rows.withColumns(
        {"query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    stamped.write.mode("overwrite").jdbc(url, staging, properties=properties or {})
    connection = (connect or _connect)(spark, url, properties or {})
    try:
        connection.setAutoCommit(False)
        delete, insert = swap_statements(table, staging, rows.columns)
        statement = connection.prepareStatement(delete)
        statement.setString(1, query_id)
        statement.setLong(2, batch_id)
        statement.executeUpdate()
        connection.prepareStatement(insert).executeUpdate()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _connect(spark: SparkSession, url: str, properties: dict[str, str]):
    props = spark._jvm.java.util.Properties()
    for key, value in properties.items():
        props.setProperty(key, value)
    return spark._jvm.java.sql.DriverManager.getConnection(url, props)
