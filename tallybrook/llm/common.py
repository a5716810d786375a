"""What the text operators share: words, tables between steps, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.session import work_path

# Words are runs of anything but ASCII white space; bytes.split() cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows of an Arrow batch handled at once, so that what a task builds for them stays small.
SLICE = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut of its lineage.

    What is read back does not depend on the executors that computed it. The folder
    is deleted when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's values with null as empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def unused(df: DataFrame, name: str) -> str:
    """``name`` with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def per_worker(make: Callable, *args):
    """``make(*args)``, made once per Python worker and kept for its later tasks.

    Functions sent by value have new globals in every task, so the values are kept on a
    module that the worker has anyway.
    """
    import pyspark

    kept = pyspark.__dict__.setdefault("_kept_by_tasks", {})
    key = (make.__module__, make.__qualname__, args)
    if key not in kept:
        kept[key] = make(*args)
    return kept[key]
