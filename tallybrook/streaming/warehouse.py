"""Where a warehouse's streams read and write, and how its queries run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tallybrook.operators.keyed import latest_by_key
from tallybrook.operators.records import parse_json
from tallybrook.sources.manifests import Commit
from tallybrook.sources.results import write_result
from tallybrook.sources.tables import read_for_keys, read_latest
from tallybrook.sources.topics import TopicStore, read_topic

# rows, query id, batch id
ResultSink = Callable[[DataFrame, str, int], None]


@dataclass(frozen=True)
class Warehouse:
    """``tables`` and ``checkpoints`` are folders every executor can reach.

    ``trigger`` is given to ``DataStreamWriter.trigger``. ``results`` replaces the
    result tables under ``tables`` as the sink of the marts, for one in a database.
    """

    topics: TopicStore
    tables: str
    checkpoints: str
    trigger: dict = field(default_factory=lambda: {"processingTime": "5 seconds"})
    starting: str = "latest"
    max_per_trigger: int | None = None
    results: ResultSink | None = None

    def numbers(self, spark: SparkSession, name: str) -> Callable[[int], int]:
        """Batch numbers for what the job ``name`` writes, from those of its stream.

        A stream counts its batches from 0 in every new checkpoint. What it writes must
        neither replace nor lose to what it wrote under an earlier one, so each checkpoint
        gets a number that is higher than all before it, kept in its folder, and the batch
        numbers of different checkpoints are far apart.
        """
        checkpoint = f"{self.checkpoints.rstrip('/')}/{name}"
        first = run_number(spark, f"{checkpoint}/_run", self.table(f"_runs/{name}")) << 40
        return lambda batch_id: first + batch_id

    def table(self, name: str) -> str:
        return f"{self.tables.rstrip('/')}/{name}"

    def messages(self, spark: SparkSession, topic: str) -> DataFrame:
        return read_topic(spark, self.topics, topic, self.starting, self.max_per_trigger)

    def records(
        self, spark: SparkSession, topic: str, schema: str, keep: list[str] | None = None
    ) -> DataFrame:
        return parse_json(self.messages(spark, topic), schema, keep=keep)

    def dimension(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        """All of a small dimension, as of now."""
        return read_latest(spark, self.table(name), schema, ["id"])

    def dimension_for(
        self, facts: DataFrame, fact_key: str, name: str, schema: str
    ) -> DataFrame:
        """The rows of a large dimension that a batch of facts refers to, from their buckets."""
        return read_for_keys(self.table(name), schema, "id", facts, fact_key)

    def commit(self, spark: SparkSession, name: str, number: int) -> Commit:
        """What makes all that the job ``name`` writes in a batch visible together."""
        return Commit(spark, f"{self.table('_commits')}/{name}/{number:020d}.json")

    def save_result(
        self, rows: DataFrame, name: str, query_id: str, batch_id: int, commit: str | None = None
    ) -> None:
        if self.results is not None:
            self.results(rows, query_id, batch_id)
        else:
            write_result(rows, self.table(name), query_id, batch_id, commit)

    def start(self, writer: DataStreamWriter, name: str) -> StreamingQuery:
        return (
            writer.queryName(name)
            .option("checkpointLocation", f"{self.checkpoints.rstrip('/')}/{name}")
            .trigger(**self.trigger)
            .start()
        )


def run_number(spark: SparkSession, marker: str, taken: str) -> int:
    """The number in the file ``marker``; else the next free one of the folder ``taken``.

    Numbers are taken by making a file of that name, which only one can do.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(marker).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(at(marker)):
        stream = files.open(at(marker))
        try:
            return stream.readInt()
        finally:
            stream.close()
    files.mkdirs(at(taken))
    used = [int(f.getPath().getName()) for f in files.listStatus(at(taken))]
    number = max(used, default=-1) + 1
    while not files.createNewFile(at(f"{taken}/{number}")):
        number += 1
    stream = files.create(at(marker), False)
    stream.writeInt(number)
    stream.close()
    return number


def newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last arrived row per key of one batch, arrival columns removed."""
    return latest_by_key(rows, keys, ["timestamp", "offset"]).drop("timestamp", "offset")
