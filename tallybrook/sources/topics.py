"""Topics of keyed text messages, in Kafka or as a log of parquet files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tallybrook.sources.manifests import COMPRESSION, Commit

_LOG_SCHEMA = "key STRING, value STRING, timestamp TIMESTAMP, offset BIGINT"


@dataclass(frozen=True)
class TopicStore:
    """Where topics live.

    ``backend='kafka'`` needs the Kafka connector on the class path and takes
    ``options`` such as ``kafka.bootstrap.servers``. ``backend='files'`` keeps a
    folder per topic under ``location``, with the same columns and the same
    at-least-once delivery.
    """

    backend: str = "files"
    location: str = ""
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.backend not in ("kafka", "files"):
            raise ValueError(f"unknown topic backend {self.backend!r}")

    def path(self, topic: str) -> str:
        return f"{self.location.rstrip('/')}/topic={topic}"


def kafka_read_options(
    store: TopicStore, topic: str, starting: str, max_per_trigger: int | None
) -> dict[str, str]:
    opts = {**store.options, "subscribe": topic, "startingOffsets": starting}
    if max_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return opts


def read_topic(
    spark: SparkSession,
    store: TopicStore,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """One topic as a stream of ``topic, key, value, partition, offset, timestamp``.

    ``starting`` is ``latest``, ``earliest`` or offsets as JSON and only counts for a
    query's first start; later starts resume from its checkpoint. A file log has the
    offsets that its sender gave and is read from its beginning, ``max_per_trigger`` files
    at a time.
    """
    if store.backend == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .options(**kafka_read_options(store, topic, starting, max_per_trigger))
            .load()
        )
        return raw.select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "partition",
            "offset",
            "timestamp",
        )
    reader = spark.readStream.schema(_LOG_SCHEMA).option("recursiveFileLookup", "true")
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    _make_folder(spark, store.path(topic))
    return reader.parquet(store.path(topic)).select(
        F.lit(topic).alias("topic"),
        "key",
        "value",
        F.lit(None).cast("int").alias("partition"),
        "offset",
        "timestamp",
    )


def _make_folder(spark: SparkSession, path: str) -> None:
    """A file stream needs its folder to be there before the first message."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def read_topic_log(spark: SparkSession, store: TopicStore, topic: str | None = None) -> DataFrame:
    """All messages so far, of one topic or of every topic, as a batch."""
    if store.backend == "kafka":
        what = {"subscribePattern": ".*"} if topic is None else {"subscribe": topic}
        raw = spark.read.format("kafka").options(**store.options, **what).load()
        return raw.select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "timestamp",
        )
    cols = ["topic", "key", "value", "timestamp"]
    if topic is None:
        schema = _LOG_SCHEMA + ", writer STRING, batch_id BIGINT, topic STRING"
        return spark.read.schema(schema).parquet(store.location).select(*cols)
    reader = spark.read.schema(_LOG_SCHEMA).option("recursiveFileLookup", "true")
    return reader.parquet(store.path(topic)).withColumn("topic", F.lit(topic)).select(*cols)


def send(
    rows: DataFrame, store: TopicStore, writer: str, batch_id: int, commit: Commit | None = None
) -> None:
    """Write ``topic, key, value`` rows, each to the topic it names.

    Rows without a key are spread by the sink. In a file log the files of one
    ``writer`` and ``batch_id`` replace those of an earlier attempt at that batch. Messages
    of a key are ordered by ``timestamp`` and ``offset``: those of the rows if they have them,
    as messages passed on do, else the time of sending and the place among the rows.

    With ``commit`` the messages of a file log appear when that is finished; Kafka has them at
    once, and again if the batch is tried again.
    """
    if store.backend == "kafka":
        rows.select("topic", "key", "value").write.format("kafka").options(
            **store.options
        ).save()
        return
    if commit is not None:
        plain = rows.select("topic", "key", "value", *_position(rows))
        commit.stage(plain, ["topic"], store.location, f"writer={writer}/batch_id={batch_id}")
        return
    stamped = rows.select(
        "topic",
        "key",
        "value",
        *_position(rows),
        F.lit(writer).alias("writer"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )
    (
        stamped.write.mode("overwrite")
        .option("compression", COMPRESSION)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("topic", "writer", "batch_id")
        .parquet(store.location)
    )


def _position(rows: DataFrame) -> list[Column]:
    now, place = F.current_timestamp(), F.monotonically_increasing_id()
    at = F.coalesce("timestamp", now) if "timestamp" in rows.columns else now
    offset = F.coalesce("offset", place) if "offset" in rows.columns else place
    return [at.alias("timestamp"), offset.alias("offset")]


def send_stream(
    rows: DataFrame,
    store: TopicStore,
    writer: str,
    number: Callable[[int], int] = lambda batch_id: batch_id,
) -> DataStreamWriter:
    """The stream form of ``send``; name, checkpoint and trigger are the caller's.

    ``number`` makes the batch numbers of a file log from those of the stream.
    """
    if store.backend == "kafka":
        return rows.select("topic", "key", "value").writeStream.format("kafka").options(
            **store.options
        )
    return rows.writeStream.foreachBatch(
        lambda batch, batch_id: send(batch, store, writer, number(batch_id))
    )


def to_console(df: DataFrame, rows: int = 1000) -> DataStreamWriter:
    """Show each batch on the driver's console."""
    return df.writeStream.format("console").option("numRows", rows)
