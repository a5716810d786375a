"""Session settings and the folder jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Everything here has the same meaning on one machine and on a cluster; sizes
# (executors, memory, shuffle partitions) belong to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Write state changes instead of whole snapshots on every batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of a state takes one more lookup for each row written; only metrics tell it.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

# Settings that only count when the session is made.
STATIC_SETTINGS = {
    # Recording the Python line of every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Partitions of a query with state for each core, unless set.
STATES_PER_CORE = 3


def builder(app_name: str = "tallybrook") -> SparkSession.Builder:
    """A session builder with the toolkit's settings applied."""
    b = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **STATIC_SETTINGS}.items():
        b = b.config(key, value)
    return b


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session with the streaming settings, leaving ``spark`` as it is."""
    child = spark.newSession()
    for key, value in SETTINGS.items():
        child.conf.set(key, value)
    wanted = spark.conf.get("spark.sql.shuffle.partitions")
    child.conf.set("spark.sql.shuffle.partitions", wanted)
    return child


@contextmanager
def few_states(spark: SparkSession) -> Iterator[None]:
    """A query with state that is started inside has ``STATES_PER_CORE`` partitions a core at most.

    Every batch opens and commits the state stores of each partition, five of them where two
    streams are joined and repeats dropped, however few rows they hold. The checkpoint fixes their
    number for the life of a query: set ``spark.tallybrook.state.partitions`` to that of the
    cluster that the stream will grow to. Fewer shuffle partitions than that are left as they are.
    """
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    own = spark.conf.get("spark.tallybrook.state.partitions", None)
    most = STATES_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", own or str(min(int(usual), most)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where it is unset, a temporary folder serves if all tasks run in the driver's process;
    on a cluster other machines would not see its files, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tallybrook-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, never used before, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # Only a folder that is there can be marked for deletion.
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{path}/data"


@contextmanager
def settled(spark: SparkSession, batch: DataFrame, name: str) -> Iterator[DataFrame]:
    """A stream's batch, computed once: written to the shared folder and read back with ``spark``.

    Where a batch that comes out of a stateful step meets itself in a join, Spark doesn't find
    its persisted rows again but runs the step anew, state included. ``spark`` should have
    adaptive execution, which a stream's own session lacks. The folder is deleted after the use.
    """
    path = work_path(spark, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        batch.write.parquet(path)
        yield spark.read.schema(batch.schema).parquet(path)
    finally:
        files.delete(folder, True)
        files.cancelDeleteOnExit(folder)
