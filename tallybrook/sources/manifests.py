"""Small files that say which data files count, and commits that cover several of them.

Data goes to folders that nobody reads yet. A manifest that names them appears in one step,
or replaces an older one in one step, and readers follow manifests only: they see all that a
batch wrote or nothing, whenever its writer is lost.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Messages are JSON text that says the same names again and again.
COMPRESSION = "zstd"

# Manifests read before, by path: they are looked at again once their time or size changes.
_READ: dict[str, tuple[tuple[int, int], dict]] = {}
_MOST_REMEMBERED = 100_000


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.exists(at)


def listed(spark: SparkSession, pattern: str) -> list:
    """The status of every file or folder that fits ``pattern``, in the order of their paths."""
    at, files = _at(spark, pattern)
    found = files.globStatus(at)
    return sorted(found or [], key=lambda f: f.getPath().toString())


def put(spark: SparkSession, path: str, value: dict, replace: bool = False) -> bool:
    """Make the manifest ``path`` appear with ``value``; False if there is one already.

    It is written under another name and moved, so nobody sees a part of it. With
    ``replace`` it takes the place of an older one.
    """
    at, files = _at(spark, path)
    files.mkdirs(at.getParent())
    # Hadoop hides names that begin with a dot.
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(value).encode()))
    stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE if replace else rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(at), how)
    except Exception:
        files.delete(draft, False)
        if replace or not files.exists(at):
            raise
        return False
    return True


def read(spark: SparkSession, status) -> dict:
    """The manifest of a ``listed`` status."""
    path = status.getPath().toString()
    stamp = (status.getModificationTime(), status.getLen())
    if path in _READ and _READ[path][0] == stamp:
        return _READ[path][1]
    _, files = _at(spark, path)
    stream = files.open(status.getPath())
    try:
        value = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    if len(_READ) >= _MOST_REMEMBERED:
        _READ.clear()
    _READ[path] = (stamp, value)
    return value


def newest(spark: SparkSession, pattern: str) -> dict | None:
    """The last manifest that fits ``pattern``, by name."""
    found = listed(spark, pattern)
    return read(spark, found[-1]) if found else None


@dataclass
class Commit:
    """All that one batch writes, made visible by one file.

    Tables and results written with ``commit=self.path`` count once that file is there.
    Messages are staged beside their topics and moved in when it is; whoever tries the batch
    again finds the file, moves in what its first attempt did not get to, and is done.
    """

    spark: SparkSession
    path: str
    staged: dict[str, str] = field(default_factory=dict)

    @property
    def done(self) -> bool:
        return exists(self.spark, self.path)

    def stage(self, rows: DataFrame, partition_by: list[str], target: str, name: str) -> None:
        """Write ``rows`` by the folders of ``partition_by``; each becomes ``name`` in ``target``'s.

        The value of ``partition_by[0]`` names the folder below ``target``.
        """
        draft = f"{target}/_staged/{uuid.uuid4().hex}"
        rows.write.option("compression", COMPRESSION).partitionBy(*partition_by).parquet(draft)
        for status in listed(self.spark, f"{draft}/{partition_by[0]}=*"):
            folder = status.getPath().getName()
            self.staged[status.getPath().toString()] = f"{target}/{folder}/{name}"

    def finish(self) -> None:
        """Make everything visible."""
        put(self.spark, self.path, {"staged": self.staged})
        self.publish()

    def publish(self) -> None:
        """Move in the messages of a finished commit that are still staged."""
        (status,) = listed(self.spark, self.path)
        for source, target in read(self.spark, status)["staged"].items():
            at, files = _at(self.spark, source)
            to, _ = _at(self.spark, target)
            if files.exists(at) and not files.exists(to):
                files.mkdirs(to.getParent())
                if not files.rename(at, to) and not files.exists(to):
                    raise OSError(f"cannot move {source} to {target}")


def counts(spark: SparkSession, manifest: dict) -> bool:
    """Whether what a manifest names counts: it belongs to no commit, or to a finished one."""
    commit = manifest.get("commit")
    if commit is None or manifest.get("finished"):
        return True
    if exists(spark, commit):
        manifest["finished"] = True  # remembered with the manifest: commits stay
        return True
    return False

