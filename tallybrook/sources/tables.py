"""Upsert tables: versions are appended by batch, readers take the latest of each key.

Rows lie in parts: buckets by a hash of the key, or the folders of ``partition_by`` columns such
as days. A batch goes to a fresh folder, and its manifest says which parts it holds and which keys
each part spans. Readers that want certain keys open the parts that may hold them. Compaction
writes the latest rows of single parts anew and then, in one step, a snapshot that names the live
folders of every part: who reads meanwhile sees the old files or the new ones. A batch that is
tried again replaces its own manifest, so repeats leave no trace.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructType

from tallybrook.operators.keyed import latest_by_key
from tallybrook.operators.lookup import rows_for_keys
from tallybrook.sources import manifests

BATCH = "batch_id"
BUCKET = "bucket"
DELETED = "_deleted"
AT = "_at"
_MARKS = f"{DELETED} BOOLEAN, {AT} BIGINT"


@dataclass
class Folder:
    """What one write left: its parts with the rows and the range of keys of each."""

    name: str
    batch: int
    parts: dict[str, list]
    whole: bool = True


@dataclass
class State:
    """The live folders of a table, in the order of their batches."""

    buckets: int | None = None
    through: int = -1
    folders: list[Folder] = field(default_factory=list)
    snapshot: int = 0


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a key; ids have the same one whatever their width."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _log(path: str) -> str:
    return f"{path}/_log"


def state(spark: SparkSession, path: str) -> State:
    """What the newest snapshot says, and the batches since."""
    made = manifests.newest(spark, f"{_log(path)}/table.json")
    out = State(buckets=made and made["buckets"])
    snapshot = manifests.newest(spark, f"{_log(path)}/snapshot-*.json")
    if snapshot:
        out.through, out.snapshot = snapshot["through"], snapshot["number"]
        out.folders = [Folder(**f) for f in snapshot["folders"]]
    for status in manifests.listed(spark, f"{_log(path)}/batch-*.json"):
        if int(status.getPath().getName()[len("batch-") : -len(".json")]) > out.through:
            found = manifests.read(spark, status)
            if manifests.counts(spark, found):
                out.folders.append(Folder(found["name"], found["batch"], found["parts"]))
    return out


def _ranged(keys: list[str] | None, schema: StructType) -> str | None:
    """The key whose range manifests keep: one that JSON holds exactly and that sorts as in Spark."""
    if not keys or keys[0] not in schema.fieldNames():
        return None
    kind = schema[keys[0]].dataType
    return keys[0] if isinstance(kind, IntegralType | StringType) else None


def _parts(spark: SparkSession, folder: str, depth: int, ranged: str | None) -> dict[str, list]:
    """The parts that a write left, each with ``[rows, lowest key, highest key]`` if known."""
    base = f"{folder}{'/*=*' * depth}"
    names = [
        "/".join(s.getPath().toString().rsplit("/", depth)[1:])
        for s in manifests.listed(spark, base)
    ]
    if ranged is None or depth != 1:
        return {n: [] for n in names}
    if not names:
        return {}
    rows = spark.read.parquet(folder).groupBy(BUCKET).agg(
        F.count("*").alias("n"), F.min(ranged).alias("low"), F.max(ranged).alias("high")
    )  # one row per bucket
    return {f"{BUCKET}={r[BUCKET]}": [r["n"], r["low"], r["high"]] for r in rows.collect()}


def _write(rows: DataFrame, path: str, name: str, by: list[str], keys: list[str] | None) -> dict[str, list]:
    """Write one folder and return its parts.

    Rows of a part go to as many tasks as their size asks for, sorted by key inside a file, so
    that row groups can be skipped.
    """
    spark = rows.sparkSession
    if by == [BUCKET] and keys:
        rows = rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *keys)
    rows.write.partitionBy(*by).parquet(f"{path}/{name}")
    ranged = _ranged(keys, rows.schema) if by == [BUCKET] else None
    return _parts(spark, f"{path}/{name}", len(by), ranged)


def _folder(batch_id: int) -> str:
    return f"data/{BATCH}={batch_id}/try={uuid.uuid4().hex}"


def _buckets(spark: SparkSession, path: str, keys: list[str] | None, buckets: int | None) -> int:
    """How many buckets the table has: as many as it was made with."""
    found = manifests.newest(spark, f"{_log(path)}/table.json")
    if found is None:
        own = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        manifests.put(spark, f"{_log(path)}/table.json", {"buckets": own if keys else 1, "keys": keys})
        found = manifests.newest(spark, f"{_log(path)}/table.json")
    if found["keys"] != keys:
        raise ValueError(f"{path} has the keys {found['keys']}, not {keys}")
    return found["buckets"]


def upsert(
    rows: DataFrame,
    path: str,
    batch_id: int,
    partition_by: list[str] | None = None,
    columns: list[str] | None = None,
    keys: list[str] | None = None,
    buckets: int | None = None,
    commit: str | None = None,
) -> None:
    """Write one batch of row versions.

    ``columns`` renames the row's columns by position to the table's. Tables partitioned by day
    are read by day without touching other days; others lie in ``buckets`` by a hash of ``keys``,
    as many as the first write says (else as there are shuffle partitions), or in one without
    keys. With ``commit`` the batch counts once that file is there (``manifests.Commit``).
    """
    spark = rows.sparkSession
    named = rows if columns is None else rows.toDF(*columns)
    if batch_id <= state(spark, path).through:
        return  # compaction has taken it in
    by = partition_by or [BUCKET]
    if not partition_by:
        n = _buckets(spark, path, keys, buckets)
        number = bucket_of(keys, n) if keys else F.lit(0)
        named = named.withColumn(BUCKET, number)
    name = _folder(batch_id)
    parts = _write(named, path, name, by, keys)
    manifest = {"name": name, "batch": batch_id, "parts": parts, "commit": commit}
    manifests.put(spark, f"{_log(path)}/batch-{batch_id:020d}.json", manifest, replace=True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has any batch."""
    return bool(state(spark, path).folders)


def _read(spark: SparkSession, path: str, schema: str, folders: list[Folder]) -> DataFrame:
    """All versions in ``folders``; those that are whole are named by one path."""
    full = f"{schema}, {BATCH} BIGINT"
    paths = []
    for f in folders:
        own = [f.name] if f.whole else [f"{f.name}/{p}" for p in f.parts]
        paths += [f"{path}/{p}" for p in own if f.parts]
    fields = StructType.fromDDL(full).fields
    if not paths:
        # Known to be empty before it runs, so that joins with it are left out of plans.
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        return spark.range(1).select(*none).where(F.lit(False))
    wanted = [f.name for f in fields]
    reader = spark.read.schema(full).option("basePath", f"{path}/data")
    return reader.parquet(*paths).select(*wanted)


def read_batch(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """The rows that a batch wrote last, also before its commit is finished."""
    (status,) = manifests.listed(spark, f"{_log(path)}/batch-{batch_id:020d}.json")
    found = manifests.read(spark, status)
    return _read(spark, path, schema, [Folder(found["name"], found["batch"], found["parts"])]).drop(BATCH)


def _before(found: State, before_batch: int | None) -> list[Folder]:
    if before_batch is None:
        return found.folders
    if before_batch <= found.through:
        raise ValueError(f"batch {before_batch} is compacted: what stood before it is gone")
    return [f for f in found.folders if f.batch < before_batch]


def read_versions(
    spark: SparkSession, path: str, schema: str, before_batch: int | None = None
) -> DataFrame:
    """All versions with their ``batch_id``, deletions too; none if the table is not there yet.

    ``before_batch`` leaves out that batch and later ones, so that a batch tried
    again does not see what its first attempt wrote.
    """
    return _read(spark, path, schema, _before(state(spark, path), before_batch))


def read_latest(
    spark: SparkSession,
    path: str,
    schema: str,
    keys: list[str],
    order_by: list[str] | None = None,
    before_batch: int | None = None,
) -> DataFrame:
    """The latest version of every key: highest ``_at``, batch, then highest ``order_by``.

    Keys whose latest version is a deletion are left out.
    """
    folders = _before(state(spark, path), before_batch)
    rows = _read(spark, path, f"{schema}, {_MARKS}", folders)
    return _alive(_latest(rows, keys, order_by))


def _latest(rows: DataFrame, keys: list[str], order_by: list[str] | None) -> DataFrame:
    return latest_by_key(rows, keys, [AT, BATCH, *(order_by or [])]).drop(BATCH)


def _alive(rows: DataFrame) -> DataFrame:
    return rows.where(~F.coalesce(F.col(DELETED), F.lit(False))).drop(DELETED, AT)


def _touched(folders: list[Folder], ranges: dict[str, tuple]) -> list[Folder]:
    """Folders with those parts only that may hold a key of ``ranges``, by part."""
    out = []
    for f in folders:
        parts = {}
        for name, facts in f.parts.items():
            if name not in ranges:
                continue
            low, high = ranges[name]
            if not facts or facts[1] is None or (facts[1] <= high and low <= facts[2]):
                parts[name] = facts
        if parts:
            out.append(Folder(f.name, f.batch, parts, whole=f.whole and len(parts) == len(f.parts)))
    return out


def read_for_keys(
    path: str,
    schema: str,
    key: str,
    facts: DataFrame,
    fact_key: str,
    before_batch: int | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """The latest version of each ``key`` that a batch of facts names in ``fact_key``."""
    wanted = versions_for_keys(path, f"{schema}, {_MARKS}", key, facts, fact_key, before_batch)
    return _alive(_latest(wanted, [key], order_by))


def versions_for_keys(
    path: str,
    schema: str,
    key: str,
    facts: DataFrame,
    fact_key: str,
    before_batch: int | None = None,
) -> DataFrame:
    """All versions of each ``key`` that a batch of facts names in ``fact_key``.

    A table bucketed by ``key`` alone is read in the buckets of the batch's keys, and there in
    the folders whose range of keys meets the batch's. That takes one job over the batch, which
    gives one row per bucket; versions of other keys go before versions are compared.
    """
    spark = facts.sparkSession
    folders = _before(found := state(spark, path), before_batch)
    made = manifests.newest(spark, f"{_log(path)}/table.json")
    if folders and made is not None and made["keys"] == [key]:
        same = StructType.fromDDL(schema)[key].dataType
        values = facts.select(F.col(fact_key).cast(same).alias("_key")).where("_key IS NOT NULL")
        touched = values.groupBy(bucket_of(["_key"], found.buckets).alias("b")).agg(
            F.min("_key").alias("low"), F.max("_key").alias("high")
        )
        ranges = {f"{BUCKET}={r['b']}": (r["low"], r["high"]) for r in touched.collect()}
        folders = _touched(folders, ranges)
    return rows_for_keys(_read(spark, path, schema, folders), key, facts, fact_key)


def compact_parts(
    spark: SparkSession,
    path: str,
    schema: str,
    keys: list[str],
    order_by: list[str] | None = None,
    most: int = 8,
    keep: Column | None = None,
    within: list[str] | None = None,
) -> list[str]:
    """Rewrite every part that lies in more than ``most`` folders as its latest rows; their names.

    Jobs may go on reading and writing. Folders are left where they are for those who read them;
    ``remove_unused`` deletes them later. ``keep`` drops latest rows that no longer matter, such
    as state whose life is over. Where rows of a key stand beside each other, ``within`` tells them
    apart. Only one compaction of a table succeeds at a time. Batches taken
    in can no longer be replaced, which their writer, having gone on, won't want.
    """
    found = state(spark, path)
    held: dict[str, list[Folder]] = defaultdict(list)
    for f in found.folders:
        for p in f.parts:
            held[p].append(f)
    chosen = sorted(p for p, folders in held.items() if len(folders) > most)
    if not chosen:
        return []
    pieces = [Folder(f.name, f.batch, own, whole=False) for f in found.folders
              if (own := {p: f.parts[p] for p in chosen if p in f.parts})]
    through = max(f.batch for f in found.folders)
    by = [level.split("=")[0] for level in chosen[0].split("/")]
    latest = _latest(_read(spark, path, f"{schema}, {_MARKS}", pieces), [*keys, *(within or [])], order_by)
    # Older versions of a deleted key are gone too; only by time may one still come late.
    latest = latest.where(~F.coalesce(F.col(DELETED), F.lit(False)) | F.col(AT).isNotNull())
    latest = latest if keep is None else latest.where(keep)
    if by == [BUCKET]:
        n = found.buckets
        latest = latest.withColumn(BUCKET, bucket_of(keys, n) if n > 1 else F.lit(0))
    name = _folder(max(f.batch for f in pieces))
    parts = _write(latest, path, name, by, keys)
    left = [
        Folder(f.name, f.batch, own, whole=f.whole and len(own) == len(f.parts))
        for f in found.folders
        if (own := {p: x for p, x in f.parts.items() if p not in chosen})
    ]
    # The new folder stands before those of later batches, which it does not hold.
    folders = sorted([Folder(name, max(f.batch for f in pieces), parts), *left], key=lambda f: f.batch)
    number = found.snapshot + 1
    snapshot = {"number": number, "through": through, "folders": [vars(f) for f in folders]}
    if not manifests.put(spark, f"{_log(path)}/snapshot-{number:012d}.json", snapshot):
        raise RuntimeError(f"{path} was compacted by somebody else meanwhile")
    return chosen


def remove_unused(spark: SparkSession, path: str, older_than_ms: int) -> int:
    """Delete folders and manifests that no reader of the present state needs; how many folders.

    Spared is what is younger than ``older_than_ms``: choose it above the longest running query.
    """
    found = state(spark, path)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    live = {f.name.rsplit("try=", 1)[1] for f in found.folders}
    removed = 0
    for status in manifests.listed(spark, f"{path}/data/{BATCH}=*/try=*"):
        at = status.getPath()
        age = now - status.getModificationTime()
        batch = int(at.getParent().getName().split("=")[1])
        # Later batches may be in the making.
        if batch <= found.through and at.getName()[len("try=") :] not in live and age >= older_than_ms:
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            removed += 1
    for status in manifests.listed(spark, f"{_log(path)}/*.json"):
        name = status.getPath().getName()
        kind, _, number = name[: -len(".json")].partition("-")
        old = int(number or 0) <= found.through if kind == "batch" else int(number or 0) < found.snapshot
        if kind in ("batch", "snapshot") and old and now - status.getModificationTime() >= older_than_ms:
            status.getPath().getFileSystem(spark._jsc.hadoopConfiguration()).delete(status.getPath(), False)
    return removed


def compact(
    spark: SparkSession,
    path: str,
    new_path: str,
    schema: str,
    keys: list[str],
    order_by: list[str] | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Write the latest versions as the first batch of a new table, say one with other buckets.

    Run it while no job writes to ``path``; jobs then continue on ``new_path`` with
    batch numbers that are higher than 0.
    """
    latest = read_latest(spark, path, schema, keys, order_by)
    upsert(latest, new_path, 0, partition_by, keys=None if partition_by else keys)

