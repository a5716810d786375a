"""Start streaming jobs: ``python -m tallybrook JOB [JOB ...] --tables ... ``."""

from __future__ import annotations

import argparse

from tallybrook.session import builder
from tallybrook.sources.topics import TopicStore
from tallybrook.streaming.jobs import JOBS, compact_tables
from tallybrook.streaming.warehouse import Warehouse


def main() -> None:
    p = argparse.ArgumentParser(prog="tallybrook", description="Start streaming jobs.")
    p.add_argument("jobs", nargs="+", choices=[*sorted(JOBS), "compact"])
    p.add_argument("--tables", required=True, help="folder of dimension and result tables")
    p.add_argument("--checkpoints", required=True, help="folder of query checkpoints")
    p.add_argument("--topic-folder", help="folder of file topics")
    p.add_argument("--kafka", help="bootstrap servers, instead of --topic-folder")
    p.add_argument("--starting", default="latest", help="latest, earliest or offsets as JSON")
    p.add_argument("--every", default="5 seconds", help="time between batches")
    p.add_argument("--once", action="store_true", help="read what is there, then stop")
    p.add_argument("--max-per-trigger", type=int, help="offsets or files per batch")
    a = p.parse_args()
    if bool(a.kafka) == bool(a.topic_folder):
        p.error("give either --kafka or --topic-folder")
    topics = (
        TopicStore("kafka", options={"kafka.bootstrap.servers": a.kafka})
        if a.kafka
        else TopicStore("files", a.topic_folder)
    )
    w = Warehouse(
        topics=topics,
        tables=a.tables,
        checkpoints=a.checkpoints,
        trigger={"availableNow": True} if a.once else {"processingTime": a.every},
        starting=a.starting,
        max_per_trigger=a.max_per_trigger,
    )
    spark = builder("tallybrook").getOrCreate()
    if "compact" in a.jobs:
        for table, parts in compact_tables(spark, w).items():
            print(f"{table}: {len(parts)} parts rewritten")
    started = [JOBS[name](spark, w) for name in a.jobs if name != "compact"]
    if not started:
        return
    if a.once:
        for query in started:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
