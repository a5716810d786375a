import hashlib

import pytest
from pyspark.sql import functions as F

from tallybrook.llm import archive, queries
from tests.conftest import DATA

SCHEMA = "page_id LONG, url STRING, html STRING, row STRING, payload STRING, first STRING"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def brute(rows):
    """Type and reference of each row, and the payload's size and digest."""
    best = {}
    for i, _, html in rows:
        key = (html or "").encode()
        if len(key) >= archive.SHARED_BYTES and i is not None:
            best[key] = max(best.get(key, i), i)
    out = []
    for i, _, html in rows:
        key = (html or "").encode()
        first = best.get(key, i)
        kind, to = ("response", None) if first == i else ("revisit", str(first))
        out.append((str(i), len(key), hashlib.sha1(key).hexdigest(), kind, to))
    return sorted(out)


def index(spark, path):
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((str(r[0]), *r[1:]) for r in archive.read_index(spark, path).select(*cols).collect())


def test_archive_against_brute_force(spark, tmp_path):
    long, edge, short = "é" * 700, "a" * 1000, "b" * 999
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate([long, edge, short, None, "", long, short, edge, "x\r\n\r\ny" * 300])]
    rows += [(i, None, long) for i in range(20, 400)]
    path = str(tmp_path / "a")
    archive.write_archive(pages(spark, rows), path)
    assert index(spark, path) == brute(rows)
    assert spark.read.parquet(f"{path}/payloads").count() == 5
    got = {r.page_id: r for r in archive.read_records(spark, path).collect()}
    for i, url, html in rows:
        r, body = got[str(i)], (html or "").encode()
        head, http, rest = bytes(r.record).split(b"\r\n\r\n", 2)
        lines = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert bytes(r.payload) == body
        assert lines.get(b"WARC-Target-URI") == (None if url is None else url.encode())
        own = b"" if r.record_type == "revisit" else body
        assert rest == own + b"\r\n\r\n"
        assert int(lines[b"Content-Length"]) == len(http) + 4 + len(own)


def test_repeated_rows_and_null_ids(spark, tmp_path):
    body = "c" * 1500
    path = str(tmp_path / "a")
    archive.write_archive(pages(spark, [(7, "u", body)] * 3 + [(None, "u\r\nx: y", body)] * 2), path)
    got = archive.read_index(spark, path).collect()
    assert sorted((r.page_id or "", r.record_type, r.refers_to) for r in got) == [
        ("", "revisit", "7"), ("", "revisit", "7"),
        ("7", "response", None), ("7", "revisit", "7"), ("7", "revisit", "7"),
    ]
    assert {r.url for r in got} == {"u", "u  x: y"}


def test_empty_archive(spark, tmp_path):
    path = str(tmp_path / "a")
    archive.write_archive(pages(spark, [(1, "u", "x")]).where("false"), path)
    assert archive.read_index(spark, path).count() == 0
    assert archive.read_records(spark, path).count() == 0


def test_damage_is_seen(spark, tmp_path):
    path = str(tmp_path / "a")
    archive.write_archive(pages(spark, [(1, "u", "x"), (2, "u", "y")]), path)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.encode(F.lit("z"), "UTF-8"))
    bad.write.parquet(f"{path}-bad/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}-bad/headers")
    with pytest.raises(Exception, match="damaged payload"):
        archive.read_records(spark, f"{path}-bad").collect()
    bad.where("false").write.mode("overwrite").parquet(f"{path}-bad/payloads")
    with pytest.raises(Exception, match="no payload"):
        archive.read_index(spark, f"{path}-bad").collect()


def test_query_takes_every_page(spark):
    given = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    got = queries.op12_archive(spark, DATA).collect()
    want = brute([(r.page_id, r.url, r.html) for r in given])
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type,
                   None if r.refers_to is None else str(r.refers_to)) for r in got) == want
