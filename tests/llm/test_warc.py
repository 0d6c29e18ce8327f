import base64
import hashlib

import pytest

from sievemark.llm import warc
from sievemark.llm.storage import Workspace

ROWS = [(5, "http://a", "same"), (2, "http://b\r\nX: y", "same"), (9, None, None), (7, "http://c", ""), (1, "http://d", "é" * 2000), (4, "http://e", "same"), (None, "http://f", "same")]


def test_index_is_that_of_the_payloads(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumnRenamed("url", "url")
    got = {r.key: r for r in warc.round_trip(df).collect()}
    for key, _, body in ROWS:
        raw = (body or "").encode()
        assert got[key].payload_bytes == len(raw)
        assert got[key].payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {2: ("response", None), 5: ("revisit", 2), 4: ("revisit", 2), None: ("revisit", 2), 7: ("response", None), 9: ("revisit", 7), 1: ("response", None)}


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    got = {r.key: r.record_type for r in warc.round_trip(df, least=5).collect()}
    assert set(got.values()) == {"response"}


def test_records_come_back_byte_for_byte(spark):
    work = Workspace(spark, "test")
    path = work.fresh("archive")
    warc.write_archive(spark.createDataFrame(ROWS, "page_id long, url string, html string"), path)
    bodies = {k: (b or "").encode() for k, _, b in ROWS}
    index = {r.key: r for r in warc.read_index(spark, path).collect()}
    for r in warc.read_records(spark, path).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        block = bodies[r.key] if fields["WARC-Type"] == "response" else b""
        assert head.startswith(b"WARC/1.1\r\n") and rest == block + b"\r\n\r\n" and int(fields["Content-Length"]) == len(block)
        assert fields["WARC-Payload-Digest"] == "sha1:" + index[r.key].payload_digest and "X" not in fields
    assert spark.read.parquet(f"{path}/payloads").count() == 3


def test_a_changed_payload_fails(spark):
    work = Workspace(spark, "test")
    path = work.fresh("archive")
    warc.write_archive(spark.createDataFrame(ROWS[:1], "page_id long, url string, html string"), path)
    p = spark.read.parquet(f"{path}/payloads")
    from pyspark.sql import functions as F

    other = p.select("sha256", F.lit(b"other").alias("payload")).toPandas()
    spark.createDataFrame(other, "sha256 string, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="payload does not match"):
        warc.read_index(spark, path).collect()


def test_an_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string, key string")).collect() == []
