import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from nearcast.llm import warc


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


ROWS = [(1, "http://a/1", "<p>ä</p>"), (2, "http://a/2", "<p>ä</p>"), (3, None, None), (4, "http://a/4\r\nX: y", ""),
        (None, "http://a/5", "<p>\r\n\r\nWARC/1.1\r\n</p>"), (6, "http://b/6", "x" * 300_000), (6, "http://b/6", "x" * 300_000)]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "a")
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    warc.write_warc(df, path, records_per_file=2)
    return path


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_round_trip(spark, archive, scheme):
    got = {(r.record_id, r.record_type, r.payload_digest, r.refers_to, None if r.payload is None else bytes(r.payload).decode())
           for r in warc.read_warc(spark, scheme + archive, partition_bytes=1000).collect()}
    same = digest(ROWS[0][2])
    assert got == {
        (1, "revisit", same, 2, None), (2, "response", same, None, "<p>ä</p>"),
        (3, "revisit", digest(""), 4, None), (4, "response", digest(""), None, ""),
        (None, "response", digest(ROWS[4][2]), None, ROWS[4][2]), (6, "response", digest(ROWS[5][2]), None, ROWS[5][2])}


def test_predicates_are_pushed_and_blocks_skipped(spark, archive):
    df = warc.read_warc(spark, archive, payload=False).where("record_type = 'revisit' and target_uri like 'http://a/%'")
    assert [(r.record_id, r.payload_length, r.payload) for r in df.collect()] == [(1, 9, None)]
    reader = warc.WarcReader({"path": archive, "payload": "true"})
    from pyspark.sql.datasource import EqualTo, GreaterThan
    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("record_id",), 1)]))
    assert rest == [GreaterThan(("record_id",), 1)]
    assert {r[0] for p in reader.partitions() for b in reader.read(p) for r in zip(*b.to_pydict().values())} == {"revisit"}


def test_min_revisit_bytes_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc.write_warc(df, str(tmp_path / "m"), min_revisit_bytes=3)
    assert {r.record_id: r.record_type for r in warc.read_warc(spark, str(tmp_path / "m")).collect()} == {
        1: "response", 2: "response", 3: "revisit", 4: "response"}
    warc.write_warc(df.limit(0), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0
