"""WARC archives: a Spark writer and a PySpark Python data source that reads them.

Writing is one Spark text job: a record is a string built by column
expressions, and the line separator closes it, so the commit protocol, retries
and any Hadoop file system work as for every other Spark output. Pages with
equal payloads are found by one count per digest; the copy with the largest id
keeps the payload (``response``), the others become ``revisit`` records.

Reading plans file partitions, takes record-type and header predicates from
Spark (``pushFilters``), parses each record's headers first and seeks past the
block of a record that the predicates reject or whose payload is not asked for.

Defined cases: a null payload is empty; a null url is ``urn:page:<id>``; a null
id has no id header and reads back as null; repeated rows are all written, and
those that carry the response's id are responses; an empty table gives an empty
archive; extra columns are ignored.
"""

from __future__ import annotations

import io
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
)

from nearcast.session import materialize

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Headers that the reader returns as columns.
COLUMNS = {
    "record_type": "WARC-Type", "record_id": "X-Page-Id", "target_uri": "WARC-Target-URI",
    "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length", "refers_to": "X-Refers-To-Id",
}
LONGS = ("record_id", "payload_length", "refers_to")
SCHEMA = ", ".join(f"{c} {'long' if c in LONGS else 'string'}" for c in COLUMNS) + ", payload binary"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: four groups of 40 bits, eight base-32 digits each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_revisit_bytes: int = 0,
               date: str = "1970-01-01T00:00:00Z", records_per_file: int = 20_000) -> None:
    """Write one record per row of ``pages`` below ``path``.

    The table of digests with several pages is written first, so that its size
    is known when the join to the pages is planned: small, it is broadcast by
    Spark's own limit and the payloads are not shuffled; large, both sides are
    shuffled by digest and AQE splits a digest with very many copies.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    copies = materialize(
        rows.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("digest").agg(F.max("id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null").select("digest", "first_id"))
    rows = rows.join(copies, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    size, F.lit(CRLF + CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    # a line break or other control character in a url would end the header
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"),
                     F.concat(F.lit("urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("unknown"))))

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", uri),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.coalesce(header("X-Page-Id", F.col("id").cast("string")), F.lit("")),
        header("X-Payload-Length", size),
        F.when(revisit, F.concat(header("WARC-Profile", F.lit(PROFILE)),
                                 header("X-Refers-To-Id", F.col("first_id").cast("string")))).otherwise(""),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length("block").cast("string")),
        F.lit(CRLF), F.col("block"))
    (rows.withColumn("block", block).select(record.alias("value")).write
     .option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", records_per_file).text(path))


def read_warc(spark: SparkSession, path: str, payload: bool = True,
              partition_bytes: int = 64 << 20) -> DataFrame:
    """The records below ``path``; ``payload=False`` skips every block unread."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return (spark.read.format("warc").option("payload", str(payload).lower())
            .option("partitionbytes", str(partition_bytes)).load(path))


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; options ``payload`` (true/false) and ``partitionbytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


class FileGroup(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true") == "true"
        self.partition_bytes = int(options.get("partitionbytes", 64 << 20))
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        """Take equality, IN, prefix and not-null tests of header columns; return the rest."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in COLUMNS and isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif column in COLUMNS and isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif column in COLUMNS and isinstance(f, StringStartsWith):
                self.tests.append((column, "prefix", (f.value,)))
            elif column in COLUMNS and isinstance(f, IsNotNull):
                self.tests.append((column, "set", ()))
            else:
                yield f

    def partitions(self):
        """Groups of files of about ``partition_bytes``; the writer bounds a file's records."""
        from pyarrow import fs
        store, root = _store(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        groups, room = [], 0
        for f in sorted((f for f in found if f.is_file and f.base_name[:1] not in "._" and f.size),
                        key=lambda f: f.path):
            if room < f.size:
                groups.append([])
                room = self.partition_bytes
            groups[-1].append(f.path)
            room -= f.size
        return [FileGroup(g) for g in groups] or [FileGroup([])]

    def read(self, partition):
        out: list[tuple] = []
        pending = 0
        for row in (r for p in partition.files for r in self._records(p)):
            out.append(row)
            pending += len(row[-1] or b"")
            if len(out) == 2_000 or pending > 16 << 20:
                yield _batch(out)
                out, pending = [], 0
        yield _batch(out)

    def _records(self, path: str):
        store, _ = _store(self.path)
        with store.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 20) as f:
            while headers := _headers(f):
                row = {c: headers.get(h.lower()) for c, h in COLUMNS.items()}
                row |= {c: None if row[c] is None else int(row[c]) for c in LONGS}
                if row["payload_digest"]:
                    row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
                left = int(headers["content-length"])
                keep = all(_passes(row[c], kind, values) for c, kind, values in self.tests)
                body = None
                if keep and self.payload and row["record_type"] == "response":
                    block = f.read(left)
                    left = 0
                    body = block[block.index(b"\r\n\r\n") + 4:]
                f.seek(left + 4, io.SEEK_CUR)
                if keep:
                    yield (*row.values(), body)


def _store(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (fs.LocalFileSystem(), path)


def _headers(f) -> dict[str, str]:
    """The next record's headers by lower-case name; empty at the end of the file."""
    version = f.readline()
    if not version:
        return {}
    if not version.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    out = {}
    while (line := f.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode("utf-8").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _passes(value, kind: str, values: tuple) -> bool:
    if value is None:
        return False
    return kind == "set" or (value in values if kind == "in" else value.startswith(values[0]))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * (len(COLUMNS) + 1)
    kinds = [pa.int64() if c in LONGS else pa.string() for c in COLUMNS] + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)],
                                      names=[*COLUMNS, "payload"])
