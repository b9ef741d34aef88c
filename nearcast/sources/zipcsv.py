"""Zipped CSV archives (S1) as a Python data source.

Every archive is one partition. Its first CSV member is read twice by the same
task, as a stream both times: first to its end, which decompresses every byte,
compares the member's checksum and parses every record, and only if that
succeeds once more for the rows. A damaged archive so gives no row at all, and
a task holds one block of records however long the member is; nothing is kept
on a local disk. What is wrong with an archive is the ``error`` of its row in
``archive_report``; errors of the store itself are not swallowed, they fail the
task, which Spark tries again.

Columns are taken by the names in each archive's own header. Archives are
opened by the pyarrow file system of their path (local and shared folders, and
what pyarrow reaches by URI); a path is a file, a folder or a pattern of file
names in one folder.
"""

from __future__ import annotations

import csv
import io
import zipfile
import zlib
from collections.abc import Iterator
from fnmatch import fnmatch
from itertools import islice, zip_longest

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from nearcast.sources.csvtext import column_plan

#: Records of a block, and characters of the longest cell (an open quote would else swallow the file).
BLOCK_ROWS, CELL_CHARS = 20_000, 16 << 20
DAMAGE = (zipfile.BadZipFile, zlib.error, csv.Error, EOFError, ValueError, NotImplementedError, RuntimeError)
REPORT = "path string, member string, header array<string>, n_rows long, n_bytes long, error string"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _archives(path: str) -> list[str]:
    """Files named by a file, folder or pattern, sorted."""
    store, root = _store(path)
    folder, _, name = root.rpartition("/")
    if any(c in name for c in "*?["):
        found = store.get_file_info(fs.FileSelector(folder or ".", allow_not_found=True))
        return sorted(f.path for f in found if f.is_file and fnmatch(f.base_name, name))
    info = store.get_file_info(root)
    if info.is_file:
        return [root]
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and f.base_name.lower().endswith(".zip"))


class _Seekable(io.RawIOBase):
    """A stored file for ``zipfile``: offsets before its start come from a damaged directory."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.length = file, file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        to = offset + (0, self.file.tell(), self.length)[whence]
        if to < 0:
            raise zipfile.BadZipFile("offset before the start of the file")
        return self.file.seek(min(to, self.length))

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


def _records(archive: zipfile.ZipFile, member: zipfile.ZipInfo) -> Iterator[list[str]]:
    """Records of a member, header first; a wrong checksum ends them with an error."""
    csv.field_size_limit(CELL_CHARS)
    with archive.open(member) as raw:
        yield from csv.reader(io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline=""))


def _member(archive: zipfile.ZipFile) -> zipfile.ZipInfo:
    found = next((m for m in archive.infolist() if m.filename.lower().endswith(".csv")), None)
    if found is None:
        raise ValueError("no CSV member in archive")
    return found


def _filled(record: list[str]) -> bool:
    return any(c.strip() for c in record)


def check_archive(file: io.RawIOBase) -> dict:
    """What one whole reading of an archive finds: member, header, n_rows, n_bytes, error (null if it is sound)."""
    found: dict = {"member": None, "header": None, "n_rows": None, "n_bytes": None, "error": None}
    try:
        with zipfile.ZipFile(io.BufferedReader(file, 1 << 20)) as archive:
            member = _member(archive)
            records = _records(archive, member)
            header = next(records, [])
            rows = sum(map(_filled, records))
            found |= {"member": member.filename, "header": header, "n_rows": rows, "n_bytes": member.file_size}
    except DAMAGE as e:
        found["error"] = f"{type(e).__name__}: {e}"
    return found


def archive_blocks(file: io.RawIOBase, names: list[str], size: int = BLOCK_ROWS) -> Iterator[dict[str, list[str]]]:
    """Blocks of columns by name, each at most ``size`` records; blank records are left out."""
    with zipfile.ZipFile(io.BufferedReader(file, 1 << 20)) as archive:
        records = _records(archive, _member(archive))
        plan = column_plan(next(records, []))
        while block := list(islice(records, size)):
            block = [r for r in block if _filled(r)]
            sides = list(zip_longest(*block, fillvalue=""))
            empty = [""] * len(block)
            if block:
                yield {n: [c.strip() for c in sides[plan[n]]] if plan.get(n, len(sides)) < len(sides) else empty for n in names}


class Archive(InputPartition):
    def __init__(self, file: str):
        self.file = file


class ZippedCsvSource(DataSource):
    """``spark.read.format("zipped_csv")``; option ``give``: rows (with the columns of the given schema), report or header."""

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def schema(self) -> str:
        return REPORT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZippedCsvReader(self.options, schema.names)


class ZippedCsvReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.path, self.give, self.names = options["path"], options.get("give", "report"), names

    def partitions(self) -> list[InputPartition]:
        return [Archive(f) for f in _archives(self.path)] or [Archive("")]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        store, _ = _store(self.path)

        def opened() -> _Seekable:
            return _Seekable(store.open_input_file(partition.file))
        if self.give == "header":
            yield self._report(partition.file, header_of(opened()))
            return
        found = check_archive(opened())
        if self.give == "report":
            yield self._report(partition.file, found)
        elif found["error"] is None:
            name = partition.file.rsplit("/", 1)[-1]
            columns = [n for n in self.names if n != "__file"]
            for block in archive_blocks(opened(), columns):
                rows = len(next(iter(block.values()), []))
                block["__file"] = [name] * rows
                yield pa.RecordBatch.from_arrays([pa.array(block[n], pa.string()) for n in self.names], names=self.names)

    @staticmethod
    def _report(path: str, found: dict) -> pa.RecordBatch:
        kinds = {"header": pa.list_(pa.string()), "n_rows": pa.int64(), "n_bytes": pa.int64()}
        return pa.RecordBatch.from_pydict({c: pa.array([v], kinds.get(c, pa.string())) for c, v in ({"path": path} | found).items()})


def header_of(file: io.RawIOBase) -> dict:
    """As ``check_archive``, but only the header record is read."""
    found: dict = {"member": None, "header": None, "n_rows": None, "n_bytes": None, "error": None}
    try:
        with zipfile.ZipFile(io.BufferedReader(file, 1 << 16)) as archive:
            member = _member(archive)
            found |= {"member": member.filename, "header": next(_records(archive, member), []), "n_bytes": member.file_size}
    except DAMAGE as e:
        found["error"] = f"{type(e).__name__}: {e}"
    return found


def _source(spark: SparkSession, give: str):
    spark.dataSource.register(ZippedCsvSource)
    return spark.read.format("zipped_csv").option("give", give)


def archive_report(spark: SparkSession, path: str) -> DataFrame:
    """path, member, header, n_rows, n_bytes, error of every archive, each read to its end."""
    return _source(spark, "report").load(path)


def zip_headers(spark: SparkSession, path: str) -> DataFrame:
    """path, header, error of every archive; only the header records are read."""
    return _source(spark, "header").load(path).select("path", "header", "error")


def zip_errors(spark: SparkSession, path: str) -> DataFrame:
    """path, error of the archives of which ``read_zipped_csv`` returns no row."""
    return archive_report(spark, path).filter("error is not null").select("path", "error")


def read_zipped_csv(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """All-string rows of the first CSV member of every sound archive of ``path``, and ``__file``.

    Columns are the union of the archives' names (or those of ``header``); an
    archive without a column has '' there.
    """
    if header is None:
        # different headers, not archives: a few spellings of one layout
        kinds = zip_headers(spark, path).filter("error is null").groupBy("header").agg(F.min("path").alias("path")).sort("path").collect()
        if not kinds:
            raise FileNotFoundError(path)
        names = list(dict.fromkeys(n for k in kinds for n in column_plan(k["header"])))
    else:
        names = list(column_plan(header))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "__file"]])
    return _source(spark, "rows").schema(schema).load(path)


def write_zipped_csv(df: DataFrame, path: str, by: str) -> DataFrame:
    """Write the rows of every value of ``by`` as archive ``<value>.zip`` under ``path``; returns value, n_rows, written.

    A value's rows are one archive and one task, as in the sources; the rows
    pass the task in batches. An archive has its name only when it is complete,
    and a retried task writes the same file anew.
    """
    names = [c for c in df.columns if c != by]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        store.create_dir(root)
        done: list[tuple[str, int]] = []
        now: list = []

        def close() -> None:
            value, archive, text, out, rows = now
            text.close()
            archive.close()
            out.close()
            store.move(f"{root}/.{value}.partial", f"{root}/{value}.zip")
            done.append((value, rows))
            now.clear()
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            for i, value in enumerate(batch.column(by).to_pylist()):
                if now and now[0] != value:
                    close()
                if not now:
                    out = store.open_output_stream(f"{root}/.{value}.partial")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    text = io.TextIOWrapper(archive.open(f"{value}.csv", "w", force_zip64=True), encoding="utf-8", newline="")
                    csv.writer(text).writerow(names)
                    now.extend([value, archive, text, out, 0])
                csv.writer(now[2]).writerow([c[i] for c in columns])
                now[4] += 1
        if now:
            close()
        yield pa.RecordBatch.from_pydict({"value": pa.array([v for v, _ in done], pa.string()), "n_rows": pa.array([n for _, n in done], pa.int64())})
    text = df.where(F.col(by).isNotNull()).select(F.col(by).cast("string"), *[F.col(n).cast("string") for n in names])
    return text.repartition(by).sortWithinPartitions(by).mapInArrow(write, "value string, n_rows long")
