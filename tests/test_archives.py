"""Zipped CSV archives: whole or not at all, in bounded memory."""

import io
import os
import tracemalloc
import zipfile

import pyarrow as pa
import pytest

from nearcast.sources import zipcsv as Z
from nearcast.sources.csvtext import column_plan


def archive(path, member="a.csv", body="x,y\n1,2\n", compression=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", compression) as z:
        z.writestr(member, body)
    return path


def body(rows):
    return "id,word\n" + "".join(f"{i},w{i * 2654435761 % 1000003}\n" for i in range(rows))


def flip(path, share):
    """Invert two bytes at a place of the compressed member."""
    with open(path, "r+b") as f:
        at = int(os.path.getsize(path) * share)
        f.seek(at)
        two = f.read(2)
        f.seek(at)
        f.write(bytes(255 - b for b in two))


@pytest.mark.parametrize("share", [0.2, 0.5, 0.9])
@pytest.mark.parametrize("compression", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_flipped_bytes_give_no_row_and_one_error(spark, tmp_dir, share, compression):
    archive(f"{tmp_dir}/good.zip", body=body(1000))
    archive(f"{tmp_dir}/bad.zip", body=body(100_000), compression=compression)
    flip(f"{tmp_dir}/bad.zip", share)
    rows = Z.read_zipped_csv(spark, f"{tmp_dir}/*.zip")
    assert {(r["__file"], r["n"]) for r in rows.groupBy("__file").count().withColumnRenamed("count", "n").collect()} == {("good.zip", 1000)}
    report = {r.path.rsplit("/", 1)[-1]: r for r in Z.archive_report(spark, tmp_dir).collect()}
    assert report["good.zip"].n_rows == 1000 and report["good.zip"].error is None
    assert report["bad.zip"].error and report["bad.zip"].n_rows is None
    assert [r.path.rsplit("/", 1)[-1] for r in Z.zip_errors(spark, tmp_dir).collect()] == ["bad.zip"]


def test_every_kind_of_damage_is_reported(spark, tmp_dir):
    whole = archive(f"{tmp_dir}/whole.zip", body=body(5000))
    with open(whole, "rb") as f:
        data = f.read()
    for name, content in {"cut.zip": data[:len(data) // 2], "empty.zip": b"", "text.zip": b"not a zip", "tail.zip": data[200:]}.items():
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(content)
    archive(f"{tmp_dir}/none.zip", member="readme.txt")
    archive(f"{tmp_dir}/quote.zip", body='id,word\n1,"' + "x" * (Z.CELL_CHARS + 10))  # an open quote
    errors = {r.path.rsplit("/", 1)[-1]: r.error for r in Z.zip_errors(spark, tmp_dir).collect()}
    assert set(errors) == {"cut.zip", "empty.zip", "text.zip", "tail.zip", "none.zip", "quote.zip"} and all(errors.values())
    assert Z.read_zipped_csv(spark, f"{tmp_dir}/*.zip", header=["id", "word"]).count() == 5000


def test_one_partition_per_archive_and_none_without(spark, tmp_dir):
    for i in range(5):
        archive(f"{tmp_dir}/m{i}.ZIP" if i % 2 else f"{tmp_dir}/m{i}.zip", body=body(10 + i))
    rows = Z.read_zipped_csv(spark, tmp_dir, header=["id", "word"])
    assert rows.rdd.getNumPartitions() == 5 and rows.count() == 60
    assert Z.read_zipped_csv(spark, f"{tmp_dir}/nothing*.zip", header=["id"]).count() == 0
    with pytest.raises(FileNotFoundError):
        Z.read_zipped_csv(spark, f"{tmp_dir}/nothing*.zip")


def test_memory_does_not_grow_with_the_member(tmp_dir):
    peaks = []
    for rows in (60_000, 600_000):
        path = archive(f"{tmp_dir}/r{rows}.zip", body=body(rows))
        tracemalloc.start()
        assert Z.check_archive(Z._Seekable(pa.OSFile(path)))["n_rows"] == rows
        assert sum(len(b["id"]) for b in Z.archive_blocks(Z._Seekable(pa.OSFile(path)), ["id", "word"])) == rows
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0]


def test_cells_lines_and_blank_records(spark, tmp_dir):
    text = 'id,note,,id\n1," a ""b"",\nc ",x,9\n\n , ,\n2\n3,ü,y,8,extra\n'
    archive(f"{tmp_dir}/a.zip", body=text)
    got = [tuple(r)[:3] for r in Z.read_zipped_csv(spark, tmp_dir).collect()]
    assert got == [("1", 'a "b",\nc', "9"), ("2", "", ""), ("3", "ü", "8")]


def test_written_archives_come_back(spark, tmp_dir):
    rows = [(m, i, None if i % 7 == 0 else f'w"{i},\n') for m in ("2024-01", "2024-02") for i in range(500)] + [(None, 1, "x")]
    df = spark.createDataFrame(rows, "month string, id long, word string")
    done = {tuple(r) for r in Z.write_zipped_csv(df, f"{tmp_dir}/out", "month").collect()}
    assert done == {("2024-01", 500), ("2024-02", 500)} and sorted(os.listdir(f"{tmp_dir}/out")) == ["2024-01.zip", "2024-02.zip"]
    back = {(r["__file"][:-4], int(r.id), r.word) for r in Z.read_zipped_csv(spark, f"{tmp_dir}/out").collect()}
    assert back == {(m, i, (w or "").strip()) for m, i, w in rows if m}


def test_names_never_replace_each_other():
    assert column_plan(["a", "a", "a_1"]) == {"a": 0, "a_1": 1, "a_1_1": 2}
    assert column_plan(["a_1", "a", " a ", None, ""]) == {"a_1": 0, "a": 1, "a_2": 2}
    assert list(column_plan(["a"] * 4)) == ["a", "a_1", "a_2", "a_3"]


def test_offsets_before_the_file_are_damage():
    file = Z._Seekable(pa.BufferReader(b"abc"))
    assert file.seek(-1, 2) == 2 and file.read(5) == b"c" and isinstance(file, io.RawIOBase)
    with pytest.raises(zipfile.BadZipFile):
        file.seek(-9, 2)
