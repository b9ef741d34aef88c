"""All-text CSV landing scans.

Raw files are read as text only: every column ``string``, every cell
stripped, blank rows and ``#`` comment lines skipped, short rows padded with
'' and extra cells dropped, bad UTF-8 bytes replaced. Quoted cells may hold
separators, doubled quotes and line breaks; a file is therefore not split
(landing files are one station-month each). Columns are taken by the names in
each file's own header: one pass finds the headers, and files with equal
headers share one column plan.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_plan(header: list[str | None]) -> dict[str, int]:
    """Column name -> position of one header (S3): cells without a name are left out,
    the n-th repetition of a name gets the suffix ``_n`` (or the next number that is free)."""
    plan: dict[str, int] = {}
    met: dict[str, int] = {}
    for at, name in enumerate((c or "").strip() for c in header):
        if not name:
            continue
        n = met.get(name, 0)
        unique = f"{name}_{n}" if n else name
        while unique in plan:
            n += 1
            unique = f"{name}_{n}"
        met[name] = n + 1
        plan[unique] = at
    return plan


def sanitize_headers(headers: list[str | None]) -> list[str | None]:
    """The plan's names by position, ``None`` where a column is left out."""
    by_place = {at: name for name, at in column_plan(headers).items()}
    return [by_place.get(at) for at in range(len(headers))]


def csv_options(reader: DataFrameReader, comment: str | None = "#") -> DataFrameReader:
    """The one set of CSV options of batch and streaming reads."""
    reader = (reader.option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
              .option("encoding", "UTF-8").option("quote", '"').option("escape", '"').option("multiLine", True)
              .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True))
    return reader.option("comment", comment) if comment else reader


def positional_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"_p{i}", T.StringType()) for i in range(width)])


def cell(at: int) -> Column:
    return F.coalesce(F.trim(F.col(f"_p{at}")), F.lit(""))


def not_blank(names: list[str]) -> Column:
    """Some cell of the row holds text."""
    return F.concat(*[F.col(f"`{n}`") for n in names]) != ""


def _split_header(line: str, sep: str = ",") -> list[str]:
    return next(csv.reader([line], delimiter=sep))


def first_file(spark: SparkSession, path: str) -> str:
    """First file (by path) matching ``path`` - a listing job, content not read."""
    row = (spark.read.format("binaryFile").load(path).select("path")
           .orderBy("path").first())
    if row is None:
        raise FileNotFoundError(path)
    return row["path"]


def headers(spark: SparkSession, path: str, comment: str | None = "#") -> DataFrame:
    """file, header line of every file matching ``path``: its first non-blank, non-comment line."""
    keep = F.trim(F.col("value")) != ""
    if comment:
        keep = keep & ~F.col("value").startswith(comment)
    lines = spark.read.text(path).filter(keep).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    # rows of one split are numbered in order; the first split of a file holds its header
    return lines.groupBy("file").agg(F.min_by("value", F.struct("block", "at")).alias("line"))


def header_of(spark: SparkSession, file_path: str, comment: str | None = "#") -> list[str]:
    """Header cells of one text file."""
    row = headers(spark, file_path, comment).first()
    if row is None:
        raise ValueError(f"no header line in {file_path}")
    return _split_header(row["line"])


def read_text_csv(spark: SparkSession, path: str, comment: str | None = "#",
                  required: list[str] | None = None, header: list[str] | None = None) -> DataFrame:
    """All-string DataFrame of every CSV file matching ``path``.

    Columns are the union of the files' names in order of first appearance; a
    file without a column has '' there. ``required`` columns must be in every
    file's header, else ``ValueError`` names a file that lacks one (checked
    before any row is read). ``header`` replaces the headers of all files.
    """
    if header is not None:
        found = None
        lines = [None]
        plans = [column_plan(header)]
    else:
        found = headers(spark, path, comment)
        # different header lines, not files: a few spellings of one layout
        lines = [r["line"] for r in found.groupBy("line").agg(F.min("file").alias("file")).sort("file").collect()]
        if not lines:
            raise ValueError(f"no header line in {path}")
        plans = [column_plan(_split_header(x)) for x in lines]
    for line, plan in zip(lines, plans):
        missing = [c for c in required or [] if c not in plan]
        if missing:
            where = path if line is None else found.filter(F.col("line") == line).first()["file"]
            raise ValueError(f"missing required columns {missing} in {where}")
    names = list(dict.fromkeys(n for plan in plans for n in plan))
    width = max((at for plan in plans for at in plan.values()), default=0) + 1
    df = csv_options(spark.read.schema(positional_schema(width)), comment).csv(path).select(
        "*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.file_path").alias("__path"))
    if len(plans) == 1:
        cols = [cell(plans[0][n]).alias(n) for n in names]
    else:
        kind = F.coalesce(*[F.when(F.col("line") == line, F.lit(k)) for k, line in enumerate(lines)])
        df = df.join(found.select(F.col("file").alias("__path"), kind.alias("__kind")), "__path")
        cols = [F.coalesce(*[F.when(F.col("__kind") == k, cell(plan[n])) for k, plan in enumerate(plans) if n in plan],
                           F.lit("")).alias(n) for n in names]
    return df.select(*cols, "__file").filter(not_blank(names))


def allow_list(df: DataFrame, col: str, allowed: DataFrame, allowed_col: str) -> DataFrame:
    """Keep rows whose ``upper(trim(col))`` is in the allowed codes; value not rewritten.

    ``allowed`` is a reference list (45 codes in the reference); the semi join
    broadcasts it only behind a size check.
    """
    from nearcast.operators.dims import bounded_broadcast
    codes = allowed.select(F.upper(F.trim(F.col(allowed_col))).alias("__code")).distinct()
    return df.join(bounded_broadcast(codes), F.upper(F.trim(F.col(col))) == F.col("__code"), "left_semi")


def stamp_lineage(df: DataFrame, run_id: str, loaded_at=None, file_col: str = "__file",
                  ym_pattern: str = r"(\d{4})[_-](\d{2})") -> DataFrame:
    """run_id, source_file, loaded_at, year_month on every row.

    ``year_month`` comes from the file name (``..._YYYY_MM...``).
    """
    ts = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    ym = F.concat_ws("-", F.regexp_extract(F.col(file_col), ym_pattern, 1),
                     F.regexp_extract(F.col(file_col), ym_pattern, 2))
    return (df.withColumn("run_id", F.lit(run_id)).withColumn("source_file", F.col(file_col))
            .withColumn("loaded_at", ts).withColumn("year_month", ym).drop(file_col))


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Reference CSV (seed) as text columns."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)
