"""Data-quality checks (Q1-Q16).

Contract, as in the reference: a check returns the violating rows; it
passes iff there are none. :func:`run_suite` turns a dict of named checks
into one report ``DataFrame(name, violations, passed)``.

Each check is one scan with an aggregate or a filter; the many ``not_null``
checks over one table are one pass (``count_if`` per column), not one scan
per column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One-pass null counts for many columns (Q1): rows (column, nulls)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, nulls)")


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null (Q1)."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Key values occurring more than once, with their count (Q2, Q4)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is outside the list; nulls pass (Q3)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(values))


def rates_valid(agg: DataFrame, n: str = "flight_count", d: str = "delayed_count",
                rate: str = "delay_rate_15") -> DataFrame:
    """n > 0, 0 <= d <= n, 0 <= rate <= 1 (Q5)."""
    return agg.filter(rate_violation(n, d, rate))


def rate_violation(n: str = "flight_count", d: str = "delayed_count", rate: str = "delay_rate_15") -> Column:
    """The condition of :func:`rates_valid`."""
    return ((F.col(n) <= 0) | (F.col(d) < 0) | (F.col(d) > F.col(n))
            | (F.col(rate) < 0) | (F.col(rate) > 1))


def implies(df: DataFrame, premise: Column, conclusion: Column) -> DataFrame:
    """Rows where premise holds and conclusion does not (Q8-Q10, Q12)."""
    return df.filter(premise & ~F.coalesce(conclusion, F.lit(False)))


def max_null_share(df: DataFrame, col: str, max_share: float) -> DataFrame:
    """One row when the null share of ``col`` exceeds ``max_share``."""
    a = df.agg(F.count(F.lit(1)).alias("total_rows"),
               F.count_if(F.col(col).isNull()).alias("null_rows"))
    return a.filter(F.col("null_rows") > F.lit(max_share) * F.col("total_rows"))


def min_share_by(df: DataFrame, keys: list[str], ok: Column, min_share: float,
                 exclude: Column | None = None) -> DataFrame:
    """Groups whose share of ``ok`` rows is below ``min_share`` (Q13, Q14)."""
    src = df if exclude is None else df.filter(~exclude)
    g = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_rows"),
                               F.count_if(ok).alias("ok_rows"))
    return g.filter(F.col("ok_rows") < F.lit(min_share) * F.col("total_rows"))


def count_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row when the two row counts differ."""
    a = left.agg(F.count(F.lit(1)).alias("left_count"))
    b = right.agg(F.count(F.lit(1)).alias("right_count"))
    return a.crossJoin(b).filter(F.col("left_count") != F.col("right_count"))


def readiness(extent: DataFrame, thresholds: list[tuple[str, int, int]]) -> DataFrame:
    """Raw-coverage gate (Q15): one row per stage with GO/NO_GO.

    ``extent`` is the one-row output of a coverage-extent aggregate with
    ``months`` and ``unit_months``; thresholds are (stage, min months,
    min unit-months). Empty input is NO_GO everywhere.
    """
    spark = extent.sparkSession
    th = spark.createDataFrame(thresholds, "stage string, min_months int, min_unit_months int")
    j = F.broadcast(th).crossJoin(extent)
    ok = ((F.col("row_count") > 0) & (F.col("months") >= F.col("min_months"))
          & (F.col("unit_months") >= F.col("min_unit_months")))
    return j.select("stage", "min_months", "min_unit_months", "months", "unit_months",
                    F.when(ok, "GO").otherwise("NO_GO").alias("decision"))


def row_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Many row-level checks on one table in one pass: (name, violations) rows.

    Each condition marks a violating row (null counts as not violating).
    """
    agg = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in checks)
    return agg.selectExpr(f"stack({len(checks)}, {stack}) as (name, violations)")


def table_checks(df: DataFrame, keys: list, rows: dict[str, Column] | None = None,
                 measures: list[Column] | None = None, groups: dict[str, Column] | None = None,
                 totals: dict[str, Column] | None = None, parity: dict[str, Column] | None = None) -> DataFrame:
    """All checks on one table from one scan and one grouping: (name, violations, is_parity) rows.

    The table is grouped by ``keys`` (its key, or the key of a grouped check)
    with ``n_rows``, the given ``measures`` and a count per row check, and the
    groups are summed up once.

    * ``rows``: conditions that mark a violating row (null: not violating)
    * ``groups``: conditions over keys, ``n_rows`` and measures that mark a violating group
    * ``totals``: aggregates over the groups that are true when the table fails
    * ``parity``: signed counts over the groups; :func:`run_checks` adds those of
      the same name from several tables, and the check fails unless they cancel out

    An empty table has no violations and counts of 0.
    """
    rows, groups, totals, parity = rows or {}, groups or {}, totals or {}, parity or {}
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), *(measures or []),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"rows {n}") for n, c in rows.items()])
    found = {n: F.sum(f"rows {n}") for n in rows}
    found |= {n: F.count_if(F.coalesce(c, F.lit(False))) for n, c in groups.items()}
    found |= {n: F.coalesce(c, F.lit(False)).cast("long") for n, c in totals.items()}
    found |= parity
    one = grouped.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in found.items()])
    stack = ", ".join(f"'{n}', `{n}`, {str(n in parity).lower()}" for n in found)
    return one.selectExpr(f"stack({len(found)}, {stack}) as (name, violations, is_parity)")


def run_checks(parts: list[DataFrame]) -> DataFrame:
    """Results of :func:`table_checks` and of plain checks (name, violations) -> (name, violations, passed) (Q16)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    # one row per check and table
    out = out.groupBy("name").agg(F.sum("violations").alias("v"), F.coalesce(F.bool_or("is_parity"), F.lit(False)).alias("p"))
    return out.select("name", F.when(F.col("p"), (F.col("v") != 0).cast("long")).otherwise(F.col("v")).alias("violations")) \
        .withColumn("passed", F.col("violations") == 0)


def violations(name: str, bad: DataFrame) -> DataFrame:
    """A check that returns violating rows -> one (name, violations) row."""
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("name"), "violations")


def run_suite(checks: dict[str, Callable[[], DataFrame]],
              grouped: list[DataFrame] | None = None) -> DataFrame:
    """Named checks -> (name, violations, passed), one aggregate per check, one union (Q16).

    ``grouped`` adds ready (name, violations) frames, e.g. from :func:`row_checks`.
    """
    parts = list(grouped or [])
    for name, fn in checks.items():
        parts.append(fn().agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit(name).alias("name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("violations") == 0)


def scoped_match_share(df: DataFrame, scope: DataFrame, on: list[str], ok: Column, min_share: float = 0.9) -> DataFrame:
    """Scope units (station-months) whose share of ``ok`` rows is below ``min_share``, or that have no row (Q14)."""
    counted = df.groupBy(*on).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(ok).alias("ok_rows"))
    return (scope.select(*on).distinct().join(counted, on, "left").na.fill(0, ["total_rows", "ok_rows"])
            .filter((F.col("total_rows") == 0) | (F.col("ok_rows") < F.lit(min_share) * F.col("total_rows"))))


def full_readiness(tables: dict[str, DataFrame], min_months: dict[str, int], min_units: dict[str, int],
                   unit_col: dict[str, str], ym_col: str = "year_month") -> DataFrame:
    """Go / no-go over several raw tables (Q15): one row per table and one verdict row.

    A table passes with rows, enough months and enough distinct unit-months. A
    first or last month that differs between tables is a warning, not a fault.
    """
    parts = []
    for name, df in tables.items():
        unit = F.col(unit_col[name])
        pairs = df.groupBy(unit.alias("unit"), F.col(ym_col).alias("ym")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(pairs.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count_distinct("ym").alias("months"),
            F.count(F.lit(1)).alias("unit_months"), F.min("ym").alias("first_month"), F.max("ym").alias("last_month"))
            .select(F.lit(name).alias("table_name"), "*", F.lit(min_months[name]).alias("min_months"),
                    F.lit(min_units[name]).alias("min_unit_months")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    ok = (F.col("row_count") > 0) & (F.col("months") >= F.col("min_months")) & (F.col("unit_months") >= F.col("min_unit_months"))
    rows = rows.withColumn("decision", F.when(ok, "GO").otherwise("NO_GO"))
    verdict = rows.agg(F.when(F.bool_and(F.col("decision") == "GO"), "GO").otherwise("NO_GO").alias("decision"),
                       F.when((F.count_distinct("first_month") > 1) | (F.count_distinct("last_month") > 1),
                              "first or last months differ between tables").alias("warning"))
    return rows.withColumn("warning", F.lit(None).cast("string")).unionByName(
        verdict.withColumn("table_name", F.lit("ALL")), allowMissingColumns=True)
