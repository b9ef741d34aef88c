"""Dimension joins, reference checks and scalar comparisons.

A broadcast is only hinted for a literal seed (:func:`bounded_broadcast`); any
other side is left to Spark's own size limit and to AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A literal seed this small (reference dimensions: 45 rows) is broadcast outright.
MAX_LITERAL_ROWS = 10_000


def bounded_broadcast(df: DataFrame, known_rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint only where a bound is proven by construction.

    ``known_rows`` is the length of a literal list the frame was made of. For
    any other input the choice is Spark's: its byte limit decides when the plan
    is made and again, by measured sizes, when it runs (AQE).
    """
    return F.broadcast(df) if known_rows is not None and known_rows <= MAX_LITERAL_ROWS else df


def lookup(df: DataFrame, dim: DataFrame, on, how: str = "inner",
           known_rows: int | None = None) -> DataFrame:
    """Join a dimension: inner drops unknown keys (J2, J4), left keeps them."""
    return df.join(bounded_broadcast(dim, known_rows), on, how)


def assemble(base: DataFrame, *dims: tuple[DataFrame, object, str]) -> DataFrame:
    """Chain of dimension lookups (J1): ``(dim, on, how)`` triples."""
    out = base
    for dim, on, how in dims:
        out = lookup(out, dim, on, how)
    return out


def missing_refs(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child keys with no parent row (J10, Q6): ``left_anti`` + distinct.

    The distinct runs first (partial aggregation shrinks the child side to
    its key set before the anti join's shuffle).
    """
    keys = child.select(F.col(child_key).alias("__key")).filter(F.col("__key").isNotNull()).distinct()
    parents = parent.select(F.col(parent_key).alias("__key"))
    return keys.join(parents, "__key", "left_anti").withColumnRenamed("__key", child_key)


def scalar_compare(left: DataFrame, right: DataFrame, left_name: str = "left_count",
                   right_name: str = "right_count", only_unequal: bool = True) -> DataFrame:
    """Two counts side by side; a row only when they differ.

    Both sides are one-row aggregates, so the cross join is 1 x 1.
    """
    a = left.agg(F.count(F.lit(1)).alias(left_name))
    b = right.agg(F.count(F.lit(1)).alias(right_name))
    out = a.crossJoin(b)
    return out.filter(F.col(left_name) != F.col(right_name)) if only_unequal else out


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row (J12); 1-row side is broadcast."""
    return df.crossJoin(F.broadcast(scalars))


def scope_join(df: DataFrame, scope: DataFrame, on: list[str]) -> DataFrame:
    """Restrict to an inline scope table."""
    return df.join(bounded_broadcast(scope), on, "inner")


def scope_table(spark, rows: list[tuple], cols: list[str]) -> DataFrame:
    """Inline ``VALUES`` scope table."""
    return spark.createDataFrame(rows, cols)


def when_all(*conds: Column) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out
