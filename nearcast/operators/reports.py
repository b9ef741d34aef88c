"""Ranked top-n reports, tagged unions and ordering helpers.

A global ``row_number() over (order by ...)`` is a single-partition window
over the whole input. Here the ranking is ``orderBy(...).limit(n)`` first
(TakeOrderedAndProject: each partition keeps its own top n, the driver merges
n x partitions rows), and ``row_number`` only numbers those n rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def desc_pg(c) -> Column:
    """Descending with nulls first - the reference database's DESC order (K4)."""
    return _col(c).desc_nulls_first()


def asc_pg(c) -> Column:
    """Ascending with nulls last - the reference database's ASC order (K4)."""
    return _col(c).asc_nulls_last()


def asc_nulls_first(c) -> Column:
    """Ascending with nulls first, as a report states it (L1)."""
    return _col(c).asc_nulls_first()


def by_labels(c, labels: list[str]) -> Column:
    """Ascending in a stated order of labels, others last (L3: ORDER BY CASE)."""
    place = F.coalesce(*[F.when(_col(c) == v, F.lit(i)) for i, v in enumerate(labels)], F.lit(len(labels)))
    return place.asc()


def top_n(df: DataFrame, order: list[Column], n: int = 10, where: Column | None = None,
          rank_col: str = "rank", label: str | None = None,
          label_col: str = "report") -> DataFrame:
    """Rows 1..n under ``order``, numbered; optional report label.

    ``order`` should be total (end with key columns) so ranks are deterministic.
    """
    src = df if where is None else df.filter(where)
    top = src.orderBy(*order).limit(n)
    ranked = top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
    if label is not None:
        ranked = ranked.withColumn(label_col, F.lit(label))
    return ranked


def tagged_union(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL of report parts with possibly different columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def distinct_sample(df: DataFrame, cols: list[str], order: list[Column], n: int = 20) -> DataFrame:
    """DISTINCT + ORDER BY + LIMIT sample (L4)."""
    return df.select(*cols).distinct().orderBy(*order).limit(n)
