"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols, sep: str = "|") -> Column:
    """md5 (lower-case hex) of the separator-joined key parts, each null -> ''."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
             for c in cols]
    return F.md5(F.concat_ws(sep, *parts))
