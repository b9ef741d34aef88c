"""Text-field cleaning.

All functions map ``Column -> Column`` and stay inside whole-stage codegen.
Raw landing data are all-text; these turn tokens into typed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Source tokens that mean "missing" and "trace amount".
MISSING_TOKEN = "M"
TRACE_TOKEN = "T"

# the source column has no fixed scale; ten decimals and 28 digits before them
DECIMAL = "decimal(38,10)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c) -> Column:
    return F.trim(_col(c).cast("string"))


def _cast(t: Column, dtype: str, strict: bool) -> Column:
    # strict: ANSI cast, bad text raises (reference behaviour, K19);
    # lenient: try_cast, bad text becomes null (pair with numeric_violations).
    return t.cast(dtype) if strict else t.try_cast(dtype)


def clean_text(c, missing: str = MISSING_TOKEN) -> Column:
    """trim; '' -> null; missing token -> null."""
    return F.nullif(F.nullif(_text(c), F.lit("")), F.lit(missing))


def clean_numeric(c, missing: str = MISSING_TOKEN, dtype: str = DECIMAL,
                  strict: bool = True) -> Column:
    """trim; ''/missing -> null; else cast."""
    t = _text(c)
    return F.when(t.isin("", missing), F.lit(None).cast(dtype)).otherwise(_cast(t, dtype, strict))


def clean_numeric_trace(c, missing: str = MISSING_TOKEN, trace: str = TRACE_TOKEN,
                        dtype: str = DECIMAL, strict: bool = True) -> Column:
    """As :func:`clean_numeric`, plus trace token -> 0."""
    t = _text(c)
    return (F.when(t.isin("", missing), F.lit(None).cast(dtype))
            .when(t == F.lit(trace), F.lit(0).cast(dtype))
            .otherwise(_cast(t, dtype, strict)))


def clean_flag(c) -> Column:
    """null/blank -> '0'; true iff the numeric value equals 1."""
    t = F.coalesce(F.nullif(_text(c), F.lit("")), F.lit("0"))
    return t.cast(DECIMAL) == F.lit(1)


def null_if_cancelled(value: Column, cancelled: Column) -> Column:
    """Null a measure on cancelled rows (P5)."""
    return F.when(cancelled, F.lit(None)).otherwise(value)


def cancel_aware_flag(raw_flag, cancelled: Column) -> Column:
    """15+ flag: null if cancelled; otherwise blank -> false, 1 -> true."""
    return F.when(cancelled, F.lit(None).cast("boolean")).otherwise(clean_flag(raw_flag))


def numeric_violations(df: DataFrame, cols, missing: str = MISSING_TOKEN,
                       trace: str | None = None) -> DataFrame:
    """Rows whose text in any of ``cols`` would fail the numeric cast.

    The quarantine side of ``strict=False`` cleaning (K19): a data test that
    returns the violating rows instead of aborting the whole job.
    """
    cond = None
    for c in cols:
        t = _text(c)
        ok = t.isNull() | t.isin("", missing) | t.try_cast(DECIMAL).isNotNull()
        if trace is not None:
            ok = ok | (t == F.lit(trace))
        cond = ~ok if cond is None else (cond | ~ok)
    return df.filter(cond)
