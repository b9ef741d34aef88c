"""Local HHMM clock text -> timestamps -> UTC instants (H-DT1..8, P18, P19).

Conventions: the session clock is UTC, so a ``timestamp`` value *is* a UTC
instant. Local wall-clock values are built as ``timestamp`` too and converted
with ``to_utc_timestamp`` plus the fall-back fix (K3).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _zone(zone) -> Column:
    """A zone given as Column, column name, or IANA literal ('Area/City', 'UTC')."""
    if isinstance(zone, str):
        return F.lit(zone) if ("/" in zone or zone.upper() == "UTC") else F.col(zone)
    return zone


def hhmm_string(t) -> Column:
    """null -> ''; strip trailing '.0+'; left-pad to 4 with '0' (H-DT1).

    ``lpad`` also truncates longer text to 4 characters.
    """
    s = F.trim(F.coalesce(_col(t).cast("string"), F.lit("")))
    return F.lpad(F.regexp_replace(s, r"\.0+$", ""), 4, "0")


def hhmm_to_local(date, t) -> Column:
    """Date + HHMM text -> local wall-clock timestamp (H-DT2).

    null date or null/''/'NA' time -> null; 2400 -> next midnight;
    hour > 23 or minute > 59 -> null.
    """
    d = _col(date).cast("date")
    raw = F.trim(F.coalesce(_col(t).cast("string"), F.lit("")))
    s = hhmm_string(t)
    return _local_from_parts(d, raw, F.substring(s, 1, 2).try_cast("int"), F.substring(s, 3, 2).try_cast("int"))


def _local_from_parts(d: Column, raw: Column, hh: Column, mm: Column) -> Column:
    return (F.when(d.isNull(), F.lit(None).cast("timestamp"))
            .when(raw.isin("", "NA"), F.lit(None).cast("timestamp"))
            .when((hh == 24) & (mm == 0), F.to_timestamp(F.date_add(d, 1)))
            .when(hh.isNull() | mm.isNull() | (hh > 23) | (mm > 59), F.lit(None).cast("timestamp"))
            .otherwise(F.timestamp_add("MINUTE", hh * 60 + mm, F.to_timestamp(d))))


def with_local_and_utc(df, date, specs: list[tuple[str, str, object, str | None]]):
    """Add local and UTC timestamps for several HHMM columns (H-DT1-3) - DataFrame form.

    ``specs``: (hhmm column, local output, zone column/literal, UTC output or
    None). The padded text, hour and minute are projected once; the
    optimizer does not inline a non-trivial column that is read several
    times, so the parse runs once per row instead of once per CASE branch.
    """
    d = _col(date).cast("date")
    parts = []
    for i, (t, _, _, _) in enumerate(specs):
        s = hhmm_string(t)
        parts += [F.trim(F.coalesce(_col(t).cast("string"), F.lit(""))).alias(f"__raw{i}"),
                  F.substring(s, 1, 2).try_cast("int").alias(f"__hh{i}"),
                  F.substring(s, 3, 2).try_cast("int").alias(f"__mm{i}")]
    out = df.select("*", d.alias("__d"), *parts)
    out = out.select("*", *[_local_from_parts(F.col("__d"), F.col(f"__raw{i}"), F.col(f"__hh{i}"),
                                              F.col(f"__mm{i}")).alias(local)
                            for i, (_, local, _, _) in enumerate(specs)])
    utc_cols = [local_to_utc(F.col(local), zone).alias(utc) for _, local, zone, utc in specs if utc]
    out = out.select("*", *utc_cols) if utc_cols else out
    drop = ["__d"] + [f"__{k}{i}" for i in range(len(specs)) for k in ("raw", "hh", "mm")]
    return out.drop(*drop)


def local_to_utc(local_ts, zone) -> Column:
    """Wall clock in an IANA zone -> UTC instant (H-DT3, with the K3 fix).

    ``to_utc_timestamp`` resolves the repeated fall-back hour to daylight
    time; the reference's database takes standard time (the later instant).
    If the instant one hour later still shows the same wall clock, the wall
    clock was ambiguous and the later instant is the standard-time reading.
    """
    ts = _col(local_ts)
    z = _zone(zone)
    u = F.to_utc_timestamp(ts, z)
    later = F.timestamp_add("HOUR", F.lit(1), u)
    return F.when(F.from_utc_timestamp(later, z) == ts, later).otherwise(u)


def hhmm_to_utc(date, t, zone) -> Column:
    """Date + HHMM in zone -> UTC instant (H-DT3)."""
    return local_to_utc(hhmm_to_local(date, t), zone)


def utc_to_local(ts, zone) -> Column:
    """UTC instant -> wall clock in zone (H-DT4)."""
    return F.from_utc_timestamp(_col(ts), _zone(zone))


def epoch_seconds(ts) -> Column:
    """Fractional epoch seconds of an instant (H-DT5)."""
    return F.unix_micros(_col(ts)) / F.lit(1_000_000.0)


def lag_minutes(later, earlier) -> Column:
    """Signed difference in fractional minutes: later - earlier."""
    return (F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))) / F.lit(60_000_000.0)


def add_hours(ts, n) -> Column:
    """ts +/- n hours (H-DT8)."""
    return F.timestamp_add("HOUR", F.lit(n), _col(ts))


def calendar_features(ts) -> dict[str, Column]:
    """UTC hour, ISO weekday 1-7 (Mon=1), month."""
    c = _col(ts)
    return {
        "hour": F.hour(c),
        "dow_iso": ((F.dayofweek(c) + 5) % 7 + 1),
        "month": F.month(c),
    }


def year_month(ts) -> Column:
    """'yyyy-MM' label of a timestamp/date."""
    return F.date_format(_col(ts), "yyyy-MM")


def departure_anchor(actual_utc, scheduled_utc, cancelled) -> tuple[Column, Column]:
    """Actual time if flown and known, else scheduled; plus source label."""
    use_actual = (~F.coalesce(_col(cancelled), F.lit(False))) & _col(actual_utc).isNotNull()
    anchor = F.when(use_actual, _col(actual_utc)).otherwise(_col(scheduled_utc))
    source = F.when(use_actual, F.lit("actual")).otherwise(F.lit("scheduled"))
    return anchor, source


def month_bounds(ym: str) -> tuple[str, str]:
    """'yyyy-MM' -> (first day, first day of next month) as ISO strings (H-DT6)."""
    y, m = (int(p) for p in ym.split("-"))
    ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
    return f"{y:04d}-{m:02d}-01", f"{ny:04d}-{nm:02d}-01"


def days_in_month(ym: str) -> int:
    """Days of a 'yyyy-MM' month (H-DT6)."""
    import calendar
    return calendar.monthrange(*(int(p) for p in ym.split("-")))[1]


def month_range(start_ym: str, end_ym: str) -> list[str]:
    """Inclusive list of 'yyyy-MM' labels (H-DT6)."""
    y, m = (int(p) for p in start_ym.split("-"))
    ey, em = (int(p) for p in end_ym.split("-"))
    out = []
    while (y, m) <= (ey, em):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out
