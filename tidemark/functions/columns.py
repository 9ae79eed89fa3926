"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"   # ISO-8601 with +hh:mm offset


def lenient_timestamp(c: str | Column) -> Column:
    """String -> timestamp; malformed text becomes null instead of failing (ANSI-safe)."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c)


def iso_text(c: str | Column) -> Column:
    """Timestamp -> ISO-8601 text with offset (session time zone, UTC in all jobs)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, ISO_FORMAT)


def safe_rate(num: str | Column, den: str | Column, digits: int) -> Column:
    """round(num / den, digits), 0.0 when the denominator is not positive."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.when(d > 0, F.round(n / d, digits)).otherwise(F.lit(0.0))


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """(later - earlier) in seconds as double, microsecond exact."""
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return (F.unix_micros(a) - F.unix_micros(b)) / F.lit(1_000_000.0)


def to_ntz(df):
    """Cast every session-time-zone timestamp column to TIMESTAMP_NTZ (UTC wall clock).

    Used only at the presentation edge so results compare equal with engines
    whose timestamps are zone-less.
    """
    from pyspark.sql import types as T
    cols = [F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)
