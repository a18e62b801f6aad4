"""Event-time arithmetic on epoch-millisecond LONG columns.

Window bounds are computed with integer arithmetic (floor alignment, like
``F.window``) so batch plans stay inside whole-stage codegen and do not depend
on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _session_zone_is_utc() -> bool:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if spark is None:
        return False
    # No default argument: Spark validates it as a zone (an empty one is rejected), and
    # the setting always resolves (to the JVM zone when unset).
    zone = spark.conf.get("spark.sql.session.timeZone") or ""
    return zone.upper() in ("UTC", "Z", "+00:00", "ETC/UTC", "GMT")


def epoch_ms_of_ntz(col: str | Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ, truncated, independent of the session zone.

    Under a UTC session the NTZ → TIMESTAMP cast is the identity on micros, so the
    cheap ``unix_micros`` form is exact; otherwise a zone-free ``timestampdiff``.
    """
    if _session_zone_is_utc():
        micros = F.unix_micros(_c(col).cast("timestamp"))
    else:
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(col))
    return floor_div(micros, 1000)


def floor_div(col: str | Column, n: int | Column) -> Column:
    """Exact floor division of a LONG by a positive LONG (rounds toward −∞)."""
    c = _c(col)
    n_col = n if isinstance(n, Column) else F.lit(int(n))
    # (c - pmod(c, n)) is an exact multiple of n, so integral division is exact.
    return F.call_function("div", c - F.pmod(c, n_col), n_col)


def window_start(ts_ms: str | Column, size_ms: int) -> Column:
    """Start of the tumbling window of ``size_ms`` holding ``ts_ms`` (epoch-aligned, floor)."""
    c = _c(ts_ms)
    return c - F.pmod(c, F.lit(int(size_ms)))


def window_end(ts_ms: str | Column, size_ms: int) -> Column:
    """Exclusive end of the tumbling window of ``size_ms`` holding ``ts_ms``."""
    return window_start(ts_ms, size_ms) + F.lit(int(size_ms))


def to_event_time(ts_ms: str | Column) -> Column:
    """Epoch ms (LONG) → TIMESTAMP, the type ``withWatermark`` and ``F.window`` need."""
    return F.timestamp_millis(_c(ts_ms))
