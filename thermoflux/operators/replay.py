"""Replay model of periodic watermarks (batch form of event-time progress).

Watermarks are refreshed periodically, not per row — exactly a micro-batch.
Rows are grouped into ticks ``tick = floor(arrival / tick_ms)``; every row of
tick ``k`` is judged by ``wm(k) = max(timestamp of all rows in earlier ticks)
- delay`` (−∞, i.e. NULL, for the first tick).  ``wm`` is always the Spark
watermark value (a window ``[s, e)`` is closed once ``e <= wm``).

The tick table has one row per tick (bounded by time span / tick width, not by
data volume): one partial/final aggregate over the rows and a chunked prefix
scan.  It is a lazy plan; Spark reuses its exchanges where it is read twice, and
adaptive execution joins it by its measured size.  Counting operators aggregate
to (key, window, tick) first and join only those rows to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoflux.functions.temporal import floor_div
from thermoflux.operators.scan import Measure, running_scan

TICKS_PER_SCAN_CHUNK = 4096


def tick_watermarks(rows: DataFrame, delay_ms: int, tick_col: str = "tick",
                    ts_col: str = "timestamp") -> DataFrame:
    """``tick, tmax, tmin, wm, wm_next, tmin_before``.

    * ``wm`` — watermark in force while the tick's rows arrive (NULL = −∞);
    * ``wm_next`` — the watermark after this tick's rows (= ``wm`` of the next tick);
    * ``tmin_before`` — least timestamp of all earlier ticks.
    """
    per_tick = rows.groupBy(tick_col).agg(F.max(ts_col).alias("tmax"), F.min(ts_col).alias("tmin"))
    scanned = running_scan(per_tick, [], [tick_col],
                           [Measure("m_before", "max", F.col("tmax")), Measure("tmin_before", "min", F.col("tmin"))],
                           chunk=floor_div(tick_col, TICKS_PER_SCAN_CHUNK), exclusive=True)
    return scanned.select(
        tick_col, "tmax", "tmin", "tmin_before",
        (F.col("m_before") - F.lit(delay_ms)).alias("wm"),
        (F.greatest("m_before", "tmax") - F.lit(delay_ms)).alias("wm_next"))


def with_watermark(rows: DataFrame, ticks: DataFrame, tick_col: str = "tick") -> DataFrame:
    """Attach the tick's watermark ``wm`` to every row (or pre-aggregated row)."""
    return rows.join(ticks.select(tick_col, "wm"), on=tick_col, how="inner")


def replay(rows: DataFrame, delay_ms: int, tick_col: str = "tick") -> tuple[DataFrame, DataFrame]:
    """The rows, and their tick table."""
    return rows, tick_watermarks(rows, delay_ms, tick_col)
