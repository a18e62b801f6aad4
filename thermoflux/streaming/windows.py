"""Event-time tumbling windows on streams with Spark's built-in stateful aggregation.

``withWatermark`` + ``groupBy(id, window(ts))`` keeps one partial aggregate
per open (id, window) in the state store and emits it once in ``append`` mode
when the watermark passes the window end — the default event-time trigger.
Late rows (window already closed) are dropped by the operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoflux.functions.text import fahrenheit_to_celsius
from thermoflux.operators.windows import nan_safe
from thermoflux.streaming.sources import EVENT_TIME, with_event_time


def _window(size_ms: int):
    return F.window(EVENT_TIME, f"{int(size_ms)} milliseconds")


def _end_ms():
    return F.unix_millis(F.col("w.end"))


def stream_avg_tumbling(stream: DataFrame, size_ms: int, delay_ms: int) -> DataFrame:
    """Average °C per (id, window) → ``id, timestamp (window end), temperature``."""
    s = with_event_time(stream, delay_ms).select("id", EVENT_TIME, fahrenheit_to_celsius("temperature").alias("c"))
    return (s.groupBy("id", _window(size_ms).alias("w")).agg(F.avg("c").alias("temperature"))
             .select("id", _end_ms().alias("timestamp"), "temperature"))


def stream_minmax_tumbling(stream: DataFrame, size_ms: int, delay_ms: int) -> DataFrame:
    s = with_event_time(stream, delay_ms)
    return (s.groupBy("id", _window(size_ms).alias("w"))
             .agg(nan_safe(F.min, "temperature").alias("min"), nan_safe(F.max, "temperature").alias("max"))
             .select("id", "min", "max", _end_ms().alias("endTs")))


def stream_count_tumbling(stream: DataFrame, size_ms: int, delay_ms: int) -> DataFrame:
    """Counts of on-time rows per (id, window) → ``id, window_end, cnt``.

    For exact agreement with the replay model's late-row rule, run with
    ``spark.sql.streaming.statefulOperator.allowMultiple=false`` (then the late
    filter and the eviction use the same batch watermark).
    """
    s = with_event_time(stream, delay_ms)
    return (s.groupBy("id", _window(size_ms).alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
             .select("id", _end_ms().alias("window_end"), "cnt"))
