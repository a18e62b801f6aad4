"""Streaming sources: file streams of readings.

A live deployment reads ``spark.readStream`` from its landing folder (or a
message bus) with an explicit schema; ``read_stream`` is that call.  A folder
with one file per watermark tick, read with ``maxFilesPerTrigger=1``, replays
ticks as micro-batches — the periodic watermark of the replay model becomes
Spark's per-batch watermark (the tests write such folders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermoflux.functions.temporal import to_event_time

EVENT_TIME = "ts"


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def with_event_time(df: DataFrame, delay_ms: int, ts_col: str = "timestamp") -> DataFrame:
    """Bounded-out-of-orderness watermark on the epoch-ms ``ts_col`` (adds ``ts``)."""
    return df.withColumn(EVENT_TIME, to_event_time(ts_col)).withWatermark(EVENT_TIME, f"{int(delay_ms)} milliseconds")


def replay_stream(spark: SparkSession, out_dir: str, schema: T.StructType, tick_col: str = "tick") -> DataFrame:
    """Read replay files back as a stream, one tick per micro-batch."""
    full = T.StructType(list(schema.fields) + [T.StructField(tick_col, T.LongType(), True)])
    return read_stream(spark, out_dir, full, max_files_per_trigger=1).withColumn(tick_col, F.col(tick_col).cast("long"))
