"""Structured Streaming forms of the stateful operators.

Each builder takes streaming DataFrames with the batch forms' columns and
returns a streaming DataFrame; start it with any sink (``foreachBatch`` helpers
in :mod:`thermoflux.streaming.sinks`).  State lives in the state store under the
query's checkpoint location, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from thermoflux.functions.text import alert_message, freezing_message
from thermoflux.operators.connect import FIRE_ABOVE
from thermoflux.operators.contents import Count, Reduce
from thermoflux.operators.windows import Assigner, keyed
from thermoflux.streaming.processors import (
    ConnectedProcessor,
    LateReadingSplit,
    ReadingFilter,
    RollingMax,
    RollingReduce,
    RollingSum,
    SmokeAlert,
    WallClockReadingFilter,
)
from thermoflux.streaming.sources import EVENT_TIME, with_event_time
from thermoflux.streaming.windowing import EarlyFiring, stream_windows


# Pending rows of the buffering processors lie in about this many time buckets per delay.
BUCKETS_PER_DELAY = 16


def session_shards(df: DataFrame) -> int:
    """As many groups as the session has shuffle partitions: parallelism follows the cluster."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stream_rolling_sum(triples: DataFrame, ttl_ms: int | None = None, key: str | Column = "k", value: str = "v",
                       carried: str = "c", seq: str = "event_id") -> DataFrame:
    """One running-sum row per input row: ``seq``, the key, the sum of ``value``, and the key's
    first ``carried``.  ``key`` is a column or a named expression.  ``ttl_ms``: optional
    expiry of idle keys' state; with it the processor runs in processing-time mode."""
    mode = "ProcessingTime" if ttl_ms else "None"
    rows, (name,) = keyed(triples, [key])
    key_type = rows.schema[name].dataType.simpleString()
    inside = rows.select(F.col(seq).cast("long").alias("event_id"), F.col(name).alias("k"), F.col(value).cast("long").alias("v"), F.col(carried).cast("long").alias("c"))
    out = inside.groupBy("k").transformWithStateInPandas(RollingSum(ttl_ms), RollingSum.OUTPUT.replace("k long", f"k {key_type}"), "append", mode)
    return out.select(F.col("event_id").alias(seq), F.col("k").alias(name), F.col("v").alias(value), F.col("c").alias(carried))


def stream_rolling_reduce(rows: DataFrame, content: Reduce, keys: Sequence[str | Column], seq: str = "event_id",
                          ttl_ms: int | None = None) -> DataFrame:
    """A user's rolling reduce → ``seq``, the keys and the reduced record, per input row."""
    with_keys, names = keyed(rows, keys)
    types = {f.name: f.dataType.simpleString() for f in with_keys.schema}
    processor = RollingReduce(content, {n: types[n] for n in names}, seq, types[seq], ttl_ms)
    inside = with_keys.select(*dict.fromkeys([seq, *names, *content.columns]))
    return inside.groupBy(*names).transformWithStateInPandas(processor, processor.output, "append", "ProcessingTime" if ttl_ms else "None")


def stream_rolling_max(readings: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """``(event_id, id, timestamp, temperature)`` → the arg-max record so far per input row."""
    mode = "ProcessingTime" if ttl_ms else "None"
    out = (readings.select("event_id", "id", "timestamp", "temperature").groupBy("id")
                   .transformWithStateInPandas(RollingMax(ttl_ms), RollingMax.OUTPUT, "append", mode))
    # A reading always has a temperature: what pandas hands back as null was NaN.
    return out.withColumn("temperature", F.coalesce("temperature", F.lit(float("nan"))))


def stream_forward_switch_wall_clock(readings: DataFrame, switches: DataFrame) -> DataFrame:
    """Live switch with processing-time semantics (the reference's clock); not replayable.
    Run with a processing-time trigger and stop it explicitly."""
    r = readings.select("event_id", "id", "timestamp", "temperature",
                        F.lit(None).cast("long").alias("duration_ms"), F.lit(1).alias("src_rank"))
    s = switches.select("event_id", "id", "timestamp", F.lit(None).cast("double").alias("temperature"),
                        "duration_ms", F.lit(0).alias("src_rank"))
    return (r.unionByName(s).groupBy("id")
             .transformWithStateInPandas(WallClockReadingFilter(), WallClockReadingFilter.OUTPUT,
                                         "append", "ProcessingTime"))


def stream_forward_switch(readings: DataFrame, switches: DataFrame, delay_ms: int) -> DataFrame:
    """Readings forwarded while their sensor's switch is open; rows are applied in
    event-time order once the watermark (``delay_ms``) passes them."""
    r = readings.select("event_id", "id", "timestamp", "temperature",
                        F.lit(None).cast("long").alias("expiry"), F.lit(1).alias("src_rank"))
    s = switches.select("event_id", "id", "timestamp", F.lit(None).cast("double").alias("temperature"),
                        (F.col("timestamp") + F.col("duration_ms")).alias("expiry"), F.lit(0).alias("src_rank"))
    return stream_connected(s.drop("src_rank"), r.drop("src_rank"), ReadingFilter(delay_ms // BUCKETS_PER_DELAY), delay_ms, ["id"])


def stream_fire_alerts(readings: DataFrame, smoke: DataFrame, delay_ms: int, threshold: float = FIRE_ABOVE,
                       shards: int | None = None) -> DataFrame:
    """Fire alerts: hot readings salted over ``shards`` (default: the session's shuffle
    partitions), smoke fanned out to every shard; rows are applied in event-time order once the watermark (``delay_ms``) passes them;
    the message text is formatted on the JVM side (Java number formatting)."""
    shards = shards or session_shards(readings)
    t = F.col("temperature")
    hot = readings.filter((t > F.lit(float(threshold))) & ~F.isnan(t)).select(
        "event_id", "id", "timestamp", "temperature", F.lit(None).cast("string").alias("level"),
        F.lit(1).alias("src_rank"), F.pmod(F.xxhash64("event_id"), F.lit(shards)).alias("shard"))
    fan = smoke.select(
        "event_id", F.lit(None).cast("string").alias("id"), "timestamp", F.lit(None).cast("double").alias("temperature"),
        "level", F.lit(0).alias("src_rank"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    out = stream_connected(fan.drop("src_rank"), hot.drop("src_rank"), SmokeAlert(delay_ms // BUCKETS_PER_DELAY), delay_ms, ["shard"])
    return out.select("event_id", alert_message().alias("message"), "timestamp", "temperature")


def stream_late_windows(readings: DataFrame, size_ms: int | Assigner, lateness_ms: int, delay_ms: int) -> DataFrame:
    """Counts with allowed lateness and updates (``tag`` = ``count``: ``id, window_end, cnt,
    kind``, ``first`` for a window's first firing, else ``update``) and the readings whose
    window is past its lateness (``tag`` = ``late``)."""
    rows = readings.select("event_id", "id", "timestamp", "temperature", "arrival")
    out = stream_windows(rows, size_ms, Count(), delay_ms, lateness_ms=lateness_ms, order=("arrival", "event_id"), late_output=True)
    late = F.col("tag") == "late"
    return out.select(
        F.when(late, F.lit("late")).otherwise(F.lit("count")).alias("tag"), "id", F.when(~late, F.col("window_end")).alias("window_end"), "cnt",
        F.when(late, F.lit(None)).when(F.col("firing") == 0, F.lit("first")).otherwise(F.lit("update")).alias("kind"),
        F.col("late_event_id").alias("event_id"), F.col("late_timestamp").alias("timestamp"), F.col("late_temperature").alias("temperature"))


def stream_early_firing(readings: DataFrame, size_ms: int | Assigner, step_ms: int, delay_ms: int) -> DataFrame:
    """``(id, window_end, eval_time, cnt)``: counts that fire early, at each whole step."""
    return (stream_windows(readings.select("id", "timestamp"), size_ms, Count(), delay_ms, trigger=EarlyFiring(step_ms))
            .select("id", "window_end", "eval_time", "cnt"))


def stream_connected(control: DataFrame, data: DataFrame, processor: ConnectedProcessor, delay_ms: int,
                     control_keys: Sequence[str | Column], data_keys: Sequence[str | Column] | None = None) -> DataFrame:
    """Connect two streams of different schemas by key and run a :class:`ConnectedProcessor`.

    Both need ``event_id`` and ``timestamp``.  Keys are columns or named expressions, one
    selector for each side; the names are those of ``control_keys``.  The processor sees
    the columns of both sides (null on the other's rows) and ``src_rank``, 0 for ``control``."""
    def side(df: DataFrame, keys: Sequence[str | Column], rank: int, names: list[str] | None) -> tuple[DataFrame, list[str]]:
        own = df.columns
        with_keys, found = keyed(df, keys)
        names = names or [f"_key_{n}" for n in found]
        selected = [F.col(k).alias(n) for k, n in zip(found, names, strict=True)]
        return with_keys.select(*own, *selected, F.lit(rank).alias("src_rank")), names

    left, names = side(control, control_keys, 0, None)
    right, _ = side(data, data_keys or control_keys, 1, names)
    both = left.unionByName(right, allowMissingColumns=True)
    processor.ARROW = pa.schema([f for f in to_arrow_schema(both.drop(*names).schema)])
    return (with_event_time(both, delay_ms).groupBy(*names)
            .transformWithStateInPandas(processor, processor.OUTPUT, "append", "EventTime"))


def stream_late_reading_split(readings: DataFrame, delay_ms: int, shards: int | None = None) -> DataFrame:
    """Tagged (``main`` | ``late``) readings by the batch watermark; write with
    :func:`thermoflux.streaming.sinks.start_tagged`.  The comparison has no state, so rows
    are spread by their own hash over ``shards`` groups (default: the session's shuffle
    partitions) and a hot sensor is no hot task."""
    s = with_event_time(readings.select("event_id", "id", "timestamp", "temperature"), delay_ms).drop(EVENT_TIME)
    shard = F.pmod(F.xxhash64("event_id"), F.lit(shards or session_shards(readings)))
    return (s.withColumn("shard", shard).groupBy("shard")
             .transformWithStateInPandas(LateReadingSplit(), LateReadingSplit.OUTPUT, "append", "EventTime"))


def stream_freezing_monitor(readings: DataFrame, below: float = 32.0) -> DataFrame:
    """Every reading tagged ``main``, plus a ``freezing-alarms`` row per reading below
    ``below``: one pass over the source, each reading exploded to its tags."""
    cold = F.col("temperature") < F.lit(float(below))
    tags = F.when(cold, F.array(F.lit("main"), F.lit("freezing-alarms"))).otherwise(F.array(F.lit("main")))
    tagged = readings.select(F.explode(tags).alias("tag"), "event_id", "id", "timestamp", "temperature")
    return tagged.withColumn("message", F.when(F.col("tag") == "freezing-alarms", freezing_message("id")))
