"""Two-stream operators: a keyed stream connected with a control stream.

The control stream's effect is a set of disjoint time intervals — while a switch is
open (per sensor), while the smoke level is HIGH (global) — computed from the
control side alone with ordered running aggregates.  Readings are then looked up by
one equi-join on ``(key, time bucket)`` plus a range filter, at every size: adaptive
execution broadcasts the interval side by its measured size or shuffles both, and
splits skewed partitions.  The bucket is the mean interval length, found inside the
query, so an interval falls into two buckets on average and the interval side at
most doubles, whether intervals last seconds or years.

Ordering convention: both sides carry event time; at equal ``timestamp`` the
control row applies first.  Comparisons with NaN are false, as in Java.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoflux.functions.temporal import floor_div
from thermoflux.functions.text import alert_message
from thermoflux.operators.scan import CHUNK_ROWS, Measure, running_scan
from thermoflux.schema import SMOKE_HIGH

# Fixed alert threshold of the fire-risk example (strict >).
FIRE_ABOVE = 100.0


def smoke_high_intervals(smoke: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Periods of HIGH smoke level as disjoint ``[start, end)`` (``end`` NULL: still HIGH).

    Smoke events ordered by ``(timestamp, event_id)``; an event's level holds until the
    next event, so each HIGH event gives ``[ts, next_ts)`` (empty when the next event
    has the same time).  ``next_ts`` is one ordered running aggregate over the
    control stream (reverse order, chunked so no task holds all of it).
    """
    rev = smoke.select("event_id", "level", "timestamp",
                       (-F.col("timestamp")).alias("neg_ts"), (-F.col("event_id")).alias("neg_id"))
    nxt = running_scan(rev, [], ["neg_ts", "neg_id"], [Measure("next_ts", "min", F.col("timestamp"))],
                       chunk_rows=chunk_rows, exclusive=True)
    return (nxt.filter((F.col("level") == F.lit(SMOKE_HIGH))
                       & (F.col("next_ts").isNull() | (F.col("next_ts") > F.col("timestamp"))))
               .select(F.col("timestamp").alias("start"), F.col("next_ts").alias("end")))


def switch_intervals(switches: DataFrame, keys: Sequence[str] = ("id",), chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per key, the union of the switches' ``[ts, ts + d)`` as disjoint intervals.

    From one switch to the next, forwarding lasts until the greatest end so far: each row of
    one exclusive scan closes the piece that the rows before it left open, and the last piece
    of a key comes from its greatest start and end."""
    keys = list(keys)
    s = switches.select(*keys, "event_id", F.col("timestamp").alias("at"), (F.col("timestamp") + F.col("duration_ms")).alias("until")) \
        .filter(F.col("until") > F.col("at"))
    before = running_scan(s, keys, ["at", "event_id"], [Measure("start", "max", F.col("at")), Measure("open_until", "max", F.col("until"))],
                          chunk_rows=chunk_rows, exclusive=True)
    pieces = before.select(*keys, "start", F.least("at", "open_until").alias("end"))
    last = s.groupBy(*keys).agg(F.max("at").alias("start"), F.max("until").alias("end"))
    return pieces.unionByName(last).filter(F.col("end") > F.col("start"))


def in_intervals(rows: DataFrame, intervals: DataFrame, keys: list[str], bucket_ms: int | Column | None = None,
                 ts_col: str = "timestamp") -> DataFrame:
    """Rows whose ``ts_col`` lies in one of their key's disjoint ``[start, end)`` intervals.

    ``bucket_ms`` (a number or a scalar column) overrides the mean interval length as bucket width."""
    if bucket_ms is None:
        mean = F.ceil(F.avg(F.col("end") - F.col("start"))).cast("long")
        width: Column = F.coalesce(intervals.agg(F.greatest(mean, F.lit(1).cast("long")).alias("w")).scalar(), F.lit(1).cast("long"))
    else:
        width = bucket_ms if isinstance(bucket_ms, Column) else F.lit(int(bucket_ms)).cast("long")
    slots = intervals.select(*keys, "start", "end", F.explode(F.sequence(
        floor_div("start", width), floor_div(F.col("end") - F.lit(1), width))).alias("_bucket"))
    probe = rows.withColumn("_bucket", floor_div(ts_col, width))
    joined = probe.join(slots, on=[*keys, "_bucket"], how="inner")
    return joined.filter((F.col("start") <= F.col(ts_col)) & (F.col(ts_col) < F.col("end"))).select(*rows.columns)


def fire_alerts(readings: DataFrame, smoke: DataFrame, threshold: float = FIRE_ABOVE, bucket_ms: int | None = None,
                chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Alert ``"Risk of fire!(id, ts, t)"`` for each reading with ``t > threshold`` while the
    latest smoke level (as of the reading's time; none yet → LOW) is HIGH.

    The smoke level is global (the control stream is broadcast to all keys), so this
    is an as-of join on time.  Readings that cannot alert are filtered first (the
    predicate reaches the parquet scan).  → ``event_id, message, timestamp, temperature``.
    """
    intervals = smoke_high_intervals(smoke, chunk_rows)
    t = F.col("temperature")
    hot = readings.filter((t > F.lit(float(threshold))) & ~F.isnan(t)).select("event_id", "id", "timestamp", "temperature")
    # The last period may be open: it ends just after the last hot reading, or is empty.
    last = F.coalesce(hot.agg(F.max("timestamp").alias("t")).scalar() + F.lit(1), F.col("start"))
    closed = intervals.withColumn("end", F.coalesce("end", last)).filter(F.col("end") > F.col("start"))
    inside = in_intervals(hot, closed, [], bucket_ms)
    return inside.select("event_id", alert_message().alias("message"), "timestamp", "temperature")


def _mean_piece(switches: DataFrame, keys: Sequence[str]) -> Column:
    """Mean length of the switches' disjoint pieces, nearly: what they span, or their own
    lengths if that is less, over their number.  One aggregate of the switches alone."""
    end = F.col("timestamp") + F.col("duration_ms")
    per_key = switches.filter(F.col("duration_ms") > 0).groupBy(*keys).agg(
        F.least(F.max(end) - F.min("timestamp"), F.sum("duration_ms")).cast("double").alias("covered"), F.count(F.lit(1)).alias("n"))
    mean = F.ceil(F.sum("covered") / F.sum("n")).cast("long")
    return F.coalesce(per_key.agg(F.greatest(mean, F.lit(1).cast("long")).alias("w")).scalar(), F.lit(1).cast("long"))


def forward_switch(readings: DataFrame, switches: DataFrame, bucket_ms: int | None = None,
                   chunk_rows: int = CHUNK_ROWS, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Forward a reading only while its sensor's switch is open.

    A switch ``(keys, ts, d)`` opens forwarding for ``[ts, ts + d)``; a later-expiring
    switch extends it, an earlier-expiring one is ignored, and at expiry all state
    clears: the union of the sensor's switch intervals.  → the reading columns.
    """
    width = _mean_piece(switches, keys) if bucket_ms is None else bucket_ms
    return in_intervals(readings, switch_intervals(switches, keys, chunk_rows), list(keys), width)
