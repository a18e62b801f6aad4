"""Late data: window side outputs, per-record late split, allowed lateness.

``rows`` carry the tick they arrive in and ``ticks`` its watermark ``wm`` (see
:mod:`thermoflux.operators.replay`).  For a window ending at ``e`` and allowed
lateness ``L``:

* on time        iff ``wm`` is NULL or ``e > wm``;
* allowed-late   iff ``e <= wm < e + L`` (the window re-fires with an update);
* dropped / late iff ``e + L <= wm`` (with ``L = 0`` these go to the side output).

At the end of a replay every open window closes (watermark → +∞).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermoflux.operators.replay import with_watermark
from thermoflux.operators.windows import Assigner, tumbling

ON_TIME, ALLOWED_LATE, DROPPED = "on_time", "allowed_late", "dropped"


def window_status(e: Column, wm: Column, lateness_ms: int = 0) -> Column:
    return (F.when(wm.isNull() | (e > wm), F.lit(ON_TIME))
             .when(wm < e + F.lit(lateness_ms), F.lit(ALLOWED_LATE))
             .otherwise(F.lit(DROPPED)))


def on_time_counts_per_tick(rows: DataFrame, ticks: DataFrame, window: int | Assigner, key: str = "id",
                            ts_col: str = "timestamp") -> DataFrame:
    """``key, window_end, tick, n, wm`` of the rows that reach a still-open window, counted
    before the tick table is joined: the join sees one row per (key, window, tick)."""
    assigned = tumbling(window)(rows, ts_col)
    counted = assigned.groupBy(key, "window_end", "tick").agg(F.count(F.lit(1)).alias("n"))
    return with_watermark(counted, ticks).filter(F.col("wm").isNull() | (F.col("window_end") > F.col("wm")))


def on_time_window_counts(rows: DataFrame, ticks: DataFrame, window: int | Assigner, key: str = "id",
                          ts_col: str = "timestamp") -> DataFrame:
    """Counts per (key, window) of the rows that reach a still-open window
    (default event-time trigger; late rows are excluded) → ``key, window_end, cnt``.
    ``window`` is a size in ms or an assigner."""
    return (on_time_counts_per_tick(rows, ticks, window, key, ts_col)
            .groupBy(key, "window_end").agg(F.sum("n").alias("cnt")))


def _payload(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ("wm", "tick", "arrival", "window_start", "window_end")]


def late_side_output(rows: DataFrame, ticks: DataFrame, window: int | Assigner, ts_col: str = "timestamp") -> DataFrame:
    """``sideOutputLateData``: readings whose window had already closed, unchanged."""
    assigned = with_watermark(tumbling(window)(rows, ts_col), ticks)
    return assigned.filter(F.col("window_end") <= F.col("wm")).select(*_payload(rows))


def late_reading_split(rows: DataFrame, ticks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-record late filter before any window: ``timestamp < currentWatermark``.

    The reference's watermark is one ms below Spark's, hence ``timestamp < wm - 1``.
    Returns ``(main, late)``.
    """
    rows = with_watermark(rows, ticks)
    late = F.col("wm").isNotNull() & (F.col("timestamp") < F.col("wm") - F.lit(1))
    return rows.filter(~late).select(*_payload(rows)), rows.filter(late).select(*_payload(rows))


#: Firings of one (key, window, tick) that are made at a time.
FIRINGS = 1 << 16


def updating_window_counts(rows: DataFrame, ticks: DataFrame, window: int | Assigner, lateness_ms: int,
                           key: str = "id", chunk_rows: int = FIRINGS) -> DataFrame:
    """Allowed lateness with updating results → ``key, window_end, cnt, kind``.

    The first firing emits ``(key, e, n0, 'first')`` with ``n0`` on-time rows (if any);
    each allowed-late row, in arrival order, re-fires with the cumulative count,
    ``'first'`` if it is the window's very first firing, else ``'update'``.  Repeated
    rows (an at-least-once source) each count and fire.

    Rows are counted per (key, window, tick) first.  A firing shows nothing of its row but
    the count, so the firings of a tick are the numbers after the rows of the ticks before:
    one row per (key, window, tick) goes through one window, and firings are exploded,
    ``chunk_rows`` at a time.
    """
    counted = tumbling(window)(rows, "timestamp").groupBy(key, "window_end", "tick").agg(F.count(F.lit(1)).alias("n"))
    judged = with_watermark(counted, ticks).withColumn("status", window_status(F.col("window_end"), F.col("wm"), lateness_ms)) \
        .filter(F.col("status") != F.lit(DROPPED))
    # A window's on-time ticks stand before its late ones, as the watermark never falls.
    on_time, late = F.col("status") == F.lit(ON_TIME), F.col("status") == F.lit(ALLOWED_LATE)
    order = Window.partitionBy(key, "window_end").orderBy("tick")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last_on_time = on_time & F.coalesce(F.lead("status").over(order) == F.lit(ALLOWED_LATE), F.lit(True))
    placed = judged.select(key, "window_end", "n", before.alias("before"), last_on_time.alias("closes"), late.alias("late"))
    total, step = F.col("before") + F.col("n"), F.lit(int(chunk_rows)).cast("long")
    blocks = F.when(F.col("late"), F.sequence(F.col("before") + 1, total, step)).otherwise(F.array(total))
    fired = placed.filter(F.col("late") | F.col("closes")).select(key, "window_end", "late", total.alias("total"), F.explode(blocks).alias("from"))
    fired = fired.select(key, "window_end", "late", F.explode(F.sequence("from", F.least(F.col("from") + step - 1, "total"))).alias("cnt"))
    kind = F.when(~F.col("late") | (F.col("cnt") == 1), F.lit("first")).otherwise(F.lit("update"))
    return fired.select(key, "window_end", F.col("cnt").cast("long").alias("cnt"), kind.alias("kind"))
