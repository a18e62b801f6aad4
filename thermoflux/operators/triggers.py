"""Early-firing window trigger (batch closed form).

A window ``[e - size, e)`` opens on its first on-time element (tick ``f``).
While open it fires, without purging, each time the watermark crosses a whole
``step`` (the crossing ticks), and at its end it fires and purges.  Every
firing emits ``(key, e, eval_time = wm, cnt)`` with ``cnt`` the on-time rows of
the window that arrived in earlier ticks (watermark first, then data).

Closed form over the tick table (``wm`` non-decreasing in tick):

* crossing ticks are the first ticks of the runs of equal ``floor(wm / step)``;
  ``x(k)`` counts those up to tick ``k``, so they are numbered 1, 2, ...;
* a window's early firings are the crossings after ``f`` with ``wm < e``.  Let ``j``
  be the last tick with ``wm < e``: they are the numbers ``x(f) + 1 .. x(j)``,
  exploded, one generated row per firing;
* the final firing is at the tick after ``j``, whose watermark is ``wm_next`` of
  ``j``; if ``j`` is the last tick, the window closes at the end of the replay with
  ``eval_time = e``.

``j`` of every window end comes from one ascending running scan over the union of
the tick watermarks and the distinct window ends (bounded by those two, not by
rows); no range join, no grid over steps or window slots, no driver round-trip.
Counts are a running sum over per-tick pre-aggregated counts, so a hot (key, window)
contributes at most one row per tick to the analytic window.  The whole is one lazy
plan: nothing is written or counted when it is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermoflux.functions.temporal import floor_div
from thermoflux.operators.lateness import on_time_counts_per_tick
from thermoflux.operators.replay import TICKS_PER_SCAN_CHUNK
from thermoflux.operators.scan import Measure, running_scan
from thermoflux.operators.windows import Assigner, tumbling

# Stands for a watermark of −∞ (below any epoch-ms watermark, negatable without overflow).
_MINUS_INFINITY = -(1 << 62)
# The tick of a window's final firing: after all data.
_AT_END = (1 << 62)


def numbered_crossings(ticks: DataFrame, step_ms: int) -> DataFrame:
    """``tick, wm, wm_next, crosses, x``: whether the watermark crosses a whole step at the
    tick, and the crossings up to it."""
    # The tick after j crosses iff the watermark's step changes over j: counted exclusively.
    leaves = F.col("wm").isNull() | (floor_div("wm_next", step_ms) > floor_div("wm", step_ms))
    return running_scan(ticks.select("tick", "wm", "wm_next", leaves.cast("long").alias("leaves")), [], ["tick"],
                        [Measure("x", "sum", F.col("leaves")), Measure("crosses", "last", F.col("leaves"))],
                        chunk=floor_div("tick", TICKS_PER_SCAN_CHUNK), exclusive=True) \
        .select("tick", "wm", "wm_next", F.coalesce("x", F.lit(0)).alias("x"), (F.col("crosses") == 1).alias("crosses"))


def early_firing_counts(rows: DataFrame, ticks: DataFrame, window: int | Assigner, step_ms: int, key: str = "id") -> DataFrame:
    """``rows``: ``key, timestamp, tick``; ``ticks``: from
    :func:`thermoflux.operators.replay.tick_watermarks`; ``window``: a size in ms or an
    assigner.  → ``key, window_end, eval_time, cnt``."""
    per_tick = on_time_counts_per_tick(rows, ticks, window, key)
    windows = per_tick.groupBy(key, "window_end").agg(F.min("tick").alias("f"))
    numbered = numbered_crossings(ticks, step_ms)

    # The last tick below each window end; at equal values the probe comes first.  Of ticks with
    # one watermark the last stands for all, so a stalled watermark is a single row; ends of
    # windows without on-time rows do no harm.
    marks = (numbered.groupBy(F.coalesce("wm", F.lit(_MINUS_INFINITY)).alias("v")).agg(F.max(F.struct("tick", "x", "wm_next")).alias("below"))
             .select("v", F.lit(1).alias("mark"), "below"))
    probes = (tumbling(window)(rows, "timestamp").select(F.col("window_end").alias("v")).distinct()
              .select("v", F.lit(0).alias("mark"), F.lit(None).cast(marks.schema["below"].dataType).alias("below")))
    scanned = running_scan(marks.unionByName(probes), [], ["v", "mark"], [Measure("j", "max", F.col("below"))],
                           chunk=floor_div("v", step_ms * TICKS_PER_SCAN_CHUNK))
    ends = scanned.filter(F.col("mark") == 0).select(
        F.col("v").alias("window_end"), F.col("j.tick").alias("j"), F.col("j.x").alias("hi"), F.col("j.wm_next").alias("final_wm"))
    opened = windows.join(ends, "window_end").join(numbered.select(F.col("tick").alias("f"), (F.col("x") + 1).alias("lo")), "f")

    # One generated row per firing: the crossings, and number 0 for the final one.
    numbers = F.concat(F.when(F.col("lo") <= F.col("hi"), F.sequence("lo", "hi")).otherwise(F.array().cast("array<long>")),
                       F.array(F.lit(0).cast("long")))
    crossings = numbered.filter("crosses").select(F.col("x").alias("number"), F.col("tick").alias("at"), F.col("wm").alias("wm_at"))
    last = rows.agg(F.max("tick")).scalar()
    closed = F.when(F.col("j") < last, F.col("final_wm")).otherwise(F.col("window_end"))
    firings = (opened.select(key, "window_end", closed.alias("closed"), F.explode(numbers).alias("number"))
               .join(crossings, "number", "left")
               .select(key, "window_end", F.coalesce("at", F.lit(_AT_END)).alias("tick"),
                       F.when(F.col("number") == 0, F.col("closed")).otherwise(F.col("wm_at")).alias("eval_time"),
                       F.lit(0).alias("rank"), F.lit(None).cast("long").alias("n")))

    # cnt of a firing at tick k = on-time rows of the window with tick < k.
    data = per_tick.select(key, "window_end", "tick", F.lit(None).cast("long").alias("eval_time"), F.lit(1).alias("rank"), "n")
    w = Window.partitionBy(key, "window_end").orderBy("tick", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = firings.unionByName(data).withColumn("cnt", F.coalesce(F.sum("n").over(w), F.lit(0)))
    return counted.filter(F.col("rank") == 0).select(key, "window_end", "eval_time", F.col("cnt").cast("long"))
