"""Keyed running aggregates that stay parallel when one key is hot.

A rolling operator (running sum, running arg-max, "latest value so far") is a
prefix scan per key.  ``Window.partitionBy(key).orderBy(seq)`` puts every row
of a key into one task, so a key holding a third of the data would serialise a
third of the job.  ``running_scan`` splits only such keys:

1. rows per key are counted (a partial/final hash aggregate); a key with more
   than ``chunk_rows`` rows is *hot* and its own range of positions is cut into
   ``ceil(rows / chunk_rows)`` equal chunks — every other key is one chunk;
2. per (hot key, chunk) summary, and its exclusive prefix over the key's chunks:
   at most ``2 * rows / chunk_rows`` rows altogether, whatever the keys are;
3. one *carry row* holding that prefix is unioned in front of each later chunk
   of a hot key; one analytic window partitioned by ``(key, chunk)`` then yields
   the exact running value of every row.

One shuffle moves the data rows.  All combine functions are associative, so the
result does not depend on ``chunk_rows`` (the tests check bounds from 1 row up).
Nothing runs when the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ALL = "_tf_all"          # stands for the key when there is none
_CHUNK = "_tf_chunk"
_SIDE = "_tf_side"        # 0 = carry row, 1 = data row
_AT = "_tf_at"            # position that chunks are cut on
CHUNK_ROWS = 1 << 16


@dataclass(frozen=True)
class Measure:
    """One running aggregate: ``kind`` in sum | max | min | first | last.  ``first`` and
    ``last`` pass over nulls."""
    name: str
    kind: str
    expr: Column


def _summary(kind: str, v: Column, order: Column) -> Column:
    if kind in ("sum", "max", "min"):
        return getattr(F, kind)(v)
    if kind == "last":
        return F.max_by(v, F.when(v.isNotNull(), order))
    if kind == "first":
        return F.min_by(v, F.when(v.isNotNull(), order))
    raise ValueError(f"unknown running aggregate kind {kind!r}")


def _window_agg(kind: str, v: Column) -> Column:
    if kind in ("sum", "max", "min"):
        return getattr(F, kind)(v)
    return F.last(v, ignorenulls=True) if kind == "last" else F.first(v, ignorenulls=True)


def chunked(df: DataFrame, keys: Sequence[str], position: Column, chunk_rows: int) -> DataFrame:
    """``df`` with its chunk number (null for keys that are not hot) and position."""
    rows = df.withColumn(_AT, position)
    stats = [F.count(F.lit(1)).alias("_tf_n"), F.min(_AT).alias("_tf_lo"), F.max(_AT).alias("_tf_hi")]
    n, lo, hi = F.col("_tf_n"), F.col("_tf_lo"), F.col("_tf_hi")
    # The key's range of positions in as many equal parts as its rows need.
    width = F.greatest(F.lit(1), F.ceil((hi - lo + F.lit(1)) / F.ceil(n / F.lit(chunk_rows)))).cast("long")
    if list(keys) == [_ALL]:        # one group: its range is a scalar of the query, no join
        hot = rows.agg(*stats).filter(n > chunk_rows).select(F.struct(lo.alias("lo"), width.alias("width"))).scalar()
        lo, width = hot["lo"], hot["width"]
        return rows.withColumn(_CHUNK, F.call_function("div", F.coalesce(F.col(_AT), lo) - lo, width))
    hot = rows.groupBy(*keys).agg(*stats).filter(n > chunk_rows).select(*keys, lo, width.alias("_tf_width"))
    at = F.call_function("div", F.coalesce(_AT, "_tf_lo") - lo, F.col("_tf_width"))
    return rows.join(hot, list(keys), "left").withColumn(_CHUNK, at).drop("_tf_lo", "_tf_width")


def running_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[Measure],
                 position: Column | None = None, chunk_rows: int = CHUNK_ROWS, exclusive: bool = False,
                 chunk: Column | None = None) -> DataFrame:
    """Add one column per measure: its running aggregate per ``keys`` in ``order``.

    ``position`` is an integral column that does not decrease in ``order`` within a key,
    null for rows before all others (default: the first column of ``order``).
    ``exclusive`` leaves the current row out of its own value.  A null key is one chunk.
    ``chunk`` gives the chunk number outright, without counting, for tables with at most
    one row per position (ticks); it must not decrease in ``order`` within a key.
    """
    keys, order = list(keys), list(order)
    if not keys:
        df, keys = df.withColumn(_ALL, F.lit(0)), [_ALL]
    # A single ordering column keeps min_by/max_by buffers fixed-width, so the
    # partial aggregate stays a HashAggregate (a struct ordering forces a sort-based one).
    order_struct = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    vals = [f"_tf_v{i}" for i in range(len(measures))]
    rows = df.select("*", *[m.expr.alias(v) for m, v in zip(measures, vals)])
    if chunk is not None:
        rows = rows.withColumn(_CHUNK, chunk)
    else:
        rows = chunked(rows, keys, position if position is not None else F.col(order[0]), chunk_rows)

    # Chunk summaries of the hot keys and their exclusive prefix over the chunks of each.
    summ = rows.filter(F.col(_CHUNK).isNotNull()).groupBy(*keys, _CHUNK).agg(
        *[_summary(m.kind, F.col(v), order_struct).alias(v) for m, v in zip(measures, vals)])
    over_chunks = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*keys, _CHUNK, F.lag(_CHUNK).over(Window.partitionBy(*keys).orderBy(_CHUNK)).alias("_tf_before"),
                        *[_window_agg(m.kind, F.col(v)).over(over_chunks).alias(v) for m, v in zip(measures, vals)]) \
        .filter(F.col("_tf_before").isNotNull()).drop("_tf_before").withColumn(_SIDE, F.lit(0))

    # Carry row first, then the chunk's rows in order.
    both = rows.withColumn(_SIDE, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    frame_end = -1 if exclusive else Window.currentRow
    w = Window.partitionBy(*keys, _CHUNK).orderBy(_SIDE, *order).rowsBetween(Window.unboundedPreceding, frame_end)
    out = both.select("*", *[_window_agg(m.kind, F.col(v)).over(w).alias(m.name) for m, v in zip(measures, vals)])
    return out.filter(F.col(_SIDE) == 1).drop(_CHUNK, _SIDE, _AT, _ALL, *vals)
