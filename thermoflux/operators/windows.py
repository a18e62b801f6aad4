"""Tumbling event-time window aggregates (batch forms).

Each is one ``groupBy(key, window)`` hash aggregate: Spark does the partial
(map-side) aggregation before the shuffle, so only one row per
``(task, key, window)`` crosses the network — the incremental reduce of the
reference, for free.  Window bounds are LONG arithmetic (epoch-aligned floor).

Every operator takes the key and value columns, and as ``window`` a size in ms or
any *assigner*: a function (rows, time column) → rows with ``window_start`` and
``window_end``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoflux.functions.temporal import window_end
from thermoflux.functions.text import fahrenheit_to_celsius
from thermoflux.operators.contents import Accumulator, Span, WindowFunction, arrow_schema

Assigner = Callable[[DataFrame, str], DataFrame]


def assign_tumbling(df: DataFrame, size_ms: int, ts_col: str = "timestamp") -> DataFrame:
    """Custom assigner: one aligned window per element → ``window_start, window_end``."""
    end = window_end(ts_col, size_ms)
    return df.withColumn("window_end", end).withColumn("window_start", F.col("window_end") - F.lit(size_ms))


def sliding(size_ms: int, slide_ms: int) -> Assigner:
    """Overlapping windows of ``size_ms``, one every ``slide_ms``: each element lies in all that
    hold its time.  Besides the bounds each row carries ``last_end``, the end of its latest window."""
    def assign(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
        last = F.col(ts_col) - F.pmod(F.col(ts_col), F.lit(slide_ms))
        starts = F.filter(F.transform(F.sequence(F.lit(0), F.lit((size_ms - 1) // slide_ms)), lambda k: last - k.cast("long") * F.lit(slide_ms)),
                          lambda s: s + F.lit(size_ms) > F.col(ts_col))
        return (df.withColumn("window_start", F.explode(starts)).withColumn("window_end", F.col("window_start") + F.lit(size_ms))
                .withColumn("last_end", last + F.lit(size_ms)))
    return assign


def tumbling(window: int | Assigner) -> Assigner:
    """The assigner itself, or the tumbling one of a size in ms."""
    if callable(window):
        return window
    return lambda df, ts_col="timestamp": assign_tumbling(df, window, ts_col)


def aggregate(df: DataFrame, window: int | Assigner, *aggs: Column, key: str = "id", ts_col: str = "timestamp") -> DataFrame:
    """Any aggregates per (key, window) → ``key, window_end`` and one column each."""
    return tumbling(window)(df, ts_col).groupBy(key, "window_end").agg(*aggs)


def nan_safe(agg: Callable[[Column], Column], col: str) -> Column:
    """Java Math.min/max propagate NaN; Spark's min/max order NaN above +inf."""
    return F.when(F.max(F.isnan(F.col(col))), F.lit(float("nan"))).otherwise(agg(F.col(col)))


def avg_tumbling(df: DataFrame, window: int | Assigner, celsius: bool = True, key: str = "id", value: str = "temperature",
                 ts_col: str = "timestamp") -> DataFrame:
    """Mean value per (key, window); ``timestamp`` is the exclusive window end."""
    v = fahrenheit_to_celsius(value) if celsius else F.col(value)
    rows = df.select(key, ts_col, v.alias(value))
    return (aggregate(rows, window, F.avg(value).alias(value), key=key, ts_col=ts_col)
            .select(key, F.col("window_end").alias("timestamp"), value))


def minmax_tumbling(df: DataFrame, window: int | Assigner, key: str = "id", value: str = "temperature",
                    ts_col: str = "timestamp") -> DataFrame:
    """Min and max value per (key, window) with the window end → ``key, min, max, endTs``."""
    aggs = (nan_safe(F.min, value).alias("min"), nan_safe(F.max, value).alias("max"))
    return (aggregate(df.select(key, value, ts_col), window, *aggs, key=key, ts_col=ts_col)
            .select(key, "min", "max", F.col("window_end").alias("endTs")))


#: States that a task holds at once, and rounds of merging by how many parts.
HELD_STATES, MERGE_PARTS = 100_000, 64


def keyed(df: DataFrame, keys: Sequence[str | Column]) -> tuple[DataFrame, list[str]]:
    """``df`` with the key columns, and their names; a key is a column or a named expression."""
    names = df.select(*keys).columns
    return df.withColumns({n: k for n, k in zip(names, keys, strict=True) if isinstance(k, Column)}), names


def reduce_windows(df: DataFrame, window: int | Assigner, content: Accumulator, keys: Sequence[str | Column] = ("id",),
                   ts_col: str = "timestamp", merge_parts: int = MERGE_PARTS) -> DataFrame:
    """A user's accumulator per (keys, window) → the keys, ``window_start``, ``window_end`` and
    the accumulator's output.

    Each task folds its own rows first, so one state per (task, key, window) is shuffled;
    states are merged in ``merge_parts`` parts of each window and then once more, so a window
    that every task holds a state of is not merged by one task alone."""
    rows, names = keyed(tumbling(window)(df, ts_col), keys)
    group = [*names, "window_start", "window_end"]
    rows = rows.drop("last_end") if "last_end" in rows.columns else rows
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    bounds = ", ".join(f"`{c}` {fields[c]}" for c in group)
    state_ddl, out_ddl = f"{bounds}, {content.STATE}", f"{bounds}, {content.OUTPUT}"
    states, outputs = arrow_schema(state_ddl), arrow_schema(out_ddl)
    own = states.names[len(group):]

    def table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type, from_pandas=False) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            bound = list(zip(*(whole[c].to_pylist() for c in group), strict=True))
            at: dict[tuple, list[int]] = {}
            for i, k in enumerate(bound):
                at.setdefault(k, []).append(i)
            frame = whole.to_pandas(types_mapper=pd.ArrowDtype)
            for k, i in at.items():
                held[k] = content.add(held.get(k) or content.create(), frame.iloc[i])
            if len(held) > HELD_STATES:
                yield table([(*k, *v) for k, v in held.items()], states)
                held = {}
        if held:
            yield table([(*k, *v) for k, v in held.items()], states)

    def merged(finish: bool) -> Callable[[tuple, pa.Table], pa.Table]:
        def run(rows: pa.Table) -> pa.Table:
            bound = tuple(rows[c][0].as_py() for c in group)
            state = None
            for part in zip(*(rows[c].to_pylist() for c in own), strict=True):
                state = part if state is None else content.merge(state, part)
            return pa.Table.from_batches([table([(*bound, *(content.finish(state) if finish else state))], outputs if finish else states)])
        return run

    folded = rows.mapInArrow(partial, state_ddl)
    salted = folded.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(merge_parts)))
    once = salted.groupBy(*group, "_part").applyInArrow(merged(False), state_ddl)
    return once.groupBy(*group).applyInArrow(merged(True), out_ddl)


def apply_windows(df: DataFrame, window: int | Assigner, content: WindowFunction, keys: Sequence[str | Column] = ("id",),
                  ts_col: str = "timestamp") -> DataFrame:
    """A user's function over all rows of each (keys, window) → the keys, ``window_start``,
    ``window_end`` and the function's output.  The function sees the rows together, so they
    are one task's work: fold with :func:`reduce_windows` where an accumulator can do it."""
    plain = [c for c in df.columns]
    rows, names = keyed(tumbling(window)(df, ts_col), keys)
    group = [*names, "window_start", "window_end"]
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    ddl = ", ".join(f"`{c}` {fields[c]}" for c in group) + f", {content.OUTPUT}"
    bounds, own = arrow_schema(", ".join(f"`{c}` {fields[c]}" for c in group)), arrow_schema(content.OUTPUT)

    def run(rows: pa.Table) -> pa.Table:
        bound = [rows[c][0] for c in group]
        made = content(tuple(b.as_py() for b in bound[:-2]), Span(*(b.as_py() for b in bound[-2:])), rows.select(plain), own)
        fixed = [pa.array([b.as_py()] * len(made), f.type) for b, f in zip(bound, bounds, strict=True)]
        return pa.table([*fixed, *made.columns], names=[*group, *own.names])

    return rows.groupBy(*group).applyInArrow(run, ddl)
