"""Windows on streams with a pluggable assigner, trigger and content.

* The *assigner* is the batch forms' (:mod:`thermoflux.operators.windows`): a function that
  gives each row its window, or several by exploding, before the keyed state.
* A :class:`Trigger` decides when a window fires: for each block of new elements, and at each
  time it registered.  It answers with a :class:`Decision`.
* The *content* is an :class:`~thermoflux.operators.contents.Accumulator`, kept as one typed
  state per window, or a :class:`~thermoflux.operators.contents.WindowFunction`, for which
  the rows are kept as Arrow parts, one for each batch that has rows of the window.

Lateness is judged per window: a window takes rows until the watermark passes its end plus the
allowed lateness; then its content and its trigger's state go.  Rows of a window that is gone
may be given out as ``late``.

State and timers: times at which windows are due lie in an index by time, so a batch reads
the windows that it has rows for and those that are due, and no other; one Spark timer per
key stands at the least of these times.  Spark hands over rows before expired timers, so due
windows fire first (watermark first, then data).
"""

from __future__ import annotations

import enum
import heapq
import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from thermoflux.operators.contents import Accumulator, Span, WindowFunction, arrow_schema
from thermoflux.operators.windows import Assigner, keyed, tumbling
from thermoflux.streaming.processors import _concat, _watermark
from thermoflux.streaming.sources import EVENT_TIME, with_event_time


class Decision(enum.Flag):
    CONTINUE = 0
    FIRE = enum.auto()
    PURGE = enum.auto()
    FIRE_AND_PURGE = FIRE | PURGE


class TriggerContext:
    """What a trigger sees of one window: the watermark (None: none yet), a dict of its own
    that is kept with the window, and timers on event time."""

    def __init__(self, watermark: int | None, state: dict, register) -> None:
        self.watermark, self.state, self._register = watermark, state, register

    def register(self, time: int) -> None:
        self._register(int(time))


class Trigger:
    """Decides when a window fires.  Subclasses override what they need."""

    def on_elements(self, count: int, span: Span, ctx: TriggerContext) -> Iterable[tuple[int, Decision]]:
        """``count`` new elements, in order: yield (elements so far, decision) wherever
        something is to happen.  A time registered here fires when the watermark reaches it."""
        return ()

    def on_event_time(self, time: int, span: Span, ctx: TriggerContext) -> Decision:
        return Decision.CONTINUE

    def clear(self, span: Span, ctx: TriggerContext) -> None:
        """The window goes."""


class EventTime(Trigger):
    """The default: fires when the watermark passes the window's end, and again for each
    element that comes later and is still allowed."""

    def on_elements(self, count, span, ctx):
        if ctx.watermark is not None and span.end <= ctx.watermark:
            for n in range(1, count + 1):
                yield n, Decision.FIRE
        elif "set" not in ctx.state:
            ctx.state["set"] = 1
            ctx.register(span.end)

    def on_event_time(self, time, span, ctx):
        return Decision.FIRE if time == span.end else Decision.CONTINUE


class EarlyFiring(Trigger):
    """Fires each time the watermark crosses a whole ``step_ms`` while the window is open, and
    fires and purges at its end."""

    FIRST_WATERMARK = 1   # a time here comes due with the first finite watermark

    def __init__(self, step_ms: int) -> None:
        self.step_ms = int(step_ms)

    def _next(self, span: Span, watermark: int | None) -> int:
        return self.FIRST_WATERMARK if watermark is None else min((watermark // self.step_ms + 1) * self.step_ms, span.end)

    def on_elements(self, count, span, ctx):
        if "next" not in ctx.state:
            ctx.state["next"] = self._next(span, ctx.watermark)
            ctx.register(ctx.state["next"])
        return ()

    def on_event_time(self, time, span, ctx):
        if time != ctx.state.get("next"):
            return Decision.CONTINUE
        if ctx.watermark >= span.end:
            return Decision.FIRE_AND_PURGE
        ctx.state["next"] = self._next(span, ctx.watermark)
        ctx.register(ctx.state["next"])
        return Decision.FIRE


class CountOrTime(Trigger):
    """Fires and purges after each ``count`` elements, or at the window's end with what is left."""

    def __init__(self, count: int) -> None:
        self.count = int(count)

    def on_elements(self, count, span, ctx):
        seen = ctx.state.get("seen", 0)
        if "seen" not in ctx.state:
            ctx.register(span.end)
        for n in range(self.count - seen, count + 1, self.count):
            ctx.state["seen"] = 0
            yield n, Decision.FIRE_AND_PURGE
        ctx.state["seen"] = (seen + count) % self.count

    def on_event_time(self, time, span, ctx):
        ctx.state["seen"] = 0
        return Decision.FIRE_AND_PURGE if time == span.end else Decision.CONTINUE


class _Window:
    """One window's entry while it is worked on."""

    def __init__(self, span: Span, held: tuple | None) -> None:
        self.span = span
        self.rows, self.parts, self.firing, state, *self.acc = held or (0, 0, 0, "{}")
        self.state = json.loads(state)


class WindowProcessor(StatefulProcessor):
    """Keyed windows; see :func:`stream_windows`."""

    def __init__(self, key_types: dict[str, str], row_ddl: str, content: Accumulator | WindowFunction, trigger: Trigger,
                 lateness_ms: int = 0, order: Sequence[str] = (), late_output: bool = False) -> None:
        self.keys, self.content, self.trigger = list(key_types), content, trigger
        self.lateness_ms, self.order, self.late_output = int(lateness_ms), list(order), late_output
        head = [f"`{k}` {t}" for k, t in key_types.items()] + ["window_start long", "window_end long", "eval_time long", "firing long"]
        rows = StructType.fromDDL(row_ddl)
        late = [f"`late_{f.name}` {f.dataType.simpleString()}" for f in rows] if late_output else []
        self.output = ", ".join(["tag string", *head, content.OUTPUT, *late])
        # Parsed here, on the driver: workers have no session to parse with.
        self.row_schema, self.out_schema, self.content_schema = arrow_schema(row_ddl), arrow_schema(self.output), arrow_schema(content.OUTPUT)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.folds = isinstance(self.content, Accumulator)
        acc = f", {self.content.STATE}" if self.folds else ""
        bounds = "window_start long, window_end long"
        self.windows = handle.getMapState("windows", bounds, f"rows long, parts long, firing long, trigger string{acc}")
        self.parts = handle.getMapState("parts", f"{bounds}, part long", "data binary")
        self.due = handle.getMapState("due", "at long", "spans binary")
        self.next = handle.getValueState("next", "at long")

    # -- the index of due times ------------------------------------------------------------
    def _put(self, at: int, span: Span) -> None:
        held = self.due.getValue((at,))
        pairs = bytes(held[0]) if held is not None else b""
        own = np.array(span, np.int64).tobytes()
        if own not in [pairs[i:i + 16] for i in range(0, len(pairs), 16)]:
            self.due.updateValue((at,), (pairs + own,))
        if at not in self.times:
            self.times.add(at)
            heapq.heappush(self.waiting, at)

    def _begin(self, key: tuple, wm: int | None) -> None:
        self.key, self.wm, self.out, self.late = key, wm, [], []
        first = int(self.next.get()[0]) if self.next.exists() else None
        self.first, self.times, self.waiting, self.walked = first, set(), [], False
        if first is not None and wm is not None and first <= wm:
            self.times = {int(t) for (t,) in self.due.keys()}
            self.waiting = sorted(self.times)
            self.walked = True
            while self.waiting and self.waiting[0] <= wm:
                self._run(heapq.heappop(self.waiting))

    def _run(self, at: int) -> None:
        self.times.discard(at)
        pairs = np.frombuffer(bytes(self.due.getValue((at,))[0]), np.int64).reshape(-1, 2)
        self.due.removeKey((at,))
        for start, end in pairs.tolist():
            span = Span(start, end)
            held = self.windows.getValue(span)
            if held is None:
                continue
            window = _Window(span, held)
            self._decide(window, self.trigger.on_event_time(at, span, self._context(window)))
            if end + self.lateness_ms <= self.wm:
                self.trigger.clear(span, self._context(window))
                self._purge(window)
                self.windows.removeKey(span)
            else:
                self._save(window)

    def _end(self) -> Iterator[pd.DataFrame]:
        # Registered in this call: times above; what stood before is the old least, unless it was walked.
        left = list(self.times) + ([] if self.walked or self.first is None else [self.first])
        least = min(left, default=None)
        if least != self.first:
            if self.first is not None:
                self.handle.deleteTimer(self.first)
            if least is None:
                self.next.clear()
            else:
                self.handle.registerTimer(least)
                self.next.update((least,))
        if self.out or self.late:
            yield pa.concat_tables([*self.out, *self.late]).combine_chunks().to_pandas(types_mapper=pd.ArrowDtype)

    # -- windows ---------------------------------------------------------------------------
    def _context(self, window: _Window) -> TriggerContext:
        return TriggerContext(self.wm, window.state, lambda at: self._put(at, window.span))

    def _save(self, window: _Window) -> None:
        self.windows.updateValue(window.span, (window.rows, window.parts, window.firing, json.dumps(window.state), *window.acc))

    def _purge(self, window: _Window) -> None:
        for n in range(window.parts):
            self.parts.removeKey((*window.span, n))
        window.rows, window.parts = 0, 0
        window.acc = list(self.content.create()) if self.folds else []

    def _add(self, window: _Window, rows: pd.DataFrame) -> None:
        if not len(rows):
            return
        window.rows += len(rows)
        if self.folds:
            window.acc = list(self.content.add(tuple(window.acc) or self.content.create(), rows))
            return
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.row_schema) as writer:
            writer.write_table(pa.Table.from_pandas(rows[self.row_schema.names], self.row_schema, preserve_index=False))
        self.parts.updateValue((*window.span, window.parts), (sink.getvalue().to_pybytes(),))
        window.parts += 1

    def _decide(self, window: _Window, decision: Decision) -> None:
        if Decision.FIRE in decision and window.rows:
            if self.folds:
                values = self.content.finish(tuple(window.acc))
                made = pa.table([pa.array([v], f.type, from_pandas=False) for v, f in zip(values, self.content_schema, strict=True)], schema=self.content_schema)
            else:
                parts = [pa.ipc.open_stream(bytes(self.parts.getValue((*window.span, n))[0])).read_all() for n in range(window.parts)]
                made = self.content(self.key, window.span, pa.concat_tables(parts), self.content_schema)
            self._emit("window", window.span, window.firing, made, None)
            window.firing += 1
        if Decision.PURGE in decision:
            self._purge(window)

    def _emit(self, tag: str, span: Span, firing: int | None, made: pa.Table | None, late: pa.Table | None) -> None:
        n = len(made if made is not None else late)
        fixed = {"tag": tag, **dict(zip(self.keys, self.key, strict=True)), "window_start": span.start, "window_end": span.end,
                 "eval_time": self.wm, "firing": firing}
        columns = []
        for f in self.out_schema:
            if f.name in fixed:
                columns.append(pa.array([fixed[f.name]] * n, f.type))
            elif made is not None and f.name in made.column_names:
                columns.append(made[f.name])
            elif late is not None and f.name.removeprefix("late_") in late.column_names and f.name.startswith("late_"):
                columns.append(late[f.name.removeprefix("late_")].cast(f.type))
            else:
                columns.append(pa.nulls(n, f.type))
        (self.late if late is not None else self.out).append(pa.table(columns, schema=self.out_schema))

    def _take(self, frame: pd.DataFrame) -> None:
        if self.order:
            frame = frame.sort_values(self.order, kind="stable")
        for (start, end), rows in frame.groupby(["window_start", "window_end"], sort=True):
            span = Span(int(start), int(end))
            if self.wm is not None and span.end + self.lateness_ms <= self.wm:
                rows = rows[rows["last_end"] == span.end] if "last_end" in rows else rows
                if self.late_output and len(rows):
                    self._emit("late", span, None, None, pa.Table.from_pandas(rows[self.row_schema.names], self.row_schema, preserve_index=False))
                continue
            held = self.windows.getValue(span)
            window = _Window(span, held)
            if held is None:
                window.acc = list(self.content.create()) if self.folds else []
                self._put(span.end + self.lateness_ms, span)     # cleared then
            at = 0
            for upto, decision in self.trigger.on_elements(len(rows), span, self._context(window)):
                self._add(window, rows.iloc[at:upto])
                at = upto
                self._decide(window, decision)
            self._add(window, rows.iloc[at:])
            self._save(window)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._begin(key, _watermark(timerValues))
        frame = _concat(rows)
        if not frame.empty:
            self._take(frame)
        yield from self._end()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._begin(key, _watermark(timerValues))
        yield from self._end()

    def close(self) -> None:
        pass


def stream_windows(rows: DataFrame, window: int | Assigner, content: Accumulator | WindowFunction, delay_ms: int,
                   keys: Sequence[str | Column] = ("id",), trigger: Trigger | None = None, lateness_ms: int = 0,
                   ts_col: str = "timestamp", order: Sequence[str] = (), late_output: bool = False) -> DataFrame:
    """Windows of a stream → ``tag`` (``window``; ``late`` with ``late_output``), the keys,
    ``window_start``, ``window_end``, ``eval_time`` (the watermark at the firing), ``firing``
    (0 for a window's first), the content's output, and a late row's columns as ``late_*``.

    ``keys`` are columns or named expressions; ``order`` sorts a batch's rows of a key.  The
    watermarked column is dropped so that late rows reach the processor, which judges them."""
    plain = rows.columns
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    with_keys, names = keyed(with_event_time(rows, delay_ms, ts_col).drop(EVENT_TIME), keys)
    assigned = tumbling(window)(with_keys, ts_col)
    key_types = {k: assigned.schema[k].dataType.simpleString() for k in names}
    processor = WindowProcessor(key_types, ", ".join(f"`{c}` {types[c]}" for c in plain), content, trigger or EventTime(), lateness_ms, order, late_output)
    return assigned.groupBy(*names).transformWithStateInPandas(processor, processor.output, "append", "EventTime")
