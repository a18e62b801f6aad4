"""Stateful processors for ``groupBy(key).transformWithStateInPandas``.

Each processor sees, per micro-batch and key, the key's new rows as Arrow
batches (pandas) plus its keyed state in the RocksDB state store.  Work inside
a key is vectorised with numpy/pandas where the semantics allow.

Conventions shared with the batch forms:

* rows of one key are ordered inside a batch (``seq`` or ``(timestamp,
  src_rank, event_id)``); across batches the input must not run ahead of
  itself (true for a source replayed in event-time order);
* the watermark of a batch is the one left by the previous batch.  Spark's own
  watermark starts at 0 and never goes below, so 0 means −∞, and streams of
  event times before 1970 have no watermark in Spark at all;
* rows are handled before the batch's expired timers, so due firings are
  flushed at the start of ``handleInputRows`` (watermark first, then data).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from thermoflux.operators.contents import Reduce, arrow_schema
from thermoflux.schema import SMOKE_HIGH, SMOKE_LOW


def _concat(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    return frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)


def _watermark(timer_values) -> int | None:
    wm = timer_values.getCurrentWatermarkInMs()
    return wm if wm is not None and wm > 0 else None


class RollingSum(StatefulProcessor):
    """``keyBy(k).sum(v)``: running sum of ``v``; ``c`` keeps the key's first value.  Rows come
    as ``(event_id, k, v, c)``, whatever their columns are called outside.

    ``ttl_ms`` optionally expires idle keys' state (the reference keeps it forever)."""

    OUTPUT = "event_id long, k long, v long, c long"

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "total long, first_c long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows)
        if pdf.empty:
            return
        pdf = pdf.sort_values("event_id", kind="stable")
        if self.acc.exists():
            total, first_c = self.acc.get()
        else:
            total, first_c = 0, pdf["c"].iloc[0]
        first_c = None if pd.isna(first_c) else int(first_c)       # the first row's value, even null
        cum = pdf["v"].to_numpy(dtype=np.int64).cumsum() + int(total)
        self.acc.update((int(cum[-1]), first_c))
        yield pd.DataFrame({"event_id": pdf["event_id"].to_numpy(), "k": key[0], "v": cum,
                            "c": pd.array([first_c] * len(pdf), dtype="Int64")})

    def close(self) -> None:
        pass


class RollingReduce(StatefulProcessor):
    """A user's rolling reduce (:class:`~thermoflux.operators.contents.Reduce`): for each row, in
    the order of ``seq``, the record reduced so far.  The function runs once for each row."""

    def __init__(self, content: Reduce, key_types: dict[str, str], seq: str, seq_type: str, ttl_ms: int | None = None) -> None:
        self.content, self.keys, self.seq, self.ttl_ms = content, list(key_types), seq, ttl_ms
        self.output = ", ".join([f"`{seq}` {seq_type}", *(f"`{k}` {t}" for k, t in key_types.items()), content.OUTPUT])
        self.schema = arrow_schema(self.output)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", self.content.STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows)
        if pdf.empty:
            return
        pdf = pdf.sort_values(self.seq, kind="stable")
        state = tuple(self.held.get()) if self.held.exists() else self.content.create()
        made = []
        for n in range(len(pdf)):
            state = self.content.add(state, pdf.iloc[n:n + 1])
            made.append(state)
        self.held.update(state)
        columns = [pdf[self.seq].tolist(), *([k] * len(pdf) for k in key), *zip(*made, strict=True)]
        yield pa.table([pa.array(list(c), f.type, from_pandas=False) for c, f in zip(columns, self.schema, strict=True)],
                       schema=self.schema).to_pandas(types_mapper=pd.ArrowDtype)

    def close(self) -> None:
        pass


class RollingMax(StatefulProcessor):
    """Rolling ``reduce`` keeping the hottest reading so far (a tie takes the newer one; a NaN
    always replaces the held reading and is replaced by the next, as comparisons with it fail)."""

    OUTPUT = "event_id long, id string, timestamp long, temperature double"

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "t double, ts long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows)
        if pdf.empty:
            return
        pdf = pdf.sort_values("event_id", kind="stable")
        t = pdf["temperature"].to_numpy(dtype=float)
        ts = pdf["timestamp"].to_numpy(dtype=np.int64)
        seeded = self.best.exists()
        if seeded:
            t0, ts0 = self.best.get()
            t0 = np.nan if t0 is None else t0
            t, ts = np.concatenate([[t0], t]), np.concatenate([[ts0], ts])
        idx = np.arange(len(t))
        # Each NaN stands alone and the search begins anew behind it.
        edges = np.flatnonzero(np.isnan(t)).tolist()
        for lo, hi in zip([-1, *edges], [*edges, len(t)]):
            part = t[lo + 1:hi]
            if len(part):
                running = np.maximum.accumulate(part)
                # A row is the new arg-max when it reaches the running max (ties → newer row).
                idx[lo + 1:hi] = lo + 1 + np.maximum.accumulate(np.where(part >= running, np.arange(len(part)), 0))
        if seeded:
            idx = idx[1:]
        self.best.update((float(t[idx[-1]]), int(ts[idx[-1]])))
        yield pd.DataFrame({"event_id": pdf["event_id"].to_numpy(), "id": key[0],
                            "timestamp": ts[idx], "temperature": t[idx]})

    def close(self) -> None:
        pass


class _WatermarkBuffer(StatefulProcessor):
    """Holds a key's rows until the watermark passes them, then hands them over in
    ``(timestamp, src_rank, event_id)`` order.

    Rows older than the watermark are dropped by Spark before they reach the
    processor (the event-time column is in the input), so once ``timestamp < wm``
    no earlier row of either input can still arrive: the released prefix is final
    and the result does not depend on how rows were split into micro-batches.
    A timer at the oldest pending row flushes keys that receive no new rows.

    Pending rows lie in time buckets of ``bucket_ms``.  A batch appends one Arrow part to
    each bucket that it has rows for and reads only buckets that are due, so its state
    traffic follows its own rows and the released ones, not all that is pending.
    """

    ARROW = pa.schema([])
    ORDER = ["timestamp", "src_rank", "event_id"]

    def __init__(self, bucket_ms: int = 1000) -> None:
        self.bucket_ms = max(1, int(bucket_ms))

    def _init_buffer(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "bucket long, part long", "data binary")
        # One small entry per pending bucket: at most about delay / bucket_ms of them.
        self.index = handle.getMapState("index", "bucket long", "parts long, oldest long")

    def _append(self, rows: pd.DataFrame, index: dict[int, tuple[int, int]]) -> None:
        for bucket, part in rows.groupby(rows["timestamp"].to_numpy(dtype=np.int64) // self.bucket_ms):
            bucket = int(bucket)
            n, oldest = index.get(bucket, (0, None))
            least = int(part["timestamp"].min())
            index[bucket] = (n + 1, least if oldest is None else min(least, oldest))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.ARROW) as writer:
                writer.write_table(pa.Table.from_pandas(part[self.ARROW.names], self.ARROW, preserve_index=False))
            self.parts.updateValue((bucket, n), (sink.getvalue().to_pybytes(),))
            self.index.updateValue((bucket,), index[bucket])

    def _take(self, bucket: int, index: dict[int, tuple[int, int]]) -> list[pd.DataFrame]:
        out = []
        for n in range(index.pop(bucket)[0]):
            out.append(pa.ipc.open_stream(bytes(self.parts.getValue((bucket, n))[0])).read_pandas())
            self.parts.removeKey((bucket, n))
        self.index.removeKey((bucket,))
        return out

    def _due(self, new: pd.DataFrame | None, wm: int | None) -> pd.DataFrame:
        index = {int(b): (int(n), int(t)) for (b,), (n, t) in self.index.iterator()}
        timer = min((t for _, t in index.values()), default=None)
        empty = self.ARROW.empty_table().to_pandas()
        frames = []
        for bucket in [b for b, (_, t) in index.items() if wm is not None and t < wm]:
            frames += self._take(bucket, index)
        if new is not None and len(new):
            frames.append(new[self.ARROW.names])
        rows = pd.concat(frames, ignore_index=True) if frames else empty
        late = rows["timestamp"].to_numpy(dtype=np.int64) < wm if wm is not None else np.zeros(len(rows), dtype=bool)
        if not late.all():
            self._append(rows[~late], index)
        self.oldest = min((t for _, t in index.values()), default=None)
        self.moved = self.oldest != timer or (timer is not None and wm is not None and timer < wm)
        return rows[late].sort_values(self.ORDER, kind="stable")

    def _sync(self, own: set[int]) -> None:
        """One Spark timer behind the oldest pending row, and the subclass's own."""
        if not self.moved and not own and not self.owned:
            return
        wanted = own | ({self.oldest + 1} if self.oldest is not None else set())
        standing = set(self.handle.listTimers())
        for t in standing - wanted:
            self.handle.deleteTimer(t)
        for t in wanted - standing:
            self.handle.registerTimer(t)

    def _more_timers(self) -> set[int]:
        return set()

    def _load(self) -> None:
        pass

    def _apply(self, key: tuple, due: pd.DataFrame, wm: int | None) -> pd.DataFrame:
        raise NotImplementedError

    def _handle(self, key: tuple, new: pd.DataFrame | None, wm: int | None) -> Iterator[pd.DataFrame]:
        self._load()
        self.owned = bool(self._more_timers())
        out = self._apply(key, self._due(new, wm), wm)
        self._sync(self._more_timers())
        if len(out):
            yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._handle(key, _concat(rows), _watermark(timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._handle(key, None, _watermark(timerValues))

    def close(self) -> None:
        pass


class ConnectedProcessor(_WatermarkBuffer):
    """Two connected streams with shared keyed state and timers, open to user code.

    Rows of both sides are buffered until the watermark passes them and handed over in
    ``(timestamp, src_rank, event_id)`` order, ``src_rank`` 0 being the control (left) side.
    A subclass sets ``OUTPUT`` and, in ``STATE``, its value states (name → DDL); and overrides
    either :meth:`on_rows`, which gets a whole block, or :meth:`on_row` and :meth:`on_timer`,
    which are called one by one in event-time order, a timer before the rows of its time.

    ``self.states`` holds the value states of the current key; ``set_timer`` registers an
    event-time timer that comes due in order with the rows.  See
    :func:`thermoflux.streaming.operators.stream_connected` for building the input.
    """

    OUTPUT = ""
    STATE: dict[str, str] = {}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._init_buffer(handle)
        self.states = {name: handle.getValueState(name, ddl) for name, ddl in self.STATE.items()}
        self.due_times = handle.getMapState("due_times", "at long", "set boolean")

    def set_timer(self, at: int) -> None:
        if int(at) not in self._times:
            self._times.add(int(at))
            heapq.heappush(self._heap, int(at))
            self.due_times.updateValue((int(at),), (True,))

    def delete_timer(self, at: int) -> None:
        if int(at) in self._times:
            self._times.discard(int(at))
            self.due_times.removeKey((int(at),))

    def _next_timer(self, watermark: int | None) -> int | None:
        while self._heap and self._heap[0] not in self._times:   # deleted since
            heapq.heappop(self._heap)
        return self._heap[0] if self._heap and watermark is not None and self._heap[0] <= watermark else None

    def on_rows(self, key: tuple, rows: pd.DataFrame, watermark: int | None) -> pd.DataFrame | list[tuple]:
        """The key's due rows of both sides, in order.  By default :meth:`on_row` and
        :meth:`on_timer` are called for each, in order of time."""
        out: list[tuple] = []
        todo = rows.itertuples(index=False)
        row = next(todo, None)
        while True:
            timer = self._next_timer(watermark)
            if timer is not None and (row is None or timer <= row.timestamp):
                self.delete_timer(timer)
                out.extend(self.on_timer(key, timer, watermark))
            elif row is not None:
                out.extend(self.on_row(key, row, watermark))
                row = next(todo, None)
            else:
                return out

    @property
    def uses_timers(self) -> bool:
        return type(self).on_timer is not ConnectedProcessor.on_timer

    def on_row(self, key: tuple, row, watermark: int | None) -> list[tuple]:
        return []

    def on_timer(self, key: tuple, time: int, watermark: int | None) -> list[tuple]:
        return []

    def _more_timers(self) -> set[int]:
        return set(self._times)

    def _load(self) -> None:
        self._times = {int(t) for (t,) in self.due_times.keys()} if self.uses_timers else set()
        self._heap = sorted(self._times)

    def _apply(self, key: tuple, due: pd.DataFrame, wm: int | None) -> pd.DataFrame:
        made = self.on_rows(key, due, wm)
        if isinstance(made, list):
            names = [c.split()[0].strip("`") for c in self.OUTPUT.split(", ")]
            made = pd.DataFrame(made, columns=names)
        return made


class ReadingFilter(ConnectedProcessor):
    """Forwarding switch per sensor.

    Input: readings (``src_rank`` 1) and switches (``src_rank`` 0, ``expiry`` =
    switch time + duration) of one sensor.  State: the latest expiry, cleared once
    the watermark passes it (no later row could be forwarded by it).
    """

    OUTPUT = "event_id long, id string, timestamp long, temperature double"
    STATE = {"open_until": "ms long"}
    ARROW = pa.schema([("event_id", pa.int64()), ("id", pa.string()), ("timestamp", pa.int64()),
                       ("temperature", pa.float64()), ("expiry", pa.int64()), ("src_rank", pa.int32())])

    def on_rows(self, key: tuple, rows: pd.DataFrame, watermark: int | None) -> pd.DataFrame:
        held = self.states["open_until"]
        old = held.get()[0] if held.exists() else None
        out = rows.iloc[0:0]
        if len(rows):
            expiry = pd.to_numeric(rows["expiry"], errors="coerce").to_numpy(dtype=float)
            seed = np.nan if old is None else float(old)
            running = np.fmax.accumulate(np.concatenate([[seed], expiry]))[1:]
            out = rows.loc[(rows["src_rank"].to_numpy() == 1) & (running > rows["timestamp"].to_numpy(dtype=np.int64))]
            if not np.isnan(running[-1]):
                old = int(running[-1])
                held.update((old,))
        if old is not None and watermark is not None and old <= watermark:
            held.clear()
        return out[["event_id", "id", "timestamp", "temperature"]]


class SmokeAlert(ConnectedProcessor):
    """Latest smoke level per shard; readings above the threshold alert while it is HIGH.

    Input per shard: the shard's readings (``src_rank`` 1) and every smoke row
    (``src_rank`` 0, fanned out to all shards).
    """

    OUTPUT = "event_id long, id string, timestamp long, temperature double"
    STATE = {"level": "level string"}
    ARROW = pa.schema([("event_id", pa.int64()), ("id", pa.string()), ("timestamp", pa.int64()),
                       ("temperature", pa.float64()), ("level", pa.string()), ("src_rank", pa.int32())])

    def on_rows(self, key: tuple, rows: pd.DataFrame, watermark: int | None) -> pd.DataFrame:
        if not len(rows):
            return rows[["event_id", "id", "timestamp", "temperature"]]
        held = self.states["level"]
        seed = held.get()[0] if held.exists() else SMOKE_LOW
        levels = pd.concat([pd.Series([seed], dtype=object), rows["level"].reset_index(drop=True).astype(object)],
                           ignore_index=True).ffill()
        held.update((str(levels.iloc[-1]),))
        alert = (rows["src_rank"].to_numpy() == 1) & (levels.iloc[1:].to_numpy() == SMOKE_HIGH)
        return rows.loc[alert, ["event_id", "id", "timestamp", "temperature"]]


class LateReadingSplit(StatefulProcessor):
    """Per-record late split before any window: ``timestamp < currentWatermark`` goes to
    the ``late`` output, everything else to ``main`` (no state; needs the watermark).
    The reference's watermark is one ms below Spark's, hence ``timestamp < wm - 1``.
    The input must not contain the watermarked column (late rows must reach it)."""

    OUTPUT = "tag string, event_id long, id string, timestamp long, temperature double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = _watermark(timerValues)
        for pdf in rows:
            if not len(pdf):
                continue
            ts = pdf["timestamp"].to_numpy(dtype=np.int64)
            late = (ts < wm - 1) if wm is not None else np.zeros(len(pdf), dtype=bool)
            out = pdf[["event_id", "id", "timestamp", "temperature"]].copy()
            out.insert(0, "tag", np.where(late, "late", "main"))
            yield out

    def close(self) -> None:
        pass


class WallClockReadingFilter(StatefulProcessor):
    """The reference's live switch: a switch opens forwarding for ``duration_ms`` from
    *now* (processing time); a later-expiring switch extends it and moves the timer, an
    earlier one is ignored; the processing-time timer clears the state.  Results depend
    on arrival times, so this form is for live use only (the replayable form is
    :class:`ReadingFilter`).  Input: readings (``src_rank`` 1) and switches
    (``src_rank`` 0, ``duration_ms``); the shuffle loses arrival order, so a batch's rows
    apply in the order of ``event_id``, a switch before a reading.  Spark hands over rows
    before expired timers, so a switch that has run out is closed first."""

    OUTPUT = "event_id long, id string, timestamp long, temperature double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", "ms long")     # set while forwarding

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        stored = int(self.timer.get()[0]) if self.timer.exists() else None
        timer = stored if stored is not None and stored > now else None
        pdf = _concat(rows)
        if not pdf.empty:
            pdf = pdf.sort_values(["event_id", "src_rank"], kind="stable")
            switch = (pdf["src_rank"] == 0).to_numpy()
            expiry = now + pd.to_numeric(pdf["duration_ms"], errors="coerce").to_numpy(dtype=float, na_value=np.nan)
            opens = switch & (expiry > now)
            enabled = (timer is not None) | np.logical_or.accumulate(opens)
            if opens.any():
                timer = max(int(expiry[opens].max()), timer or 0)
            out = pdf.loc[enabled & ~switch, ["event_id", "id", "timestamp", "temperature"]]
        else:
            out = pdf
        if timer != stored:
            if stored is not None:
                self.handle.deleteTimer(stored)
            if timer is None:
                self.timer.clear()
            else:
                self.handle.registerTimer(timer)
                self.timer.update((timer,))
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A timer that a newer switch has replaced must not close it.
        if self.timer.exists() and int(self.timer.get()[0]) <= timerValues.getCurrentProcessingTimeInMs():
            self.timer.clear()
        return iter(())

    def close(self) -> None:
        pass
