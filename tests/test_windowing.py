"""Pluggable assigners, triggers, window contents and two-input processors: stream = batch."""

import glob
import os
import shutil
import statistics
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.replay_files import write_replay_files
from tests.test_streaming import _Handle, _Timer, _run, _same
from thermoflux.functions.temporal import floor_div
from thermoflux.operators import lateness, replay, windows
from thermoflux.operators.contents import Count, MinMax, Reduce, Span, WindowFunction
from thermoflux.schema import REPLAY_READING
from thermoflux.sources import fixtures as fx
from thermoflux.streaming import replay_stream, stream_connected, stream_windows
from thermoflux.streaming.processors import ConnectedProcessor
from thermoflux.streaming.sinks import start_parquet
from thermoflux.streaming.windowing import CountOrTime, Decision, EarlyFiring, EventTime, Trigger, WindowProcessor

K = fx.K_MS
CFG = fx.ReplayConfig(tick_units=30)


def nearest(a, b):
    """Of two records (event_id, temperature) the one nearer to 50, then of the smaller id."""
    return min(a, b, key=lambda r: (abs(r[1] - 50.0), r[0]))


NEAREST = Reduce(nearest, ("event_id", "temperature"), "event_id long, temperature double")


def median_of(key, span, rows: pa.Table):
    return {"median": [statistics.median(rows["temperature"].to_pylist())], "rows": [len(rows)], "size": [span.end - span.start], "who": ["/".join(map(str, key))]}


MEDIAN = WindowFunction(median_of, "median double, rows long, size long, who string")


@pytest.fixture(scope="module")
def scratch():
    return tempfile.mkdtemp(prefix="tf-win-", dir="/tmp")


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture(scope="module")
def late_replay(spark, scratch):
    rows = fx.arrival_readings(spark, SF_SMALL, CFG)
    path = os.path.join(scratch, "arrival")
    write_replay_files(rows.select("event_id", "id", "timestamp", "temperature", "arrival", "tick"), path)
    r, ticks = replay.replay(rows, CFG.delay_ms)
    return path, r, ticks, ticks.agg(F.max("wm")).first()[0]


@pytest.fixture(scope="module")
def time_replay(spark, scratch):
    rows = fx.readings(spark, SF_SMALL).withColumn("arrival", F.col("timestamp")).withColumn("tick", floor_div("timestamp", 30 * K))
    path = os.path.join(scratch, "bytime")
    write_replay_files(rows, path)
    return path, rows, rows.agg(F.max("timestamp")).first()[0] - 5 * K


def stream(spark, path):
    return replay_stream(spark, path, REPLAY_READING).drop("tick")


def test_default_trigger_equals_on_time_counts(spark, scratch, late_replay):
    path, r, ticks, wm_last = late_replay
    out = _run(spark, stream_windows(stream(spark, path), 10 * K, Count(), CFG.delay_ms), "w_default", scratch)
    batch = lateness.on_time_window_counts(r, ticks, 10 * K).filter(F.col("window_end") <= wm_last)
    assert out.count() > 0 and _same(out.select("id", "window_end", "cnt"), batch)
    assert out.filter("firing > 0 or eval_time < window_end").count() == 0


def test_count_or_time_trigger(spark, scratch, late_replay):
    path, _, _, _ = late_replay
    out = _run(spark, stream_windows(stream(spark, path), 30 * K, Count(), CFG.delay_ms, trigger=CountOrTime(3), order=("arrival", "event_id")), "w_count", scratch)
    rows = spark.read.parquet(path).select("id", "timestamp", "arrival", "event_id", "tick").collect()
    got = [(x.id, x.window_end, x.eval_time, x.cnt, x.firing) for x in out.collect()]
    want, held, fired, wm = [], {}, {}, None
    for tick in sorted({x.tick for x in rows}):
        for (i, e) in sorted(k for k in held if wm is not None and k[1] <= wm):
            if held[i, e]:
                want.append((i, e, wm, held[i, e], fired.get((i, e), 0)))
            del held[i, e]
        for x in sorted((x for x in rows if x.tick == tick), key=lambda x: (x.arrival, x.event_id)):
            k = x.id, x.timestamp - x.timestamp % (30 * K) + 30 * K
            if wm is not None and k[1] <= wm:
                continue
            held[k] = held.get(k, 0) + 1
            if held[k] == 3:
                want.append((*k, wm, 3, fired.get(k, 0)))
                fired[k] = fired.get(k, 0) + 1
                held[k] = 0
        wm = max([x.timestamp for x in rows if x.tick <= tick]) - CFG.delay_ms
    last = max(x[2] or 0 for x in got)
    for (i, e) in sorted(k for k in held if k[1] <= wm and held[k]):        # the batch without data
        if wm <= last:
            want.append((i, e, wm, held[i, e], fired.get((i, e), 0)))
    assert sum(c for *_, c, _ in got) > 400 and sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("name, window", [("thirty", lambda df, ts: windows.assign_tumbling(df, 30 * K, ts)), ("sliding", windows.sliding(10 * K, 4 * K))])
def test_assigners_with_an_accumulator(spark, scratch, time_replay, name, window):
    path, rows, wm_last = time_replay
    got = _run(spark, stream_windows(stream(spark, path), window, MinMax(), 5 * K), f"w_{name}", scratch)
    batch = windows.minmax_tumbling(rows, window).filter(F.col("endTs") <= wm_last)
    assert got.count() > 0 and _same(got.select("id", "min", "max", F.col("window_end").alias("endTs")), batch)


def test_sliding_windows_hold_every_element(spark):
    df = spark.createDataFrame([(t,) for t in (-7, 0, 3, 4, 5, 99)], "timestamp long")
    got = sorted((r.timestamp, r.window_start, r.window_end, r.last_end) for r in windows.sliding(10, 4)(df, "timestamp").collect())
    assert got == sorted((t, s, s + 10, max(s for s in range(-40, 120, 4) if s <= t < s + 10) + 10) for t in (-7, 0, 3, 4, 5, 99) for s in range(-40, 120, 4) if s <= t < s + 10)


def test_late_elements_of_overlapping_windows(spark, scratch, late_replay):
    """Lateness is judged per window; an element is late only when its last window is gone."""
    path, r, ticks, wm_last = late_replay
    window = windows.sliding(10 * K, 5 * K)
    out = _run(spark, stream_windows(stream(spark, path), window, Count(), CFG.delay_ms, late_output=True), "w_late", scratch)
    batch = lateness.on_time_window_counts(r, ticks, window).filter(F.col("window_end") <= wm_last)
    assert _same(out.filter("tag = 'window'").select("id", "window_end", "cnt"), batch)
    late = replay.with_watermark(window(r, "timestamp"), ticks).filter("last_end <= wm").select("event_id").distinct()
    assert late.count() > 0 and _same(out.filter("tag = 'late'").select(F.col("late_event_id").alias("event_id")), late)


def test_window_function_with_composite_keys(spark, scratch, time_replay):
    path, rows, wm_last = time_replay
    keys = ["id", F.pmod("event_id", F.lit(2)).alias("odd")]
    got = _run(spark, stream_windows(stream(spark, path), windows.sliding(8 * K, 4 * K), MEDIAN, 5 * K, keys=keys), "w_median", scratch)
    batch = windows.apply_windows(rows.drop("tick"), windows.sliding(8 * K, 4 * K), MEDIAN, keys=keys).filter(F.col("window_end") <= wm_last)
    columns = ["id", "odd", "window_start", "window_end", "median", "rows", "size", "who"]
    assert got.count() > 500 and _same(got.select(*columns), batch.select(*columns))
    assert {r.size for r in got.select("size").distinct().collect()} == {8 * K}


@pytest.mark.parametrize("parts, merge_parts", [(1, 1), (5, 64), (40, 3)])
def test_accumulators_at_any_partitioning(spark, parts, merge_parts, monkeypatch):
    monkeypatch.setattr(windows, "HELD_STATES", 50)
    rows = fx.readings(spark, SF_SMALL).repartition(parts)
    got = windows.reduce_windows(rows, 5 * K, MinMax(), merge_parts=merge_parts).select("id", "min", "max", F.col("window_end").alias("endTs"))
    assert _same(got, windows.minmax_tumbling(rows, 5 * K))
    hot = windows.reduce_windows(rows, 10_000 * K, NEAREST, keys=[F.lit("all").alias("id")], merge_parts=merge_parts)
    best = windows.assign_tumbling(rows, 10_000 * K).groupBy("window_end").agg(
        F.min_by(F.struct("event_id", "temperature"), F.struct(F.abs(F.col("temperature") - 50.0), "event_id")).alias("r")).select("window_end", "r.*")
    assert _same(hot.select("window_end", "event_id", "temperature"), best)


def test_accumulators_with_nulls_and_nan(spark):
    rows = spark.createDataFrame([(None, 1, 5.0), (None, 2, None), ("a", 3, None), ("a", 12, float("nan")), ("a", 13, 1.0)], "id string, timestamp long, temperature double")
    got = {(r.id, r.window_end): (r.min, r.max) for r in windows.reduce_windows(rows, 10, MinMax()).collect()}
    assert got[None, 10] == (5.0, 5.0) and got["a", 10] == (None, None) and all(np.isnan(got["a", 20]))
    assert windows.reduce_windows(rows.limit(0), 10, MinMax()).count() == 0 and windows.apply_windows(rows.limit(0), 10, MEDIAN).count() == 0
    got = {(r.id, r.window_end): r.cnt for r in windows.reduce_windows(rows, 10, Count()).collect()}
    assert got == {(None, 10): 2, ("a", 10): 1, ("a", 20): 2}


@pytest.mark.parametrize("chunk_rows", [1, 3, 1 << 16])
def test_rolling_reduce_of_ones_own(spark, scratch, time_replay, chunk_rows):
    """A reduce that is no built-in, in batch at any chunk size and on a stream, by any key."""
    from thermoflux.operators.rolling import rolling_fold
    from thermoflux.streaming import stream_rolling_reduce
    path, rows, _ = time_replay
    got = rolling_fold(rows.withColumn("near_id", F.col("event_id")), Reduce(nearest, ("near_id", "temperature"), "near_id long, temperature double"), "id", chunk_rows=chunk_rows)
    want, held = [], {}
    for r in rows.orderBy("event_id").collect():
        held[r.id] = nearest(held[r.id], (r.event_id, r.temperature)) if r.id in held else (r.event_id, r.temperature)
        want.append((r.event_id, r.id, *held[r.id]))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    if chunk_rows == 3:
        st = stream(spark, path).withColumn("near_id", F.col("event_id"))
        out = _run(spark, stream_rolling_reduce(st, Reduce(nearest, ("near_id", "temperature"), "near_id long, temperature double"), [F.col("id").alias("sensor")]), "w_reduce", scratch)
        assert sorted(tuple(r) for r in out.collect()) == sorted(want)


class _Map2:
    """Stubbed map state that counts reads."""

    def __init__(self):
        self.held, self.reads = {}, 0

    def keys(self):
        return iter(list(self.held))

    def getValue(self, key):
        self.reads += 1
        return self.held.get(tuple(key))

    def updateValue(self, key, value):
        self.held[tuple(key)] = value

    def removeKey(self, key):
        self.held.pop(tuple(key), None)


class _Handle2(_Handle):
    def getMapState(self, name, *_):
        return self.states.setdefault(name, _Map2())


def processor(content, trigger, lateness_ms=0):
    h, p = _Handle2(), WindowProcessor({"id": "string"}, "timestamp long, temperature double", content, trigger, lateness_ms)
    p.init(h)

    def feed(wm, *ts, size=10):
        frame = pd.DataFrame({"timestamp": list(ts), "temperature": [float(t) for t in ts], "window_start": [t - t % size for t in ts], "window_end": [t - t % size + size for t in ts]})
        return [x for f in p.handleInputRows(("s",), iter([frame]), _Timer(wm)) for x in f.itertuples(index=False)]

    return h, p, feed


@pytest.mark.parametrize("content", [Count(), WindowFunction(lambda k, s, rows: {"cnt": [len(rows)]}, "cnt long")])
def test_state_goes_after_close(content):
    h, p, feed = processor(content, EventTime(), lateness_ms=5)
    assert feed(0, 1, 2, 15) == [] and h.timers == {10}
    assert [(x.window_end, x.cnt, x.firing) for x in feed(11, 3, 16)] == [(10, 2, 0), (10, 3, 1)] and h.timers == {15}
    assert [(x.window_end, x.cnt) for x in feed(40)] == [(20, 2)]
    assert all(not h.states[s].held for s in ("windows", "parts", "due")) and h.timers == set() and not h.states["next"].exists()


def test_reads_follow_the_due_windows():
    """A batch reads the windows that it has rows for and those that are due, and no other."""
    h, p, feed = processor(Count(), EventTime())
    feed(0, *range(5, 10_005, 10))
    w = h.states["windows"]
    assert len(w.held) == 1000
    w.reads = 0
    assert feed(5, 9_999) == [] and w.reads == 1
    w.reads = 0
    assert len(feed(30)) == 3 and w.reads == 3 and h.timers == {40}
    h2, _, early = processor(Count(), EarlyFiring(4))
    early(0, 1, 11)
    assert [(x.window_end, x.eval_time, x.cnt) for x in early(3, 2)] == [(10, 3, 1), (20, 3, 1)]
    h2.states["windows"].reads = 0
    assert early(3, 12) == [] and h2.states["windows"].reads == 1
    assert [(x.window_end, x.eval_time, x.cnt) for x in early(10)] == [(10, 10, 2), (20, 10, 2)] and list(h2.states["windows"].held) == [(10, 20)]


def test_a_trigger_of_ones_own():
    class FireOnLarge(Trigger):
        """Purges silently at the end; fires when ten elements have come since the last firing."""

        def on_elements(self, count, span, ctx):
            ctx.register(span.end)
            for n in range(10 - ctx.state.get("n", 0), count + 1, 10):
                yield n, Decision.FIRE
            ctx.state["n"] = (ctx.state.get("n", 0) + count) % 10

        def on_event_time(self, time, span, ctx):
            return Decision.PURGE

        def clear(self, span, ctx):
            cleared.append(span)

    cleared = []
    h, p, feed = processor(Count(), FireOnLarge())
    assert [x.cnt for x in feed(0, *[1] * 25)] == [10, 20] and [x.cnt for x in feed(0, *[1] * 7)] == [30]
    assert feed(50) == [] and cleared == [Span(0, 10)] and not h.states["windows"].held


class LimitAlert(ConnectedProcessor):
    """Control rows set a limit for ``hold`` ms; readings above it pass; a timer drops it."""

    OUTPUT = "event_id long, id string, note string"
    STATE = {"limit": "value double, until long"}

    def on_row(self, key, row, watermark):
        held = self.states["limit"]
        if row.src_rank == 0:
            if held.exists():
                self.delete_timer(int(held.get()[1]))
            held.update((float(row.limit), int(row.timestamp + row.hold)))
            self.set_timer(int(row.timestamp + row.hold))
            return []
        return [(int(row.event_id), key[0], "above")] if held.exists() and row.temperature > held.get()[0] else []

    def on_timer(self, key, time, watermark):
        self.states["limit"].clear()
        return [(None, key[0], f"dropped at {time}")]


def limit_inputs(spark, scratch, name):
    r = fx.switch_readings(spark, SF_SMALL)
    s = fx.switches(spark, SF_SMALL).select("event_id", F.col("id").alias("sensor"), "timestamp", (F.pmod("event_id", F.lit(5)) * 20).cast("double").alias("limit"), F.col("duration_ms").alias("hold"))
    both = r.select("event_id", "id", "timestamp", "temperature", F.lit(None).cast("string").alias("sensor"), F.lit(None).cast("double").alias("limit"), F.lit(None).cast("long").alias("hold")) \
        .unionByName(s, allowMissingColumns=True).withColumn("tick", floor_div("timestamp", 30 * K))
    path = os.path.join(scratch, name)
    write_replay_files(both, path, order_cols=("timestamp", "event_id"))
    st = replay_stream(spark, path, both.drop("tick").schema)
    control = st.filter(F.col("hold").isNotNull()).select("event_id", "sensor", "timestamp", "limit", "hold")
    data = st.filter(F.col("hold").isNull()).select("event_id", "id", "timestamp", "temperature")
    return path, both, control, data


def connected(control, data):
    return stream_connected(control, data, LimitAlert(K), 5 * K, [F.upper("sensor").alias("s")], [F.upper("id").alias("s")])


def test_two_input_processor(spark, scratch):
    path, both, control, data = limit_inputs(spark, scratch, "limits")
    got = sorted((str(r.event_id), r.id, r.note) for r in _run(spark, connected(control, data), "limits", scratch).collect())
    released = both.agg(F.max("timestamp")).first()[0] - 5 * K
    want, held = [], {}
    rows = sorted((r for r in both.collect() if r.timestamp < released), key=lambda r: (r.timestamp, r.hold is None, r.event_id))
    for r in rows + [None]:
        for key in sorted(held):
            until = held[key][1]
            if until <= (r.timestamp if r else released):
                want.append(("None", key, f"dropped at {until}"))
                del held[key]
        if r is None:
            break
        key = (r.sensor or r.id).upper()
        if r.hold is not None:
            held[key] = r.limit, r.timestamp + r.hold
        elif key in held and r.temperature > held[key][0]:
            want.append((str(r.event_id), key, "above"))
    assert len(want) > 300 and got == sorted(want)


def interrupted(spark, path, build, name, scratch):
    """Run ``build(folder)`` over the first half of the files, stop, and go on from the checkpoint."""
    folder, out, ck = (os.path.join(scratch, f"{name}_{x}") for x in ("in", "out", "ck"))
    files = sorted(glob.glob(os.path.join(path, "tick=*", "*.parquet")), key=lambda f: int(f.split("tick=")[1].split("/")[0]))
    for half in (files[:len(files) // 2], files[len(files) // 2:]):
        for f in half:
            at = os.path.join(folder, os.path.basename(os.path.dirname(f)))
            os.makedirs(at, exist_ok=True)
            shutil.copy2(f, at)
        start_parquet(build(folder), out, ck).awaitTermination()
    return spark.read.parquet(out)


def builders(spark):
    from thermoflux.streaming import stream_early_firing, stream_late_windows, stream_rolling_sum
    triples = lambda st: st.select("event_id", F.regexp_extract("id", "_(\\d+)$", 1).cast("long").alias("k"), F.pmod("event_id", F.lit(100)).alias("v"), F.pmod("event_id", F.lit(7)).alias("c"))
    return {
        "sum": lambda d: stream_rolling_sum(triples(stream(spark, d))),
        "late": lambda d: stream_late_windows(stream(spark, d), 10 * K, 5 * K, CFG.delay_ms),
        "early": lambda d: stream_early_firing(stream(spark, d), 30 * K, K, CFG.delay_ms),
        "median": lambda d: stream_windows(stream(spark, d), 10 * K, MEDIAN, CFG.delay_ms),
    }


@pytest.mark.parametrize("name", ["sum", "late", "early", "median"])
def test_restart_from_the_checkpoint(spark, scratch, late_replay, name):
    """Interrupted = uninterrupted.  The watermark of the batch without data, with which a run
    ends, is the one the next batch would have had: nothing is judged differently."""
    path = late_replay[0]
    build = builders(spark)[name]
    got = interrupted(spark, path, build, f"re_{name}", scratch)
    want = _run(spark, build(path), f"un_{name}", scratch)
    assert want.count() > 0 and sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_restart_of_two_input_processors(spark, scratch):
    from thermoflux.streaming import stream_fire_alerts, stream_forward_switch
    path, both, control, data = limit_inputs(spark, scratch, "limits_re")
    schema = both.drop("tick").schema

    def sides(folder):
        st = replay_stream(spark, folder, schema)
        return st.filter(F.col("hold").isNotNull()), st.filter(F.col("hold").isNull()).select("event_id", "id", "timestamp", "temperature")

    def own(folder):
        c, d = sides(folder)
        return connected(c.select("event_id", "sensor", "timestamp", "limit", "hold"), d)

    def switch(folder):
        c, d = sides(folder)
        return stream_forward_switch(d, c.select("event_id", F.col("sensor").alias("id"), "timestamp", F.col("hold").alias("duration_ms")), 5 * K)

    def alerts(folder):
        c, d = sides(folder)
        return stream_fire_alerts(d, c.select("event_id", F.when(F.col("limit") > 30, F.lit("HIGH")).otherwise(F.lit("LOW")).alias("level"), "timestamp"), 5 * K, shards=3)

    for name, build in (("own", own), ("switch", switch), ("alerts", alerts)):
        got = interrupted(spark, path, build, f"re2_{name}", scratch)
        want = _run(spark, build(path), f"un2_{name}", scratch)
        assert want.count() > 0 and sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())), name
