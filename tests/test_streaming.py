"""Stream = batch parity: each streaming form replayed from per-tick files equals the batch form.

Replay files hold one watermark tick each (``maxFilesPerTrigger=1``), so every
micro-batch sees the replay model's watermark.  Windows still open when the
stream ends are excluded (the batch form closes them at the end of the replay).
"""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.replay_files import write_replay_files
from thermoflux.functions.temporal import floor_div
from thermoflux.operators import connect, lateness, replay, rolling, triggers, windows
from thermoflux.schema import REPLAY_READING
from thermoflux.sources import fixtures as fx
from thermoflux.streaming import (
    replay_stream,
    stream_avg_tumbling,
    stream_early_firing,
    stream_fire_alerts,
    stream_forward_switch,
    stream_late_windows,
    stream_minmax_tumbling,
    stream_rolling_max,
    stream_rolling_sum,
)

K = fx.K_MS
CFG = fx.ReplayConfig(tick_units=10)


@pytest.fixture(scope="module")
def scratch():
    return tempfile.mkdtemp(prefix="tf-stream-", dir="/tmp")


def _run(spark, df, name, scratch):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
           .option("checkpointLocation", os.path.join(scratch, "ck_" + name))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def late_replay(spark, scratch):
    rows = fx.arrival_readings(spark, SF_SMALL, CFG)
    path = os.path.join(scratch, "arrival")
    write_replay_files(rows.select("event_id", "id", "timestamp", "temperature", "arrival", "tick"), path)
    r, ticks = replay.replay(rows, CFG.delay_ms)
    wm_last = ticks.agg(F.max("wm")).first()[0]
    return path, r, ticks, wm_last


@pytest.fixture(scope="module")
def time_replay(spark, scratch):
    """Readings in event-time order (no arrival delay), 10 units per file."""
    rows = fx.readings(spark, SF_SMALL).withColumn("arrival", F.col("timestamp")) \
        .withColumn("tick", floor_div("timestamp", 10 * K))
    path = os.path.join(scratch, "bytime")
    write_replay_files(rows, path)
    return path, rows


def test_stream_updating_count_and_late_output(spark, scratch, late_replay):
    path, r, ticks, wm_last = late_replay
    out = _run(spark, stream_late_windows(replay_stream(spark, path, REPLAY_READING), 10 * K, 5 * K, CFG.delay_ms),
               "late_counts", scratch)
    counts = out.filter("tag = 'count'").select("id", "window_end", "cnt", "kind")
    batch = lateness.updating_window_counts(r, ticks, 10 * K, 5 * K).filter(F.col("window_end") <= wm_last)
    assert counts.count() > 0 and _same(counts, batch)
    dropped = out.filter("tag = 'late'").select("event_id")
    e = F.col("timestamp") - F.pmod("timestamp", F.lit(10 * K)) + F.lit(10 * K)
    assert _same(dropped, replay.with_watermark(r, ticks).filter(e + F.lit(5 * K) <= F.col("wm")).select("event_id"))


def test_stream_late_side_output_zero_lateness(spark, scratch, late_replay):
    path, r, ticks, _ = late_replay
    out = _run(spark, stream_late_windows(replay_stream(spark, path, REPLAY_READING), 10 * K, 0, CFG.delay_ms),
               "late_side", scratch)
    late = out.filter("tag = 'late'").select("event_id", "id", "timestamp", "temperature")
    assert late.count() > 0 and _same(late, lateness.late_side_output(r, ticks, 10 * K))


def test_stream_early_firing(spark, scratch, late_replay):
    path, r, ticks, wm_last = late_replay
    out = _run(spark, stream_early_firing(replay_stream(spark, path, REPLAY_READING), 30 * K, 1 * K, CFG.delay_ms),
               "early", scratch)
    batch = triggers.early_firing_counts(r, ticks, 30 * K, 1 * K).filter(F.col("eval_time") <= wm_last)
    assert out.count() > 0 and _same(out, batch)


def test_stream_rolling(spark, scratch, time_replay):
    path, rows = time_replay
    st = replay_stream(spark, path, REPLAY_READING)
    got = _run(spark, stream_rolling_max(st), "rmax", scratch)
    assert _same(got, rolling.rolling_max(rows))
    triples = st.select("event_id", F.regexp_extract("id", "_(\\d+)$", 1).cast("long").alias("k"),
                        F.pmod("event_id", F.lit(100)).alias("v"), F.pmod("event_id", F.lit(7)).alias("c"))
    got = _run(spark, stream_rolling_sum(triples), "rsum", scratch)
    assert _same(got, rolling.rolling_sum(fx.triples(spark, SF_SMALL)))


def test_stream_forward_switch(spark, scratch):
    ev = fx.events(spark, SF_SMALL).select("event_id", "event_type")
    r = fx.switch_readings(spark, SF_SMALL)
    s = fx.switches(spark, SF_SMALL)
    both = (r.select("event_id", "id", "timestamp", "temperature", F.lit(None).cast("long").alias("duration_ms"))
             .unionByName(s.select("event_id", "id", "timestamp", F.lit(None).cast("double").alias("temperature"),
                                   "duration_ms")))
    both = both.withColumn("tick", floor_div("timestamp", 10 * K))
    path = os.path.join(scratch, "switch")
    write_replay_files(both, path, order_cols=("timestamp", "event_id"))
    st = replay_stream(spark, path, both.drop("tick").schema)
    readings = st.filter(F.col("duration_ms").isNull()).drop("duration_ms", "tick")
    switches = st.filter(F.col("duration_ms").isNotNull()).drop("temperature", "tick")
    got = _run(spark, stream_forward_switch(readings, switches, 5 * K), "fwd", scratch)
    assert ev.count() == 1000
    released = both.agg(F.max("timestamp")).first()[0] - 5 * K
    want = connect.forward_switch(r, s).filter(F.col("timestamp") < released)
    assert got.count() > 700 and _same(got, want)


def test_stream_fire_alerts(spark, scratch):
    r = fx.alert_readings(spark, SF_SMALL)
    sm = fx.smoke(spark, SF_SMALL)
    both = (r.select("event_id", "id", "timestamp", "temperature", F.lit(None).cast("string").alias("level"))
             .unionByName(sm.select("event_id", F.lit(None).cast("string").alias("id"), "timestamp",
                                    F.lit(None).cast("double").alias("temperature"), "level")))
    both = both.withColumn("tick", floor_div("timestamp", 10 * K))
    path = os.path.join(scratch, "smoke")
    write_replay_files(both, path, order_cols=("timestamp", "event_id"))
    st = replay_stream(spark, path, both.drop("tick").schema)
    readings = st.filter(F.col("level").isNull()).drop("level", "tick")
    smoke = st.filter(F.col("level").isNotNull()).select("event_id", "level", "timestamp")
    got = _run(spark, stream_fire_alerts(readings, smoke, 5 * K, shards=3), "alerts", scratch)
    released = both.agg(F.max("timestamp")).first()[0] - 5 * K
    want = connect.fire_alerts(r, sm).filter(F.col("timestamp") < released)
    assert got.count() > 100 and _same(got, want)


def test_stream_builtin_windows(spark, scratch, time_replay):
    path, rows = time_replay
    st = replay_stream(spark, path, REPLAY_READING)
    wm_last = rows.agg(F.max("timestamp")).first()[0] - 5 * K
    got = _run(spark, stream_minmax_tumbling(st, 5 * K, 5 * K), "minmax", scratch)
    batch = windows.minmax_tumbling(rows, 5 * K).filter(F.col("endTs") <= wm_last)
    assert got.count() > 0 and _same(got, batch)
    got = _run(spark, stream_avg_tumbling(st, 1 * K, 5 * K), "avg", scratch)
    batch = windows.avg_tumbling(rows, 1 * K).filter(F.col("timestamp") <= wm_last)
    r6 = F.round("temperature", 6).alias("temperature")
    assert _same(got.select("id", "timestamp", r6), batch.select("id", "timestamp", r6))


def test_stream_late_reading_split(spark, scratch, late_replay):
    from thermoflux.streaming import stream_late_reading_split
    path, r, ticks, _ = late_replay
    out = _run(spark, stream_late_reading_split(replay_stream(spark, path, REPLAY_READING), CFG.delay_ms),
               "late_split", scratch)
    main, late = lateness.late_reading_split(r, ticks)
    cols = ["event_id", "id", "timestamp", "temperature"]
    assert _same(out.filter("tag = 'late'").select(*cols), late.select(*cols))
    assert _same(out.filter("tag = 'main'").select(*cols), main.select(*cols))


def test_stream_count_tumbling_single_watermark(spark, scratch, late_replay):
    from thermoflux.streaming import stream_count_tumbling
    path, r, ticks, wm_last = late_replay
    key = "spark.sql.streaming.statefulOperator.allowMultiple"
    spark.conf.set(key, "false")
    try:
        out = _run(spark, stream_count_tumbling(replay_stream(spark, path, REPLAY_READING), 10 * K, CFG.delay_ms),
                   "count10", scratch)
    finally:
        spark.conf.unset(key)
    batch = lateness.on_time_window_counts(r, ticks, 10 * K).filter(F.col("window_end") <= wm_last)
    assert out.count() > 0 and _same(out, batch)


def test_stream_freezing_monitor_foreach_batch(spark, scratch, time_replay):
    from thermoflux.operators import records
    from thermoflux.streaming import stream_freezing_monitor
    from thermoflux.streaming.sinks import start_tagged
    path, rows = time_replay
    st = replay_stream(spark, path, REPLAY_READING)
    outs = {"main": os.path.join(scratch, "frz_main"), "freezing-alarms": os.path.join(scratch, "frz_alarms")}
    q = start_tagged(stream_freezing_monitor(st), outs, os.path.join(scratch, "ck_frz"))
    q.awaitTermination()
    main, alarms = records.freezing_monitor(rows.select("event_id", "id", "timestamp", "temperature"))
    got_main = spark.read.parquet(outs["main"]).select("event_id", "id", "timestamp", "temperature")
    got_alarms = spark.read.parquet(outs["freezing-alarms"]).select("event_id", "message")
    assert _same(got_main, main) and _same(got_alarms, alarms)


def test_stream_forward_switch_out_of_order(spark, scratch):
    """Switches and readings arrive out of event-time order (fixture arrival delays); the
    buffered processor applies them in event-time order once the watermark passes."""
    r = fx.switch_readings(spark, SF_SMALL)
    s = fx.switches(spark, SF_SMALL)
    both = (r.select("event_id", "id", "timestamp", "temperature", F.lit(None).cast("long").alias("duration_ms"))
             .unionByName(s.select("event_id", "id", "timestamp", F.lit(None).cast("double").alias("temperature"),
                                   "duration_ms")))
    both = both.withColumn("arrival", F.col("timestamp") + F.lit(K) * fx.arrival_delay_units(F.col("event_id"))) \
        .withColumn("tick", floor_div("arrival", 10 * K))
    path = os.path.join(scratch, "switch_ooo")
    write_replay_files(both.drop("arrival"), path, order_cols=("event_id",))
    st = replay_stream(spark, path, both.drop("tick", "arrival").schema)
    readings = st.filter(F.col("duration_ms").isNull()).drop("duration_ms", "tick")
    switches = st.filter(F.col("duration_ms").isNotNull()).drop("temperature", "tick")
    delay = 31 * K        # above the largest arrival delay: no row is late
    got = _run(spark, stream_forward_switch(readings, switches, delay), "fwd_ooo", scratch)
    released = both.agg(F.max("timestamp")).first()[0] - delay
    want = connect.forward_switch(r, s).filter(F.col("timestamp") < released)
    assert want.count() > 500 and _same(got, want)


def _poll(spark, table, n, seconds=90):
    """Processing-time queries never go idle: poll instead of processAllAvailable."""
    import time
    deadline = time.time() + seconds
    while time.time() < deadline:
        try:
            if spark.table(table).count() >= n:
                return
        except Exception:
            pass
        time.sleep(1)


def test_stream_wall_clock_switch_and_ttl(spark, scratch):
    """Live forms (processing time): the wall-clock switch forwards a sensor's readings
    after its switch arrives; rolling state with a TTL still gives running sums."""
    import time

    from thermoflux.streaming import stream_forward_switch_wall_clock
    r = fx.switch_readings(spark, SF_SMALL).limit(0)
    path_r, path_s = os.path.join(scratch, "live_r"), os.path.join(scratch, "live_s")
    r.write.parquet(path_r)
    sw_schema = fx.switches(spark, SF_SMALL).schema
    spark.createDataFrame([(0, "sensor_1", 0, 3_600_000)], sw_schema).write.parquet(path_s)
    readings = spark.readStream.schema(r.schema).parquet(path_r)
    switches = spark.readStream.schema(sw_schema).parquet(path_s)
    q = (stream_forward_switch_wall_clock(readings, switches).writeStream.format("memory").queryName("live_fwd")
         .option("checkpointLocation", os.path.join(scratch, "ck_live")).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        while not q.recentProgress and time.time() < deadline:   # the switch batch ran
            time.sleep(1)
        time.sleep(3)
        rows = [(1, "sensor_1", 5, 20.0), (2, "sensor_2", 6, 21.0)]
        spark.createDataFrame(rows, r.schema).write.mode("append").parquet(path_r)
        _poll(spark, "live_fwd", 1)
        time.sleep(3)
    finally:
        q.stop()
    assert [x.event_id for x in spark.table("live_fwd").collect()] == [1]

    tri = fx.triples(spark, SF_SMALL)
    path_t = os.path.join(scratch, "live_t")
    tri.write.parquet(path_t)
    q = (stream_rolling_sum(spark.readStream.schema(tri.schema).parquet(path_t), ttl_ms=3_600_000)
         .writeStream.format("memory").queryName("ttl_sum")
         .option("checkpointLocation", os.path.join(scratch, "ck_ttl")).trigger(processingTime="1 second").start())
    try:
        _poll(spark, "ttl_sum", 1000)
    finally:
        q.stop()
    assert _same(spark.table("ttl_sum"), rolling.rolling_sum(tri))


def test_stream_nan_as_batch(spark, scratch):
    """Min, max and the rolling record with NaN: the stream gives what the batch gives."""
    nan = float("nan")
    temps = [50.0, nan, 10.0, 60.0, 5.0, nan, nan, 3.0]
    df = spark.createDataFrame([(i, "s", 1_000 * (i + 1), t, 1_000 * (i + 1)) for i, t in enumerate(temps)]
                               + [(99, "z", 10 ** 7, 1.0, 10 ** 7)], REPLAY_READING)
    path = os.path.join(scratch, "nan")
    write_replay_files(df.withColumn("tick", floor_div("arrival", 3000)), path)
    st = replay_stream(spark, path, REPLAY_READING)
    text = lambda x: sorted(map(str, x.collect()))
    assert text(_run(spark, stream_rolling_max(st), "nan_max", scratch)) == text(rolling.rolling_max(df, chunk_rows=2))
    got = _run(spark, stream_minmax_tumbling(st, 4000, 0), "nan_minmax", scratch)
    assert text(got) == text(windows.minmax_tumbling(df.filter("id = 's'"), 4000))


class _Timer:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getCurrentWatermarkInMs(self):
        return self.now


class _Value:
    def __init__(self):
        self.held, self.writes = None, 0

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held, self.writes = value, self.writes + 1

    def clear(self):
        self.held = None


class _Map:
    def __init__(self):
        self.held, self.written = {}, []

    def iterator(self):
        return iter(list(self.held.items()))

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value
        self.written.append(key)

    def removeKey(self, key):
        del self.held[key]


class _Handle:
    def __init__(self):
        self.timers, self.states = set(), {}

    def getValueState(self, name, *_):
        return self.states.setdefault(name, _Value())

    def getMapState(self, name, *_):
        return self.states.setdefault(name, _Map())

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)

    def listTimers(self):
        return iter(sorted(self.timers))


def _ids(frames):
    return [int(x) for f in frames for x in f["event_id"]]


def test_wall_clock_switch_runs_out_between_batches():
    """Spark hands over rows before expired timers: a reading after expiry is not forwarded."""
    import pandas as pd

    from thermoflux.streaming.processors import WallClockReadingFilter
    h, p = _Handle(), WallClockReadingFilter()
    p.init(h)

    def rows(*rs):
        return iter([pd.DataFrame(rs, columns=["event_id", "id", "timestamp", "temperature", "duration_ms", "src_rank"])])

    switch = lambda i, ms: (i, "s", 0, None, ms, 0)
    reading = lambda i: (i, "s", 0, 1.0, None, 1)
    # order within the batch is that of event_id, whatever the shuffle made of it
    assert _ids(p.handleInputRows(("s",), rows(reading(3), switch(2, 1000), reading(1)), _Timer(10_000))) == [3]
    assert h.timers == {11_000} and h.states["timer"].writes == 1
    assert _ids(p.handleInputRows(("s",), rows(reading(4)), _Timer(10_500))) == [4]
    assert h.states["timer"].writes == 1                       # nothing changed, nothing written
    assert _ids(p.handleInputRows(("s",), rows(reading(5)), _Timer(15_000))) == []
    assert h.timers == set() and not h.states["timer"].exists()
    assert _ids(p.handleInputRows(("s",), rows(switch(6, 2000), switch(7, 500), reading(8)), _Timer(16_000))) == [8]
    assert list(p.handleExpiredTimer(("s",), _Timer(16_600), None)) == [] and h.timers == {18_000}
    assert _ids(p.handleInputRows(("s",), rows(reading(9)), _Timer(17_000))) == [9]
    list(p.handleExpiredTimer(("s",), _Timer(18_000), None))
    assert not h.states["timer"].exists()


def test_buffer_writes_only_its_own_rows():
    """A batch leaves pending rows of other buckets alone, and due buckets are read once."""
    import pandas as pd

    from thermoflux.streaming.processors import ReadingFilter
    h, p = _Handle(), ReadingFilter(bucket_ms=10)
    p.init(h)

    def rows(*ts, rank=1):
        return iter([pd.DataFrame([(t, "s", t, 1.0, t + 1000 if rank == 0 else None, rank) for t in ts], columns=p.ARROW.names)])

    list(p.handleInputRows(("s",), rows(1, rank=0), _Timer(0)))
    list(p.handleInputRows(("s",), rows(5, 15, 25), _Timer(0)))
    parts = h.states["parts"]
    assert set(parts.held) == {(0, 0), (0, 1), (1, 0), (2, 0)} and h.timers == {2}
    parts.written.clear()
    assert list(p.handleInputRows(("s",), rows(26, 35), _Timer(0))) == []
    assert parts.written == [(2, 1), (3, 0)]                   # (0, *) and (1, 0) were not touched
    parts.written.clear()
    assert _ids(p.handleInputRows(("s",), rows(45), _Timer(18))) == [5, 15]
    assert parts.written == [(4, 0)] and set(parts.held) == {(2, 0), (2, 1), (3, 0), (4, 0)} and h.timers == {26}
    assert _ids(p.handleExpiredTimer(("s",), _Timer(26), None)) == [25]
    assert parts.written[-1] == (2, 0) and h.timers == {27}    # the rest of a bucket that was due in part


def test_sinks(spark, scratch, time_replay):
    from thermoflux.streaming.sinks import start_memory, start_parquet, start_print
    path, rows = time_replay
    st = replay_stream(spark, path, REPLAY_READING).select("event_id", "id")
    out = os.path.join(scratch, "plain")
    start_parquet(st, out, os.path.join(scratch, "ck_plain")).awaitTermination()
    assert _same(spark.read.parquet(out), rows.select("event_id", "id"))
    start_memory(st, "in_memory").awaitTermination()
    assert spark.table("in_memory").count() == rows.count()
    q = start_print(st, rows=2)          # the JVM prints to its own standard output
    q.awaitTermination()
    assert q.exception() is None and sum(p["numInputRows"] for p in q.recentProgress) > 0
