"""Rolling operators, the chunked scan, windows and two-stream operators on hand goldens."""

import random

import pytest
from pyspark.sql import functions as F

from thermoflux.operators import connect, rolling, windows
from thermoflux.operators.scan import Measure, running_scan
from thermoflux.schema import SMOKE, SWITCH, TRIPLE


def test_rolling_sum_golden(spark):
    # (k, v, c) in arrival order → field v accumulates, c keeps the key's first value.
    df = spark.createDataFrame([(0, 1, 2, 2), (1, 2, 3, 1), (2, 2, 2, 4), (3, 1, 5, 3)], TRIPLE)
    got = [tuple(r) for r in rolling.rolling_sum(df).orderBy("event_id").collect()]
    assert got == [(0, 1, 2, 2), (1, 2, 3, 1), (2, 2, 5, 1), (3, 1, 7, 2)]


def test_rolling_max_tie_takes_newer(spark):
    df = spark.createDataFrame([(i, "s", ts, t) for i, (ts, t) in enumerate([(1, 20.0), (2, 25.0), (3, 25.0), (4, 10.0)])],
                               "event_id long, id string, timestamp long, temperature double")
    got = [(r.timestamp, r.temperature) for r in rolling.rolling_max(df).orderBy("event_id").collect()]
    assert got == [(1, 20.0), (2, 25.0), (3, 25.0), (3, 25.0)]


@pytest.mark.parametrize("width", [1, 3, 7, 1000])
def test_running_scan_independent_of_chunk_width(spark, width):
    rnd = random.Random(width)
    rows = [(i, rnd.choice("abc"), rnd.randint(0, 50), rnd.choice([None, "x", "y"])) for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, k string, v long, tag string")
    ms = [Measure("s", "sum", F.col("v")), Measure("m", "max", F.col("v")), Measure("mn", "min", F.col("v")),
          Measure("last_tag", "last", F.col("tag")), Measure("first_tag", "first", F.col("tag"))]
    got = {r.seq: tuple(r)[4:] for r in running_scan(df, ["k"], ["seq"], ms, chunk_rows=width).collect()}
    ex = {r.seq: tuple(r)[4:] for r in running_scan(df, ["k"], ["seq"], ms, chunk_rows=2 * width, exclusive=True).collect()}
    # brute force
    state = {}
    for seq, k, v, tag in rows:
        s, m, mn, lt, ft = state.get(k, (0, None, None, None, None))
        prev = (s if k in state else None, m, mn, lt, ft)
        s, m, mn = s + v, v if m is None else max(m, v), v if mn is None else min(mn, v)
        lt = tag if tag is not None else lt
        ft = ft if ft is not None else tag
        state[k] = (s, m, mn, lt, ft)
        assert got[seq] == (s, m, mn, lt, ft)
        assert ex[seq] == prev


def test_minmax_nan_propagates(spark):
    df = spark.createDataFrame([("s", 1, 1.0), ("s", 2, float("nan")), ("s", 3, 3.0)],
                               "id string, timestamp long, temperature double")
    r = windows.minmax_tumbling(df, 1000).first()
    assert r.min != r.min and r.max != r.max  # NaN, like Java Math.min/max
    assert r.endTs == 1000


def test_avg_window_end_is_exclusive_end(spark):
    df = spark.createDataFrame([("s", 0, 212.0), ("s", 999, 32.0), ("s", 1000, 50.0)],
                               "id string, timestamp long, temperature double")
    got = sorted(tuple(r) for r in windows.avg_tumbling(df, 1000).collect())
    assert got == [("s", 1000, 50.0), ("s", 2000, 10.0)]


READINGS = "event_id long, id string, timestamp long, temperature double"


@pytest.mark.parametrize("bucket_ms", [None, 1, 3, 1000])
def test_fire_alerts_golden(spark, bucket_ms):
    readings = spark.createDataFrame(
        [(1, "sensor_1", 3, 120.0), (2, "sensor_1", 6, 100.0), (3, "sensor_1", 7, 100.5), (4, "sensor_1", 9, 150.0),
         (5, "sensor_1", 7, float("nan"))], READINGS)
    smoke = spark.createDataFrame([(10, "HIGH", 5), (11, "LOW", 8)], SMOKE)
    got = [tuple(r) for r in connect.fire_alerts(readings, smoke, bucket_ms=bucket_ms, chunk_rows=1).collect()]
    assert got == [(3, "Risk of fire!(sensor_1, 7, 100.5)", 7, 100.5)]


def test_fire_alerts_smoke_first_at_equal_time(spark):
    readings = spark.createDataFrame([(1, "sensor_1", 5, 120.0)], READINGS)
    smoke = spark.createDataFrame([(10, "HIGH", 5)], SMOKE)
    assert connect.fire_alerts(readings, smoke).count() == 1      # open to the end
    assert connect.fire_alerts(readings, smoke.filter("false")).count() == 0
    assert connect.fire_alerts(readings.filter("false"), smoke).count() == 0
    # two smoke events at one time: the later event_id wins
    smoke = spark.createDataFrame([(10, "HIGH", 5), (11, "LOW", 5), (12, "HIGH", 9)], SMOKE)
    readings = spark.createDataFrame([(1, "s", 5, 120.0), (2, "s", 8, 120.0), (3, "s", 9, 120.0)], READINGS)
    for bucket_ms in (None, 2):
        assert [r.event_id for r in connect.fire_alerts(readings, smoke, bucket_ms=bucket_ms).collect()] == [3]


def test_long_intervals_make_few_slots(spark):
    """The bucket follows the mean length: a period of 30 years beside short ones is a few slots each."""
    far = 10 ** 12
    readings = spark.createDataFrame([(1, "s", 3, 120.0), (2, "s", 7, 120.0), (3, "s", far + 1, 120.0)], READINGS)
    smoke = spark.createDataFrame([(10, "HIGH", 5), (11, "LOW", far)], SMOKE)
    assert [r.event_id for r in connect.fire_alerts(readings, smoke).collect()] == [2]
    switches = spark.createDataFrame([(100, "s", 5, far)] + [(101 + i, "t", 100 * i, 10) for i in range(500)], SWITCH)
    assert sorted(r.event_id for r in connect.forward_switch(readings, switches).collect()) == [2, 3]


@pytest.mark.parametrize("bucket_ms", [None, 3000])
@pytest.mark.parametrize("second,expected_until", [(3000, 10000), (20000, 22000)])
def test_forward_switch_golden(spark, second, expected_until, bucket_ms):
    switches = spark.createDataFrame([(100, "sensor_2", 0, 10000), (101, "sensor_2", 2000, second)], SWITCH)
    ts = [0, 1000, 9999, 10000, 15000, 21999, 22000, 30000]
    readings = spark.createDataFrame([(i, "sensor_2", t, 1.0) for i, t in enumerate(ts)] + [(50, "sensor_7", 5, 1.0)], READINGS)
    got = sorted(r.timestamp for r in connect.forward_switch(readings, switches, bucket_ms, chunk_rows=1).collect())
    assert got == [t for t in ts if t < expected_until]


def test_forward_switch_reopens_after_expiry(spark):
    switches = spark.createDataFrame([(100, "s", 0, 10), (101, "s", 50, 10)], SWITCH)
    readings = spark.createDataFrame([(i, "s", t, 1.0) for i, t in enumerate([5, 10, 30, 50, 59, 60])], READINGS)
    for bucket_ms in (None, 7):
        assert sorted(r.timestamp for r in connect.forward_switch(readings, switches, bucket_ms).collect()) == [5, 50, 59]
    assert connect.forward_switch(readings, switches.filter("false")).count() == 0


@pytest.mark.parametrize("chunk_rows", [1, 2, 3, 1 << 16])
def test_rolling_reduce_keeps_records_and_nan_begins_anew(spark, chunk_rows):
    nan = float("nan")
    values = {"a": [50.0, nan, 10.0, 60.0], "b": [5.0, 7.0, 7.0, 6.0, nan, nan, 1.0, 0.5, 1.0], "c": [nan]}
    rows, want = [], {}
    for key, own in values.items():
        held = None
        for t in own:
            n = len(rows)
            rows.append((n, key, t, f"record {n}"))
            held = (t, n) if held is None or not held[0] > t else held      # reduce((r1, r2) -> r1.t > r2.t ? r1 : r2)
            want[n] = f"record {held[1]}"
    df = spark.createDataFrame(rows, "event_id long, sensor string, heat double, note string")
    got = rolling.rolling_reduce(df, "sensor", "heat", chunk_rows=chunk_rows)
    assert got.columns == ["event_id", "sensor", "heat", "note"]
    assert {r.event_id: r.note for r in got.collect()} == want


def test_rolling_sum_keeps_a_null_first_field(spark):
    df = spark.createDataFrame([(0, 1, 2, None), (1, 1, 3, 5)], "event_id long, k long, v long, c long")
    for chunk_rows in (1, 100):
        assert sorted(tuple(r) for r in rolling.rolling_sum(df, chunk_rows=chunk_rows).collect()) == [(0, 1, 2, None), (1, 1, 5, None)]


@pytest.mark.parametrize("chunk_rows", [32768, 4096, 327])
def test_only_hot_keys_are_cut(spark, chunk_rows):
    from thermoflux.operators.scan import _CHUNK, chunked
    from thermoflux.sources import fixtures as fx
    tri = fx.triples(spark, "/root/testdata/sf0.1")
    one_hot = tri.withColumn("k", F.when(F.col("event_id") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("k")))
    cut = chunked(one_hot, ["k"], F.col("event_id"), chunk_rows).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(_CHUNK).alias("chunks"), F.max(_CHUNK).alias("last")).collect()
    for r in cut:
        parts = -(-r.n // chunk_rows)
        assert (r.chunks, r.last) == ((0, None) if r.n <= chunk_rows else (parts, parts - 1))
    assert sum(max(0, r.chunks - 1) for r in cut) <= 2 * 100_000 / chunk_rows      # carry rows


def test_windows_over_other_columns_and_assigners(spark):
    df = spark.createDataFrame([("p", 1, 3.0), ("p", 7, 5.0), ("q", 12, 1.0)], "plant string, at long, load double")
    sliding = lambda rows, ts: rows.withColumn("window_end", F.explode(F.array(F.lit(10), F.lit(20)).cast("array<long>"))) \
        .filter((F.col(ts) < F.col("window_end")) & (F.col(ts) >= F.col("window_end") - 15))
    got = sorted(tuple(r) for r in windows.minmax_tumbling(df, sliding, key="plant", value="load", ts_col="at").collect())
    assert got == [("p", 3.0, 5.0, 10), ("p", 5.0, 5.0, 20), ("q", 1.0, 1.0, 20)]
    got = sorted(tuple(r) for r in windows.avg_tumbling(df, 10, celsius=False, key="plant", value="load", ts_col="at").collect())
    assert got == [("p", 10, 4.0), ("q", 20, 1.0)]
    got = windows.aggregate(df, 10, F.collect_list("load").alias("all"), key="plant", ts_col="at")
    assert {(r.plant, r.window_end): sorted(r.all) for r in got.collect()} == {("p", 10): [3.0, 5.0], ("q", 20): [1.0]}


def test_hot_key_rolling_and_switch_match_duckdb(spark):
    """All rows of sf0.01 in one key: the scan splits it into chunks and stays exact."""
    import duckdb

    from tests.conftest import SF_ORACLE
    from thermoflux.sources import fixtures as fx
    ev = f"read_parquet('{SF_ORACLE}/events.parquet')"
    tri = fx.triples(spark, SF_ORACLE).withColumn("k", F.lit(0).cast("long"))
    got = {r.event_id: (r.v, r.c) for r in rolling.rolling_sum(tri, chunk_rows=997).collect()}
    want = duckdb.sql(f"""SELECT event_id, sum(event_id % 100) OVER w AS v, first_value(event_id % 7) OVER w AS c
        FROM {ev} WINDOW w AS (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""").fetchall()
    assert len(got) == len(want) == 10000
    assert all(got[e] == (v, c) for e, v, c in want)

    r = fx.readings(spark, SF_ORACLE).withColumn("id", F.lit("hot"))
    got = {x.event_id: (x.timestamp, x.temperature) for x in rolling.rolling_max(r, chunk_rows=501).collect()}
    want = duckdb.sql(f"""SELECT event_id, m.ts, m.t FROM (SELECT event_id,
        max({{'t': value * 2, 's': event_id, 'ts': epoch_us(ts) // 1000}}) OVER (ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM {ev})""").fetchall()
    assert all(got[e] == (ts, t) for e, ts, t in want)

    sw = fx.switches(spark, SF_ORACLE).withColumn("id", F.lit("hot"))
    rd = fx.switch_readings(spark, SF_ORACLE).withColumn("id", F.lit("hot"))
    n = connect.forward_switch(rd, sw, chunk_rows=100).count()
    want = duckdb.sql(f"""WITH s AS (SELECT epoch_us(ts) // 1000 AS t, {fx.K_MS} * (10 + (event_id % 3) * 25) AS d
        FROM {ev} WHERE event_type = 'signup')
        SELECT count(*) FROM {ev} r WHERE event_type <> 'signup' AND EXISTS (SELECT 1 FROM s
        WHERE s.t <= epoch_us(r.ts) // 1000 AND s.t + s.d > epoch_us(r.ts) // 1000)""").fetchall()[0][0]
    assert n == want


@pytest.mark.parametrize("bucket_units", [None, 1, 16, 200])
@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_connect_on_fixture_broadcast_or_not(spark, bucket_units, threshold):
    from tests.conftest import SF_SMALL
    from thermoflux.sources import fixtures as fx
    bucket_ms = bucket_units and bucket_units * fx.K_MS
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, threshold)
    try:
        r, s = fx.switch_readings(spark, SF_SMALL), fx.switches(spark, SF_SMALL)
        assert connect.forward_switch(r, s, bucket_ms, chunk_rows=7).count() == 740
        r, sm = fx.alert_readings(spark, SF_SMALL), fx.smoke(spark, SF_SMALL)
        assert connect.fire_alerts(r, sm, bucket_ms=bucket_ms, chunk_rows=7).count() == 104
    finally:
        spark.conf.unset(key)
