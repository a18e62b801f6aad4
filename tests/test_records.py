"""Stateless operators: filter, map, flatMap split, F→C, freezing monitor."""

from pyspark.sql import functions as F

from thermoflux.functions.text import alert_message
from thermoflux.operators import records
from thermoflux.schema import READING


def _readings(spark, rows):
    return spark.createDataFrame(rows, READING)


def test_filter_is_inclusive(spark):
    # a comparison with NaN is false
    df = _readings(spark, [("s_1", 1, 24.9), ("s_1", 2, 25.0), ("s_1", 3, 30.0), ("s_1", 4, float("nan"))])
    got = [r.temperature for r in records.filter_temperature(df, 25.0).collect()]
    assert sorted(got) == [25.0, 30.0]


def test_split_java_semantics(spark):
    ids = ["sensor_7", "a__", "_a", "___", ""]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "n int, id string")
    got = {}
    for n, x in enumerate(ids):
        got[x] = [r.part for r in records.split_id(df.filter(F.col("n") == n)).collect()]
    assert got["sensor_7"] == ["sensor", "7"]
    assert got["a__"] == ["a"]
    assert got["_a"] == ["", "a"]
    assert got["___"] == []
    assert got[""] == [""]


def test_f_to_c_bit_equal(spark):
    df = _readings(spark, [("s", 1, 212.0), ("s", 2, 77.7)])
    got = [r.temperature for r in records.to_celsius(df).orderBy("timestamp").collect()]
    assert got == [(212.0 - 32) * (5.0 / 9.0), (77.7 - 32) * (5.0 / 9.0)]


def test_freezing_monitor(spark):
    df = _readings(spark, [("sensor_1", 1, 32.0), ("sensor_1", 2, 31.9), ("sensor_1", 3, float("nan"))])
    main, alarms = records.freezing_monitor(df)
    assert main.count() == 3
    assert [r.message for r in alarms.collect()] == ["Freezing Alarm for sensor_1"]


def test_alert_text_matches_java_format(spark):
    df = _readings(spark, [("sensor_1", 7, 100.5)])
    assert df.select(alert_message().alias("m")).first().m == "Risk of fire!(sensor_1, 7, 100.5)"


def test_tag_rows_and_split_outputs(spark):
    from thermoflux.operators.outputs import split_outputs, tag_rows
    df = _readings(spark, [("s_1", 1, 10.0), ("s_1", 2, 40.0), ("s_2", 3, 120.0)])
    tagged = tag_rows(df, [("hot", F.col("temperature") > 100), ("cold", F.col("temperature") < 32)])
    outs = split_outputs(tagged, ["main", "hot", "cold"])
    assert [r.timestamp for r in outs["hot"].collect()] == [3]
    assert [r.timestamp for r in outs["cold"].collect()] == [1]
    assert [r.timestamp for r in outs["main"].collect()] == [2]
    assert outs["main"].columns == df.columns


def test_assigner_and_minmax_seed(spark):
    from thermoflux.operators.windows import assign_tumbling
    df = _readings(spark, [("s", 0, 1.0), ("s", 29_999, 2.0), ("s", 30_000, 3.0), ("s", -1, 4.0)])
    got = sorted((r.timestamp, r.window_start, r.window_end) for r in assign_tumbling(df, 30_000).collect())
    assert got == [(-1, -30_000, 0), (0, 0, 30_000), (29_999, 0, 30_000), (30_000, 30_000, 60_000)]
    seed = records.minmax_seed(df).filter(F.col("timestamp") == 0).first()
    assert (seed.id, seed.min, seed.max) == ("s", 1.0, 1.0)


def test_epoch_ms_independent_of_session_zone(spark):
    from tests.conftest import SF_SMALL
    from thermoflux.sources import fixtures as fx
    want = sorted(tuple(r) for r in fx.readings(spark, SF_SMALL).select("event_id", "timestamp").collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = sorted(tuple(r) for r in fx.readings(spark, SF_SMALL).select("event_id", "timestamp").collect())
            assert got == want
        # A session that never set the zone (as the driver's): it resolves to the JVM zone.
        spark.conf.unset("spark.sql.session.timeZone")
        got = sorted(tuple(r) for r in fx.readings(spark, SF_SMALL).select("event_id", "timestamp").collect())
        assert got == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert all(ts >= 1704067200000 for _, ts in want)      # all in January 2024
