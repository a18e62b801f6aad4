"""One registered query per operator of the reference, over the fixture tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names and types match the oracle SQL in :mod:`thermoflux.plans.oracle`.
Parameters are the reference's values in fixture units (``K`` = one
reference-second, see :mod:`thermoflux.sources.fixtures`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoflux.operators import connect, lateness, records, replay, rolling, triggers, windows
from thermoflux.sources import fixtures as fx

K = fx.K_MS
CFG = fx.ReplayConfig()


def _reading_cols(df: DataFrame) -> DataFrame:
    return df.select("event_id", "id", "timestamp", "temperature")


def q_src_readings(spark: SparkSession, sf: str) -> DataFrame:
    return _reading_cols(fx.readings(spark, sf))


def q_src_smoke(spark: SparkSession, sf: str) -> DataFrame:
    return fx.smoke(spark, sf)


def q_filter_temp(spark: SparkSession, sf: str) -> DataFrame:
    return records.filter_temperature(fx.readings(spark, sf), records.FILTER_THRESHOLD)


def q_map_id(spark: SparkSession, sf: str) -> DataFrame:
    return records.map_id(fx.readings(spark, sf))


def q_f_to_c(spark: SparkSession, sf: str) -> DataFrame:
    return records.to_celsius(fx.readings(spark, sf))


def q_split_id(spark: SparkSession, sf: str) -> DataFrame:
    return records.split_id(fx.readings(spark, sf))


def q_freezing_main(spark: SparkSession, sf: str) -> DataFrame:
    main, _ = records.freezing_monitor(fx.readings(spark, sf))
    return main


def q_freezing_alarms(spark: SparkSession, sf: str) -> DataFrame:
    _, alarms = records.freezing_monitor(fx.readings(spark, sf))
    return alarms


def q_avg_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    out = windows.avg_tumbling(fx.readings(spark, sf), 1 * K)
    # Averages depend on summation order: compare at 6 decimals.
    return out.select("id", "timestamp", F.round("temperature", 6).alias("temperature"))


def q_minmax_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return windows.minmax_tumbling(fx.readings(spark, sf), 5 * K)


def _replayed(spark: SparkSession, sf: str):
    rows = fx.arrival_readings(spark, sf, CFG)
    return replay.replay(rows, CFG.delay_ms)


def q_count_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return lateness.on_time_window_counts(*_replayed(spark, sf), 10 * K)


def q_late_side_output(spark: SparkSession, sf: str) -> DataFrame:
    return lateness.late_side_output(*_replayed(spark, sf), 10 * K)


def q_late_filter_main(spark: SparkSession, sf: str) -> DataFrame:
    return lateness.late_reading_split(*_replayed(spark, sf))[0]


def q_late_filter_late(spark: SparkSession, sf: str) -> DataFrame:
    return lateness.late_reading_split(*_replayed(spark, sf))[1]


def q_updating_count(spark: SparkSession, sf: str) -> DataFrame:
    return lateness.updating_window_counts(*_replayed(spark, sf), 10 * K, CFG.lateness_ms)


def _thirty_units(rows: DataFrame, ts_col: str) -> DataFrame:
    """The custom assigner of the custom-window program."""
    return windows.assign_tumbling(rows, 30 * K, ts_col)


def q_custom_window_count(spark: SparkSession, sf: str) -> DataFrame:
    return lateness.on_time_window_counts(*_replayed(spark, sf), _thirty_units)


def q_early_firing_count(spark: SparkSession, sf: str) -> DataFrame:
    return triggers.early_firing_counts(*_replayed(spark, sf), _thirty_units, CFG.tick_ms)


def q_rolling_sum(spark: SparkSession, sf: str) -> DataFrame:
    return rolling.rolling_sum(fx.triples(spark, sf))


def q_rolling_max(spark: SparkSession, sf: str) -> DataFrame:
    return rolling.rolling_max(fx.readings(spark, sf))


def q_fire_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return connect.fire_alerts(fx.alert_readings(spark, sf), fx.smoke(spark, sf))


def q_forward_switch(spark: SparkSession, sf: str) -> DataFrame:
    return connect.forward_switch(fx.switch_readings(spark, sf), fx.switches(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "src_readings": q_src_readings,
    "src_smoke": q_src_smoke,
    "filter_temp": q_filter_temp,
    "map_id": q_map_id,
    "f_to_c": q_f_to_c,
    "split_id": q_split_id,
    "freezing_main": q_freezing_main,
    "freezing_alarms": q_freezing_alarms,
    "avg_tumbling": q_avg_tumbling,
    "minmax_tumbling": q_minmax_tumbling,
    "count_tumbling": q_count_tumbling,
    "late_side_output": q_late_side_output,
    "late_filter_main": q_late_filter_main,
    "late_filter_late": q_late_filter_late,
    "updating_count": q_updating_count,
    "custom_window_count": q_custom_window_count,
    "early_firing_count": q_early_firing_count,
    "rolling_sum": q_rolling_sum,
    "rolling_max": q_rolling_max,
    "fire_alerts": q_fire_alerts,
    "forward_switch": q_forward_switch,
}

FLAGSHIP = "avg_tumbling"
