"""Sensor-stream views over the driver's ``events`` table.

``events(event_id, ts TIMESTAMP_NTZ, user_id, event_type, value, props)`` is
mapped to the reference's stream records.  One fixture time unit ``K_MS``
(6 hours) stands for one reference-second, because each fixture user has about
one event per 11 hours; window sizes, delays, lateness and the watermark tick
are passed as multiples of it.

Every view is a projection/filter of the parquet scan, so Catalyst prunes the
unused columns and pushes the ``event_type`` predicates into the reader.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoflux.functions.temporal import epoch_ms_of_ntz, floor_div
from thermoflux.schema import SMOKE_HIGH, SMOKE_LOW
from thermoflux.sources.tables import read_table

# Fixed values of the fixture mapping (must match the oracle definitions).
K_MS = 21_600_000            # one reference-second
LATE_MODULUS = 10            # every 10th event is delayed by a large amount
LATE_MULTIPLIER = 7919       # delay = (event_id * 7919) % 31 units for those
LATE_SPREAD = 31
SMALL_DELAY_MODULUS = 4      # the others are delayed by event_id % 4 units
SMOKE_HIGH_ABOVE = 100.0     # smoke level is HIGH when temperature > 100
SWITCH_BASE_UNITS = 10       # switch duration = K * (10 + (event_id % 3) * 25)
SWITCH_STEP_UNITS = 25
SWITCH_MODULUS = 3
TRIPLE_V_MODULUS = 100
TRIPLE_C_MODULUS = 7


@dataclass(frozen=True)
class ReplayConfig:
    """Time parameters of the replay model (defaults = reference values in fixture units)."""
    unit_ms: int = K_MS
    delay_units: int = 5        # bounded out-of-orderness
    lateness_units: int = 5     # allowed lateness
    tick_units: int = 1         # periodic watermark interval

    @property
    def delay_ms(self) -> int:
        return self.delay_units * self.unit_ms

    @property
    def lateness_ms(self) -> int:
        return self.lateness_units * self.unit_ms

    @property
    def tick_ms(self) -> int:
        return self.tick_units * self.unit_ms


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _reading_cols(ev: DataFrame) -> list[Column]:
    return [
        F.col("event_id"),
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        epoch_ms_of_ntz("ts").alias("timestamp"),
        (F.col("value") * F.lit(2)).alias("temperature"),
    ]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as readings ``(event_id, id, timestamp, temperature)``, no late rows."""
    ev = events(spark, sf_dir)
    return ev.select(*_reading_cols(ev))


def arrival_delay_units(event_id: Column) -> Column:
    return (
        F.when(F.pmod(event_id, F.lit(LATE_MODULUS)) == 0,
               F.pmod(event_id * F.lit(LATE_MULTIPLIER), F.lit(LATE_SPREAD)))
        .otherwise(F.pmod(event_id, F.lit(SMALL_DELAY_MODULUS)))
    )


def arrival_readings(spark: SparkSession, sf_dir: str, cfg: ReplayConfig = ReplayConfig()) -> DataFrame:
    """Readings with an arrival time and watermark tick.

    ``arrival = timestamp + unit * delay(event_id)``; ``tick = floor(arrival / tick_ms)``;
    arrival order is ``(arrival, event_id)``.
    """
    base = readings(spark, sf_dir)
    arrival = F.col("timestamp") + F.lit(cfg.unit_ms) * arrival_delay_units(F.col("event_id"))
    return (base.withColumn("arrival", arrival)
            .withColumn("tick", floor_div("arrival", cfg.tick_ms)))


def smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoke levels ``(event_id, level, timestamp)`` from error events."""
    ev = events(spark, sf_dir).filter(F.col("event_type") == "error")
    level = F.when(F.col("value") * F.lit(2) > F.lit(SMOKE_HIGH_ABOVE), F.lit(SMOKE_HIGH)).otherwise(F.lit(SMOKE_LOW))
    return ev.select("event_id", level.alias("level"), epoch_ms_of_ntz("ts").alias("timestamp"))


def alert_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).filter(F.col("event_type") != "error")
    return ev.select(*_reading_cols(ev))


def switches(spark: SparkSession, sf_dir: str, unit_ms: int = K_MS) -> DataFrame:
    """Forwarding switches ``(event_id, id, timestamp, duration_ms)`` from signup events."""
    ev = events(spark, sf_dir).filter(F.col("event_type") == "signup")
    duration = F.lit(unit_ms) * (F.lit(SWITCH_BASE_UNITS)
                                 + F.pmod(F.col("event_id"), F.lit(SWITCH_MODULUS)) * F.lit(SWITCH_STEP_UNITS))
    return ev.select(
        "event_id",
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        epoch_ms_of_ntz("ts").alias("timestamp"),
        duration.cast("long").alias("duration_ms"),
    )


def switch_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).filter(F.col("event_type") != "signup")
    return ev.select(*_reading_cols(ev))


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer triples ``(event_id, k, v, c)``; ``event_id`` is the arrival sequence."""
    return events(spark, sf_dir).select(
        "event_id",
        F.col("user_id").cast("long").alias("k"),
        F.pmod(F.col("event_id"), F.lit(TRIPLE_V_MODULUS)).cast("long").alias("v"),
        F.pmod(F.col("event_id"), F.lit(TRIPLE_C_MODULUS)).cast("long").alias("c"),
    )
