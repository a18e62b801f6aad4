"""Stateless per-record operators: filter, map, flatMap, side-output tagging.

All are narrow transformations (no shuffle); Catalyst pushes the filters into
the parquet scan and prunes the unused columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoflux.functions.text import fahrenheit_to_celsius, freezing_message, split_java

# Fixed thresholds of the reference programs.
FILTER_THRESHOLD = 25.0      # readings kept when temperature >= 25
FREEZING_BELOW = 32.0        # freezing alarm when temperature < 32


def filter_temperature(df: DataFrame, threshold: float = FILTER_THRESHOLD) -> DataFrame:
    """Keep readings with ``temperature >= threshold`` (inclusive).  As in Java, a comparison
    with NaN is false (Spark alone would order NaN above all numbers)."""
    return df.filter((F.col("temperature") >= F.lit(float(threshold))) & ~F.isnan("temperature"))


def map_id(df: DataFrame) -> DataFrame:
    """Project each reading to its sensor id."""
    return df.select("id")


def to_celsius(df: DataFrame, col: str = "temperature") -> DataFrame:
    """Fahrenheit → Celsius; every other column is kept."""
    return df.withColumn(col, fahrenheit_to_celsius(col))


def split_id(df: DataFrame, col: str = "id", sep: str = "_", out: str = "part") -> DataFrame:
    """One row per piece of ``col.split(sep)`` (Java semantics: trailing empties dropped)."""
    return df.select(F.explode(split_java(col, sep)).alias(out))


def minmax_seed(df: DataFrame) -> DataFrame:
    """``r → (id, t, t)``: the seed tuple of the incremental min/max reduce."""
    return df.select("id", F.col("temperature").alias("min"), F.col("temperature").alias("max"), "timestamp")


def freezing_monitor(df: DataFrame, below: float = FREEZING_BELOW) -> tuple[DataFrame, DataFrame]:
    """Main output: every reading unchanged.  Side output ``freezing-alarms``:
    ``"Freezing Alarm for <id>"`` for each reading with ``temperature < below``."""
    side_cols = [c for c in ("event_id",) if c in df.columns]
    alarms = df.filter(F.col("temperature") < F.lit(float(below))) \
        .select(*side_cols, freezing_message("id").alias("message"))
    return df, alarms
