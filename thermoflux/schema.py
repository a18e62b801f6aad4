"""Record schemas of the sensor streams and the operator outputs."""

from pyspark.sql import types as T

# A sensor reading: id, epoch-ms event time, temperature (°F at the source).
READING = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("temperature", T.DoubleType(), False),
])

# Replay rows carry a stable sequence number and an arrival time besides the reading.
REPLAY_READING = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("id", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("temperature", T.DoubleType(), False),
    T.StructField("arrival", T.LongType(), False),
])

SMOKE = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("level", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
])

SWITCH = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("id", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("duration_ms", T.LongType(), False),
])

TRIPLE = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("k", T.LongType(), False),
    T.StructField("v", T.LongType(), False),
    T.StructField("c", T.LongType(), False),
])

# Fixed smoke levels of the alert example.
SMOKE_LOW = "LOW"
SMOKE_HIGH = "HIGH"
