"""Structured Streaming forms: built-in watermarked windows and stateful processors."""

from thermoflux.streaming.operators import (
    stream_connected,
    stream_early_firing,
    stream_fire_alerts,
    stream_forward_switch,
    stream_forward_switch_wall_clock,
    stream_freezing_monitor,
    stream_late_reading_split,
    stream_late_windows,
    stream_rolling_max,
    stream_rolling_reduce,
    stream_rolling_sum,
)
from thermoflux.streaming.sources import read_stream, replay_stream, with_event_time
from thermoflux.streaming.windowing import stream_windows
from thermoflux.streaming.windows import stream_avg_tumbling, stream_count_tumbling, stream_minmax_tumbling

__all__ = [
    "read_stream", "replay_stream", "with_event_time",
    "stream_avg_tumbling", "stream_minmax_tumbling", "stream_count_tumbling",
    "stream_rolling_sum", "stream_rolling_max", "stream_forward_switch", "stream_fire_alerts",
    "stream_late_windows", "stream_early_firing", "stream_late_reading_split", "stream_freezing_monitor",
    "stream_forward_switch_wall_clock", "stream_windows", "stream_connected", "stream_rolling_reduce",
]
