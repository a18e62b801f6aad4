"""Column-expression helpers (all JVM-side, codegen friendly)."""

from thermoflux.functions.temporal import (
    epoch_ms_of_ntz,
    floor_div,
    to_event_time,
    window_end,
    window_start,
)
from thermoflux.functions.text import (
    alert_message,
    fahrenheit_to_celsius,
    freezing_message,
    reading_text,
    split_java,
)

__all__ = [
    "epoch_ms_of_ntz", "floor_div", "to_event_time", "window_start", "window_end",
    "split_java", "reading_text", "alert_message", "freezing_message", "fahrenheit_to_celsius",
]
