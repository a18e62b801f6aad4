"""Sources: table readers and the sensor-stream views derived from ``events``."""

from thermoflux.sources.fixtures import (
    K_MS,
    ReplayConfig,
    alert_readings,
    arrival_readings,
    events,
    readings,
    smoke,
    switch_readings,
    switches,
    triples,
)
from thermoflux.sources.tables import read_table

__all__ = [
    "K_MS", "ReplayConfig", "read_table", "events", "readings", "arrival_readings", "smoke",
    "alert_readings", "switches", "switch_readings", "triples",
]
