"""Batch forms of the reference's operators (DataFrame in, DataFrame out)."""

from thermoflux.operators import connect, lateness, outputs, records, replay, rolling, scan, triggers, windows

__all__ = ["connect", "lateness", "outputs", "records", "replay", "rolling", "scan", "triggers", "windows"]
