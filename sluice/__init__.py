"""Snapshot, quality-gate and event-stream analytics written on PySpark."""

__version__ = "0.1.0"
