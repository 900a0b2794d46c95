"""Sinks: keyed upsert of bars, report CSV files, tick-store appends."""
