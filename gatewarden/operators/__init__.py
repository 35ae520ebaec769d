"""Detections: pure functions from a ``Warehouse`` to a DataFrame.

All follow one shape: filter the events, aggregate them on narrow keys (Spark
combines map-side, so a hot key leaves each task as one row), apply the
threshold, and only then join the dimensions to what is left.
"""

FLOOR = "2025-01-01"
