"""Incremental refresh.

The metric has no streaming semantics (no event-time windows, watermarks or
late data): its refresh is a scheduled rebuild.  `refresh` recomputes the
snapshots touched by new data and overwrites only those mart partitions.
"""
