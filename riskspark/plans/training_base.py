"""Training base with window fallback (U4, P10)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.scalar import between_times


def windowed_base(validated: DataFrame, start, end, ts: str = "event_ts") -> tuple[DataFrame, str]:
    """Rows in ``[start, end]``; when the window is empty use all rows; error when still empty."""
    w = validated.where(between_times(ts, start, end))
    if not w.isEmpty():
        return w, "window"
    if validated.isEmpty():
        raise ValueError("no training rows")
    return validated, "all_rows"
