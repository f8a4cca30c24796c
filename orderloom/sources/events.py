"""Event-time ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_times(records: DataFrame, text: str, pattern: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> DataFrame:
    """``event_time`` of every record that carries one; malformed text raises under ANSI mode.

    The pattern's trailing Z is literal: times are UTC wall-clock and stay free of the session zone.
    """
    present = records.filter(F.col(text).isNotNull() & (F.col(text) != ""))
    return present.select(F.to_timestamp_ntz(F.col(text), F.lit(pattern)).alias("event_time"))
