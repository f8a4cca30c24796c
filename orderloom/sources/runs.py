"""Run history of scheduled jobs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import clipped, day_start_ms, from_epoch_ms, label_or


def runs_on_day(runs: DataFrame, day: str | date) -> DataFrame:
    """Runs that started within the UTC day, with display name, status and start time.

    ``runs`` holds job_id, name, start_time (epoch milliseconds) and status.
    """
    start = day_start_ms(day)
    that_day = runs.filter((F.col("start_time") >= start) & (F.col("start_time") < start + 86_400_000))
    return that_day.select(
        "job_id",
        clipped(label_or(F.col("name"), "Unnamed")).alias("job_name"),
        F.coalesce(F.col("status"), F.lit("UNKNOWN")).alias("status"),
        F.date_format(from_epoch_ms(F.col("start_time")), "yyyy-MM-dd HH:mm:ss").alias("started_at"),
    )


def run_summary(listed: DataFrame) -> DataFrame:
    """Number of runs, and of jobs with at least one run."""
    return listed.agg(F.count(F.lit(1)).alias("runs"), F.countDistinct("job_id").alias("jobs"))
