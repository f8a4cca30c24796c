"""Cloud cost payloads: nested JSON documents to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import week_of

# Shape of one cost document (fixed by its producer).
COST_DOCUMENT = """
ResultsByTime ARRAY<STRUCT<
  TimePeriod: STRUCT<Start: STRING>,
  Estimated: BOOLEAN,
  Groups: ARRAY<STRUCT<
    Keys: ARRAY<STRING>,
    Metrics: STRUCT<BlendedCost: STRUCT<Amount: STRING>>>>>>
"""


def flatten_cost_json(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """(date, service, blended_cost_usd, estimated, week), one row per period and group.

    Text that is not JSON raises: a silently skipped document would understate the bill.
    """
    parsed = F.from_json(F.col(payload), COST_DOCUMENT, {"mode": "FAILFAST"})
    periods = documents.select(F.explode(parsed["ResultsByTime"]).alias("period"))
    return flatten_periods(periods, F.col("period"))


def flatten_periods(periods: DataFrame, period: Column) -> DataFrame:
    groups = periods.select(
        period["TimePeriod"]["Start"].alias("date"),
        F.coalesce(period["Estimated"], F.lit(False)).alias("estimated"),
        F.explode(period["Groups"]).alias("grp"),
    )
    return groups.select(
        "date",
        F.col("grp")["Keys"][0].alias("service"),
        F.col("grp")["Metrics"]["BlendedCost"]["Amount"].cast("double").alias("blended_cost_usd"),
        "estimated",
        week_of(F.col("date")).alias("week"),
    )
