"""Smoke and load checks over a lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.digest import expect_same
from orderloom.operators.expect import expect_count
from orderloom.operators.expect import violators as rows_unlike
from orderloom.operators.tablewrites import overwrite_table
from orderloom.plans.medallion import SeedSizes
from orderloom.schemas import gold_schema
from orderloom.sources.tables import Lake
from orderloom.streaming.freeze import GOLD_TABLE

GOLD_TABLES = ("order_agg", GOLD_TABLE)


def health_check(lake: Lake) -> DataFrame:
    """Write one row to the operations layer and read it back."""
    row = lake.spark.range(1).select(F.current_timestamp().alias("ts"), F.lit(1).alias("ok"))
    overwrite_table(row, lake.name("ops", "_health"), row.schema)
    found = lake.read("ops", "_health")
    expect_count(found, 1, "health check")
    return found


def check_gold(lake: Lake, expected: DataFrame, tables: Sequence[str] = GOLD_TABLES) -> None:
    """Both sides of the lake hold exactly the expected gold rows."""
    for table in tables:
        expect_same(lake.read("report", table).select(*gold_schema().fieldNames()), expected, table)


def check_load_test(lake: Lake, sizes: SeedSizes = SeedSizes(), tables: Sequence[str] = GOLD_TABLES) -> None:
    """Gold of the load-test sources: one group per customer, each with its share of the orders."""
    share = sizes.orders // sizes.customers
    for table in tables:
        gold = lake.read("report", table)
        expect_count(gold, sizes.customers, table)
        wrong = rows_unlike(gold, total_quantity=share * 6, total_value=share * 150.0, total_orders=share)
        expect_count(wrong, 0, f"{table}: groups off the expected totals")
