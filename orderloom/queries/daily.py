"""Orders that arrive in batches, checked against the ledger of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import quality as q
from orderloom.plans import daily
from orderloom.queries import quality as dirty
from orderloom.queries import tables as t
from orderloom.queries.registry import query
from orderloom.queries.writes import LATE, scratch_lake, two_day_lake
from orderloom.sources.tables import Lake

BATCHES = ("2024-01-01", "2024-01-02", "2024-01-03")


def batch_of_dirty_orders(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """A third of the orders, and again every 101st of the batch before: in all the rows of ``dirty_order``."""
    clean = t.order(spark, sf_dir)
    first = clean.filter(F.pmod("id", F.lit(len(BATCHES))) == number)
    again = clean.filter((F.col("id") % 101 == 0) & (F.pmod(F.col("id") + 1, F.lit(len(BATCHES))) == number))
    return first.unionByName(again).withColumn("id", F.when(F.col("id") % 97 != 0, F.col("id")))


def three_days(spark: SparkSession, sf_dir: str) -> Lake:
    """Three batches; the second one came without its repeated orders at first, and is corrected at the end."""
    lake = scratch_lake(spark)
    batches = [batch_of_dirty_orders(spark, sf_dir, number) for number in range(len(BATCHES))]
    partial = batches[1].filter("id % 101 <> 0 OR id IS NULL")
    for name, orders in zip((*BATCHES, BATCHES[1]), (batches[0], partial, batches[2], batches[1]), strict=True):
        daily.load_order_batch(lake, orders, name, rules=q.order_rules(t.DIRTY_LIMIT))
    return lake


@query(dirty.INVALID_SQL)
def duplicate_ids_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine after three days: both copies of an order are in it, whichever day they came on."""
    return dirty.flat_quarantine(three_days(spark, sf_dir).read(*daily.QUARANTINE))


@query(dirty.VALID_SQL)
def valid_orders_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return three_days(spark, sf_dir).read(*daily.VALID).drop(daily.BATCH)


@query(LATE)
def freeze_two_days_by_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``freeze_two_days`` through the daily run, with silver behind a bitmap index."""
    lake = two_day_lake(spark, sf_dir, run=lambda lake, day: daily.run_day(lake, day, silver_span_shift=2))
    return lake.read("report", "order_agg")
