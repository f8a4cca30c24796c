"""Streams that account for what they drop, and distinct counts that add up over days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators.distinctstate import record_days, wide_counts
from orderloom.operators.tablewrites import overwrite_table
from orderloom.plans import medallion as m
from orderloom.queries import tables as t
from orderloom.queries.registry import query
from orderloom.queries.writes import IDS, scratch_lake
from orderloom.session import materialize, scratch_path
from orderloom.sources.tables import Lake
from orderloom.streaming import account, freeze

MEASURES = ("order_id", "customer_id")


def two_batches(spark: SparkSession, sf_dir: str) -> Lake:
    """Even lines come while a third of the orders and every tenth customer are missing; odd ones when all are there."""
    lake, checkpoints = scratch_lake(spark), scratch_path(spark, "offsets")
    source, lines = m.SOURCE, t.order_item(spark, sf_dir)
    orders, people = t.order(spark, sf_dir), t.customer(spark, sf_dir)
    overwrite_table(t.product(spark, sf_dir), lake.name(source, "product"), schemas.product_schema(IDS))
    for number, (known, there) in enumerate((("id % 3 <> 0", "id % 10 <> 0"), ("TRUE", "TRUE"))):
        overwrite_table(orders.filter(known), lake.name(source, "order"), schemas.order_schema(IDS))
        overwrite_table(people.filter(there), lake.name(source, "customer"), schemas.customer_schema(IDS))
        part = lines.filter(f"id_order % 2 = {number}")
        if number == 0:
            overwrite_table(part, lake.name(source, "order_item"), schemas.order_item_schema(IDS))
        else:
            part.write.mode("append").insertInto(lake.name(source, "order_item"))
        freeze.refresh_dimension_views(lake)
        freeze.stream_items(lake, checkpoints)
        account.stream_silver_accounted(lake, checkpoints)
    return lake


_JUDGED = (
    "SELECT i.*, i.id_order % 2 AS batch, CASE WHEN i.id_order % 2 = 1 THEN NULL WHEN i.id_order % 3 = 0 THEN 'no order'"
    " WHEN o.id_customer % 10 = 0 THEN 'no customer' END AS reason FROM item i JOIN ord o ON i.id_order = o.id"
)


@query(
    t.sql(
        "SELECT batch, COUNT(*) AS lines, COUNT(*) FILTER (reason IS NULL) AS matched,"
        " COUNT(*) FILTER (reason IS NOT NULL) AS dropped, COUNT(*) FILTER (reason IS NULL) AS joined_rows"
        f" FROM ({_JUDGED}) GROUP BY batch",
        "item",
        "ord",
    )
)
def stream_line_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, matched lines and dropped lines of every micro-batch."""
    return two_batches(spark, sf_dir).read(*account.ACCOUNT)


@query(t.sql(f"SELECT * FROM ({_JUDGED}) WHERE reason IS NOT NULL", "item", "ord"))
def stream_dropped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_batches(spark, sf_dir).read(*account.DROPPED)


@query(
    t.sql(
        "SELECT CAST(date_trunc('month', order_date) AS DATE) AS period, country,"
        " COUNT(DISTINCT order_id) AS distinct_order_id, COUNT(DISTINCT customer_id) AS distinct_customer_id"
        " FROM silver GROUP BY 1, 2",
        "silver",
    )
)
def monthly_distinct_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly distinct orders and customers by country, from the days' bitmaps; one day is recorded twice."""
    lake, silver = scratch_lake(spark), materialize(t.silver(spark, sf_dir), "silver")
    table = lake.name("report", "daily_ids")
    days = [r[0] for r in silver.select("order_date").distinct().orderBy("order_date").collect()]
    record_days(spark, table, silver.filter("order_id % 2 = 0"), ["country"], MEASURES, days[:1])
    record_days(spark, table, silver, ["country"], MEASURES, days)
    return wide_counts(spark.table(table), ["country"], F.trunc("order_date", "month"), MEASURES)


@query(t.sql("SELECT * FROM dirty WHERE id IS NOT NULL AND id_customer IS NOT NULL", "dirty"))
def appended_order_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view of identified orders: recomputed, rebuilt as a stream, then appended to as the other half arrives."""
    lake, checkpoints = scratch_lake(spark), scratch_path(spark, "offsets")
    source, shape = lake.name(m.SOURCE, "order"), schemas.order_schema(IDS)
    orders = t.dirty_order(spark, sf_dir)
    overwrite_table(orders.filter("total < 200000"), source, shape)
    freeze.refresh_order_view(lake)
    freeze.refresh_order_view(lake, checkpoints)
    orders.filter("total >= 200000 OR total IS NULL").write.mode("append").insertInto(source)
    freeze.refresh_order_view(lake, checkpoints)
    freeze.refresh_order_view(lake, checkpoints)
    return lake.read(*freeze.ORDERS)
