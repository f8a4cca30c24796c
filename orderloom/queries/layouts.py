"""Tables laid out for their joins: lines in buckets of orders, ids behind a bitmap index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators.colocated import Colocated, gold_in_place, silver_in_place
from orderloom.operators.idbitmap import IndexedTable
from orderloom.plans.medallion import SILVER_KEYS
from orderloom.queries import tables as t
from orderloom.queries.registry import query
from orderloom.queries.writes import IDS, scratch_lake

SPREAD = 1009


def bucketed(spark: SparkSession, sf_dir: str, heavy_lines: int = 6) -> Colocated:
    """Orders and lines in buckets. Here an order is heavy from seven lines on, so that both paths have rows."""
    lake = scratch_lake(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = Colocated(spark, lake.name("raw", "sales"), buckets)
    tables.write(t.order(spark, sf_dir), t.order_item(spark, sf_dir), heavy_lines)
    return tables


@query(t.sql("SELECT * FROM silver", "silver"))
def silver_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_in_place(bucketed(spark, sf_dir), t.customer(spark, sf_dir), t.product(spark, sf_dir))


@query(t.sql("SELECT * FROM gold_plain", "gold_plain"))
def gold_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_in_place(bucketed(spark, sf_dir), t.customer(spark, sf_dir), t.product(spark, sf_dir))


@query(
    t.sql(
        f"SELECT * REPLACE (order_id * {SPREAD} AS order_id, CASE WHEN order_id % 2 = 0 THEN product_name"
        " ELSE product_name || '.1' END AS product_name) FROM silver",
        "silver",
    )
)
def insert_only_merge_of_spread_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``insert_only_merge``, with order ids far apart and merged in two rounds that both reach over all of them."""
    lake = scratch_lake(spark)
    table = IndexedTable(spark, lake.name("curated", "order_enriched"), schemas.silver_schema(IDS), SILVER_KEYS, 6)
    lines = t.silver(spark, sf_dir).withColumn("order_id", F.col("order_id") * SPREAD)
    table.merge_insert_only(lines.filter("order_id % 2 = 0"))
    relabelled = lines.withColumn("product_name", F.concat("product_name", F.lit(".1")))
    table.merge_insert_only(relabelled.filter("order_id % 3 = 0"))
    table.merge_insert_only(relabelled)
    return table.read()
