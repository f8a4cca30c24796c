"""Order enrichment and the gold rollup, shared by the batch and the streaming side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import silver_schema

SILVER_COLUMNS = silver_schema().fieldNames()

GOLD_KEYS = (
    "customer_name",
    "country",
    "order_date",
    "product_id",
    "product_name",
    "product_category_id",
    "category_name",
)


def book_orders(customer: DataFrame, order: DataFrame, product: DataFrame) -> DataFrame:
    """Orders with the attributes of their customer and product, one row per order.

    The dimensions are joined here, at order grain, because an order has one customer and one
    product: the lines, several times as many, then shuffle once instead of three times.
    """
    heads = order.select(
        F.col("id").alias("order_id"),
        F.col("id_customer").alias("customer_id"),
        "product_id",
        F.col("total").alias("order_total"),
        F.col("date").cast("date").alias("order_date"),
    )
    buyers = customer.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"), "country")
    goods = product.select(
        "product_id",
        F.col("name").alias("product_name"),
        F.col("category_id").alias("product_category_id"),
        "category_name",
    )
    return heads.join(buyers, "customer_id").join(goods, "product_id")


def enrich_order(customer: DataFrame, order: DataFrame, order_item: DataFrame, product: DataFrame) -> DataFrame:
    """One row per order line; lines without order, customer or product drop out.

    ``order_item`` may be a stream; the other three are then read static at each trigger.
    """
    lines = order_item.select(
        F.col("id_order").alias("order_id"),
        F.col("seq").alias("item_seq"),
        F.col("desc_item").alias("item_description"),
        F.col("qty").alias("item_quantity"),
        F.col("total_item").alias("item_total"),
    )
    return lines.join(book_orders(customer, order, product), "order_id").select(*SILVER_COLUMNS)


def aggregate_orders(enriched: DataFrame) -> DataFrame:
    """Gold: quantity, value and distinct orders per report dimension."""
    return enriched.groupBy(*GOLD_KEYS).agg(
        F.sum("item_quantity").alias("total_quantity"),
        F.sum("item_total").alias("total_value"),
        F.countDistinct("order_id").alias("total_orders"),
    )


def gold_in_ranges(enriched: DataFrame, layout: Sequence[str]) -> DataFrame:
    """``aggregate_orders``, its rows in ranges of the gold keys that begin with ``layout``.

    Lines are summed per order and dimension first, which combines map-side and makes an order one row of its group;
    these rows are dealt to ranges of the gold keys, where they are summed again without a further shuffle. There are
    as many ranges as shuffle partitions, which are set by data size.
    """
    orders = enriched.groupBy(*GOLD_KEYS, "order_id").agg(
        F.sum("item_quantity").alias("_quantity"), F.sum("item_total").alias("_value")
    )
    counted = orders.select(*GOLD_KEYS, "_quantity", "_value", F.when(F.col("order_id").isNotNull(), 1).alias("_order"))
    tasks = int(enriched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counted.repartitionByRange(tasks, *layout, *(k for k in GOLD_KEYS if k not in layout))
    return ranged.groupBy(*GOLD_KEYS).agg(
        F.sum("_quantity").alias("total_quantity"),
        F.sum("_value").alias("total_value"),
        F.count("_order").alias("total_orders"),
    )


def gold_from_bronze(customer: DataFrame, order: DataFrame, order_item: DataFrame, product: DataFrame) -> DataFrame:
    """The gold rollup of ``enrich_order`` without building silver."""
    return gold_from_booked(book_orders(customer, order, product), order_item)


def gold_from_booked(booked: DataFrame, order_item: DataFrame) -> DataFrame:
    """Gold from orders that already carry their attributes, and the lines.

    Every gold key is an attribute of the order, so lines are summed per order first. That sum
    combines map-side, which also takes the weight off an order holding a large share of the lines,
    and it leaves one row per order to join. Repeated order rows still multiply the sums and
    still count once as an order, exactly as in the two-step form.
    """
    per_order = order_item.groupBy(F.col("id_order").alias("order_id")).agg(
        F.sum("qty").alias("quantity"), F.sum("total_item").alias("value")
    )
    return (
        booked.join(per_order, "order_id")
        .groupBy(*GOLD_KEYS)
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.sum("value").alias("total_value"),
            F.countDistinct("order_id").alias("total_orders"),
        )
    )
