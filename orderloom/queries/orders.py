"""Silver, gold, filters and order-level scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.columns import clipped, label_or, starred, week_of
from orderloom.operators.orders import aggregate_orders, book_orders, gold_from_bronze
from orderloom.queries import tables as t
from orderloom.queries.registry import query
from orderloom.streaming.freeze import identified_orders

_GOLD_PLAIN = t.sql("SELECT * FROM gold_plain", "gold_plain")


@query(t.sql("SELECT * FROM silver", "silver"))
def silver_order_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.silver(spark, sf_dir)


@query(_GOLD_PLAIN)
def gold_order_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold straight from bronze, lines summed per order before the join."""
    return gold_from_bronze(
        t.customer(spark, sf_dir), t.order(spark, sf_dir), t.order_item(spark, sf_dir), t.product(spark, sf_dir)
    )


@query(_GOLD_PLAIN)
def gold_from_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_orders(t.silver(spark, sf_dir))


@query(
    t.sql(
        "SELECT o.id AS order_id, o.id_customer AS customer_id, o.product_id, o.total AS order_total,"
        " CAST(o.date AS DATE) AS order_date, c.name AS customer_name, c.country, p.name AS product_name,"
        " p.category_id AS product_category_id, p.category_name FROM ord o JOIN cust c ON o.id_customer = c.id"
        " JOIN prod p ON o.product_id = p.product_id",
        "cust",
        "prod",
        "ord",
    )
)
def booked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer and product attributes, the static side of the streaming join."""
    return book_orders(t.customer(spark, sf_dir), t.order(spark, sf_dir), t.product(spark, sf_dir))


@query(t.sql("SELECT * FROM ord WHERE date = '1998-06-15'", "ord"))
def orders_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.order(spark, sf_dir).filter(F.col("date") == "1998-06-15")


@query(t.sql("SELECT * FROM gold WHERE order_date = DATE '1998-06-15'", "gold"))
def gold_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.gold(spark, sf_dir).filter(F.col("order_date") == F.to_date(F.lit("1998-06-15")))


@query(t.sql("SELECT * FROM dirty WHERE id IS NOT NULL AND id_customer IS NOT NULL", "dirty"))
def orders_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified_orders(t.dirty_order(spark, sf_dir))


@query(t.sql("SELECT id, CAST(date AS DATE) AS order_date FROM ord", "ord"))
def order_date_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.order(spark, sf_dir).select("id", F.col("date").cast("date").alias("order_date"))


@query(t.sql("SELECT COUNT(*) AS orders FROM ord", "ord"))
def order_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.order(spark, sf_dir).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "SELECT p_partkey, CASE WHEN length(label) > 18 THEN substr(label, 1, 15) || '...' ELSE label END AS clipped,"
    " CASE WHEN p_size % 7 = 0 THEN 'Unnamed' ELSE label END AS labelled,"
    " CASE WHEN p_size > 25 THEN p_brand || '*' ELSE p_brand END AS starred"
    " FROM (SELECT *, p_brand || ' ' || p_name AS label FROM part)"
)
def part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat_ws(" ", "p_brand", "p_name")
    blank = F.when(F.col("p_size") % 14 == 0, F.lit("")).when(F.col("p_size") % 7 != 0, label)
    return t.load(spark, sf_dir, "part").select(
        "p_partkey",
        clipped(label, 18, 15).alias("clipped"),
        label_or(blank, "Unnamed").alias("labelled"),
        starred(F.col("p_brand"), F.col("p_size") > 25).alias("starred"),
    )


@query(
    "SELECT o_orderkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week,"
    " CAST(date_trunc('day', o_orderdate) AS DATE) AS day, CAST(o_orderdate AS DATE) - 30 AS month_before,"
    " CAST(CAST(o_orderdate AS DATE) - DATE '2024-01-01' AS INTEGER) AS offset_days FROM orders"
)
def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        week_of(day).alias("week"),
        F.date_trunc("DAY", "o_orderdate").cast("date").alias("day"),
        F.date_sub(day, 30).alias("month_before"),
        F.datediff(day, F.to_date(F.lit("2024-01-01"))).alias("offset_days"),
    )
