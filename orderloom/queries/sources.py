"""Scans, generators and payload flatteners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.columns import EPOCH_DAY
from orderloom.operators.orders import gold_from_bronze
from orderloom.queries import tables as t
from orderloom.queries.registry import query
from orderloom.schemas import IDS_WIDE
from orderloom.sources import generate as g
from orderloom.sources.costfeed import flatten_cost_json
from orderloom.sources.costvariant import read_cost_documents
from orderloom.sources.events import event_times
from orderloom.sources.runs import run_summary, runs_on_day

SEED_DAY = "2024-06-30"


@query(t.sql("SELECT * FROM cust", "cust"))
def source_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.customer(spark, sf_dir)


@query(t.sql("SELECT * FROM prod", "prod"))
def source_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.product(spark, sf_dir)


@query(t.sql("SELECT * FROM ord", "ord"))
def source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.order(spark, sf_dir)


@query(t.sql("SELECT * FROM item", "item"))
def source_order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.order_item(spark, sf_dir)


def _numbers(spark: SparkSession, sf_dir: str, table: str, key: str) -> DataFrame:
    return t.load(spark, sf_dir, table).select((F.col(key) + 1).alias("id"))


_BANDS = (
    "CASE WHEN place <= 200 THEN 'US' WHEN place <= 300 THEN 'UK' WHEN place <= 350 THEN 'DE'"
    " WHEN place <= 400 THEN 'FR' WHEN place <= 430 THEN 'BR' WHEN place <= 455 THEN 'CA'"
    " WHEN place <= 475 THEN 'AU' WHEN place <= 490 THEN 'JP' WHEN place <= 497 THEN 'MX' ELSE 'IN' END"
)


@query(
    f"SELECT id, 'Customer_' || CAST(id AS VARCHAR) AS name, {_BANDS} AS country"
    " FROM (SELECT c_custkey + 1 AS id, c_custkey % 500 + 1 AS place FROM customer)"
)
def generated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gen_customers(_numbers(spark, sf_dir, "customer", "c_custkey"), IDS_WIDE)


@query(
    "SELECT id AS product_id, 'Product ' || CAST(id AS VARCHAR) AS name,"
    " CAST(category * 5.0 + 4.99 AS FLOAT) AS unit_price, CAST(category AS INTEGER) AS category_id,"
    " 'Category ' || CAST(category AS VARCHAR) AS category_name"
    " FROM (SELECT p_partkey + 1 AS id, p_partkey % 10 + 1 AS category FROM part)"
)
def generated_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gen_products(_numbers(spark, sf_dir, "part", "p_partkey"), IDS_WIDE)


@query(
    "SELECT id, (id - 1) % 500 + 1 AS id_customer, CAST((id % 99 + 1) * 10 AS FLOAT) AS total,"
    " strftime(DATE '2024-06-30' - CAST(id % 363 AS INTEGER), '%Y-%m-%d') AS date, id % 100 + 1 AS product_id"
    " FROM (SELECT o_orderkey + 1 AS id FROM orders)"
)
def generated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gen_orders(_numbers(spark, sf_dir, "orders", "o_orderkey"), SEED_DAY, IDS_WIDE)


_ITEMS = (
    "(SELECT o_orderkey + 1 AS ord, seq, o_orderkey * 3 + seq AS item"
    " FROM orders CROSS JOIN (SELECT unnest([1, 2, 3]) AS seq))"
)


@query(
    "SELECT ord AS id_order, seq, 'Item_' || CAST(item AS VARCHAR) AS desc_item,"
    " CAST((item * 7 + 3) % 5 + 1 AS INTEGER) AS qty,"
    " CAST(ROUND((ord % 10 + 1) * 15.0 + ((item * 7919) % 1000) / 100.0, 2) AS FLOAT) AS total_item"
    f" FROM {_ITEMS}"
)
def generated_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gen_order_items(_numbers(spark, sf_dir, "orders", "o_orderkey"), IDS_WIDE)


def _slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of slots for every 5,000 orders."""
    key = F.col("o_orderkey")
    day = F.date_add(F.lit(EPOCH_DAY), F.floor(key / 5000).cast("int"))
    return t.load(spark, sf_dir, "orders").select(day.alias("seed_date"), (key % 5000 + 1).alias("slot"))


_SLOT_SQL = (
    "(SELECT 2000000 + (o_orderkey // 5000) * 5000 + o_orderkey % 5000 + 1 AS id,"
    " DATE '2024-01-01' + CAST(o_orderkey // 5000 AS INTEGER) AS seed_date FROM orders)"
)


@query(
    "SELECT id, (id - 1) % 500 + 1 AS id_customer, CAST((id % 99 + 1) * 10 AS FLOAT) AS total,"
    f" strftime(seed_date, '%Y-%m-%d') AS date, id % 100 + 1 AS product_id FROM {_SLOT_SQL}"
)
def generated_day_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gen_day_orders(_slots(spark, sf_dir), IDS_WIDE)


@query(
    "SELECT id AS id_order, 1 AS seq, 'Item_incr_' || CAST(id AS VARCHAR) AS desc_item,"
    " CAST((id * 7 + 3) % 5 + 1 AS INTEGER) AS qty,"
    " CAST(ROUND((id % 10 + 1) * 15.0 + ((id * 7919) % 1000) / 100.0, 2) AS FLOAT) AS total_item"
    f" FROM {_SLOT_SQL}"
)
def generated_day_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gen_day_items(_slots(spark, sf_dir), IDS_WIDE)


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "events").select(F.to_date("ts").alias("seed_date")).distinct()


_DAYS = "(SELECT DISTINCT CAST(ts AS DATE) AS seed_date, CAST(ts AS DATE) - DATE '2024-01-01' AS off FROM events)"


@query(
    "SELECT seed_date, id, 'Customer_' || CAST(id AS VARCHAR) AS name,"
    " ['US','UK','CA','DE','FR','BR','AU','JP','MX','IN'][off % 10 + 1] AS country FROM"
    f" (SELECT seed_date, off, CAST((off * 50 + step) % 500 + 1 AS BIGINT) AS id FROM {_DAYS}"
    " CROSS JOIN (SELECT unnest(range(50)) AS step))"
)
def generated_country_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gen_country_updates(event_days(spark, sf_dir), IDS_WIDE)


@query(
    "SELECT seed_date, id AS product_id,"
    " 'Product ' || CAST(id AS VARCHAR) || '.' || CAST(off // 50 + 1 AS VARCHAR) AS name,"
    " CAST(((id - 1) % 10 + 1) * 5.0 + 4.99 AS FLOAT) AS unit_price, CAST((id - 1) % 10 + 1 AS INTEGER) AS category_id,"
    " 'Category ' || CAST((id - 1) % 10 + 1 AS VARCHAR) AS category_name FROM"
    f" (SELECT seed_date, off, CAST((off * 2 + step) % 100 + 1 AS BIGINT) AS id FROM {_DAYS}"
    " CROSS JOIN (SELECT unnest(range(2)) AS step))"
)
def generated_rename_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.gen_rename_updates(event_days(spark, sf_dir), IDS_WIDE)


@query(
    "SELECT 'Customer_' || CAST(cust AS VARCHAR) AS customer_name, 'USA' AS country, DATE '2024-01-01' AS order_date,"
    " product AS product_id, 'Product ' || CAST(product AS VARCHAR) AS product_name,"
    " CAST((product - 1) % 10 + 1 AS INTEGER) AS product_category_id,"
    " 'Category ' || CAST((product - 1) % 10 + 1 AS VARCHAR) AS category_name,"
    " COUNT(*) * 6 AS total_quantity, CAST(COUNT(*) * 150 AS DOUBLE) AS total_value, COUNT(*) AS total_orders"
    " FROM (SELECT o_orderkey % 500 + 1 AS cust, (o_orderkey + 1) % 100 + 1 AS product FROM orders) GROUP BY cust, product"
)
def load_test_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over load-test rows, one order per order of the test data."""
    numbers = _numbers(spark, sf_dir, "orders", "o_orderkey")
    return gold_from_bronze(
        g.gen_customers(g.ids(spark, g.INITIAL_CUSTOMERS), IDS_WIDE, country="USA"),
        g.gen_load_orders(numbers, IDS_WIDE),
        g.gen_load_items(numbers, IDS_WIDE),
        g.gen_products(g.ids(spark, g.INITIAL_PRODUCTS), IDS_WIDE, unit_price=25.0),
    )


@query(t.sql("SELECT * FROM cloud_cost", "cloud_cost"))
def flattened_cost_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_cost_json(t.cost_documents(spark, sf_dir))


def drifting_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost documents as they drift: amounts as numbers, other fields, lone periods; and copies that were cut off."""
    payload, form = F.col("payload"), F.pmod(F.crc32(F.col("payload").cast("binary")), F.lit(5))
    numbers = F.regexp_replace(payload, '"Amount":"([0-9.]+)"', '"Amount":$1,"Unit":"USD"')
    lone = F.regexp_replace(payload, r'^\{"ResultsByTime":\[(.*)\]\}$', '{"Version":2,"ResultsByTime":$1}')
    other = F.regexp_replace(F.regexp_replace(payload, "BlendedCost", "UnblendedCost"), r'"Keys":\["([^"]*)"\]', '"Keys":"$1"')
    shaped = F.when(form == 1, numbers).when(form == 2, lone).when(form == 3, other).otherwise(payload)
    documents = t.cost_documents(spark, sf_dir)
    cut = documents.select(F.substring("payload", 1, 40).alias("payload"))
    return documents.select(shaped.alias("payload")).unionByName(cut)


@query(t.sql("SELECT * FROM cloud_cost", "cloud_cost"))
def drifting_cost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as from documents of one shape."""
    return read_cost_documents(drifting_documents(spark, sf_dir))[0]


@query("SELECT 'not JSON' AS problem, COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS documents FROM lineitem")
def cost_document_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    problems = read_cost_documents(drifting_documents(spark, sf_dir))[1]
    return problems.groupBy("problem").agg(F.count(F.lit(1)).alias("documents"))


@query(t.sql("SELECT * FROM day_runs", "day_runs"))
def job_runs_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_on_day(t.runs(spark, sf_dir), "2024-01-12")


@query(t.sql("SELECT COUNT(*) AS runs, COUNT(DISTINCT job_id) AS jobs FROM day_runs", "day_runs"))
def job_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(runs_on_day(t.runs(spark, sf_dir), "2024-01-12"))


@query(t.sql("SELECT event_time FROM stars", "stars"))
def parsed_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_times(t.starred(spark, sf_dir), "starred_at")
