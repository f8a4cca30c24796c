"""Table expectations as queries that list what is wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.digest import differences_by_digest
from orderloom.operators.expect import count_report, differences, paired, violators
from orderloom.operators.orders import GOLD_KEYS, aggregate_orders, gold_from_bronze
from orderloom.plans import medallion
from orderloom.queries import tables as t
from orderloom.queries.registry import query
from orderloom.queries.writes import LATE, dirty_sources, two_day_lake
from orderloom.schemas import IDS_WIDE
from orderloom.session import materialize
from orderloom.sources import generate
from orderloom.streaming import freeze


@query(t.sql("SELECT * FROM gold WHERE total_orders <> 1 OR total_quantity <> 30", "gold"))
def gold_violators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violators(t.gold(spark, sf_dir), total_orders=1, total_quantity=30)


@query(
    t.sql(
        "SELECT product_id, name, category_id, COUNT(*) AS n FROM prod GROUP BY ALL HAVING COUNT(*) < 1", "prod"
    )
)
def unchanged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table compared with itself in another partitioning: nothing differs."""
    goods = t.product(spark, sf_dir).select("product_id", "name", "category_id")
    return differences(goods.repartition("name"), goods).withColumnRenamed("surplus", "n")


@query(
    t.sql(
        "SELECT product_id AS id, name, CAST(-1 AS BIGINT) AS surplus FROM prod WHERE product_id % 5 = 0"
        " UNION ALL SELECT product_id, name || '.1', 1 FROM prod WHERE product_id % 5 = 0",
        "prod",
    )
)
def changed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a rename changed: the new row is surplus, the old one is missing."""
    before = t.product(spark, sf_dir).select(F.col("product_id").alias("id"), "name")
    renamed = F.when(F.col("id") % 5 == 0, F.concat("name", F.lit(".1"))).otherwise(F.col("name"))
    return differences(before.withColumn("name", renamed), before)


def _routes_sql(kept: str) -> str:
    """Gold by order sums against gold from silver lines of which only some are kept."""
    keys = ", ".join(GOLD_KEYS)
    both = " AND ".join(f"a.{k} = b.{k}" for k in GOLD_KEYS)
    either = ", ".join(f"COALESCE(a.{k}, b.{k}) AS {k}" for k in GOLD_KEYS)
    sums = (
        "SELECT c.name AS customer_name, c.country, CAST(o.date AS DATE) AS order_date, o.product_id,"
        " p.name AS product_name, p.category_id AS product_category_id, p.category_name,"
        " CAST(SUM(i.q) AS BIGINT) AS total_quantity, ROUND(SUM(i.v), 2) AS total_value FROM ord o"
        " JOIN (SELECT id_order, SUM(qty) AS q, SUM(CAST(total_item AS DOUBLE)) AS v FROM item GROUP BY id_order) i"
        " ON i.id_order = o.id JOIN cust c ON o.id_customer = c.id JOIN prod p ON o.product_id = p.product_id"
        " GROUP BY 1, 2, 3, 4, 5, 6, 7"
    )
    staged = (
        f"SELECT {keys}, CAST(SUM(item_quantity) AS BIGINT) AS total_quantity,"
        f" ROUND(SUM(CAST(item_total AS DOUBLE)), 2) AS total_value FROM silver WHERE {kept} GROUP BY {keys}"
    )
    return t.sql(
        f"SELECT {either}, a.total_quantity AS total_quantity_actual, b.total_quantity AS total_quantity_expected,"
        " a.total_value AS total_value_actual, b.total_value AS total_value_expected"
        f" FROM ({sums}) a FULL JOIN ({staged}) b ON {both}"
        " WHERE a.total_quantity IS DISTINCT FROM b.total_quantity OR a.total_value IS DISTINCT FROM b.total_value",
        "silver",
        "ord",
        "item",
        "cust",
        "prod",
    )


def _routes(spark: SparkSession, sf_dir: str, kept: str) -> DataFrame:
    parts = (
        t.customer(spark, sf_dir), t.order(spark, sf_dir), t.order_item(spark, sf_dir), t.product(spark, sf_dir)
    )
    cents = F.round("total_value", 2)
    measures = ("total_quantity", "total_value")
    direct = gold_from_bronze(*parts).withColumn("total_value", cents).select(*GOLD_KEYS, *measures)
    staged = aggregate_orders(t.silver(spark, sf_dir).filter(kept)).withColumn("total_value", cents)
    differing = differences_by_digest(materialize(direct, "direct"), materialize(staged.select(*GOLD_KEYS, *measures), "staged"))
    return paired(differing, GOLD_KEYS, measures)


@query(_routes_sql("TRUE"))
def gold_routes_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups on which both ways to gold differ, with both sums to the cent: there are none."""
    return _routes(spark, sf_dir, "TRUE")


@query(_routes_sql("item_quantity <> 50"))
def gold_routes_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same comparison when one way lost the lines of fifty pieces: their groups, named with both sums."""
    return _routes(spark, sf_dir, "item_quantity <> 50")


@query(
    t.sql(
        "SELECT id_order, seq, desc_item, qty, total_item, CAST(-1 AS BIGINT) AS surplus FROM item WHERE id_order = 33"
        " UNION ALL SELECT id_order, seq, desc_item, qty + 1, total_item, 1 FROM item WHERE id_order = 33",
        "item",
    )
)
def changed_lines_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order's lines changed among all lines: only the buckets they are in are compared row by row."""
    lines = t.order_item(spark, sf_dir)
    changed = F.when(F.col("id_order") == 33, F.col("qty") + 1).otherwise(F.col("qty"))
    return differences_by_digest(lines.withColumn("qty", changed), lines)


_KEPT = "NOT (no_id OR no_customer OR repeated)"


@query(
    t.sql(
        "SELECT *, expected = found AS as_expected FROM ("
        f"SELECT 'order' AS \"table\", COUNT(*) AS expected, COUNT(*) FILTER ({_KEPT}) AS found FROM checked"
        " UNION ALL SELECT 'customer', COUNT(*), COUNT(*) FROM customer"
        " UNION ALL SELECT 'product', COUNT(*), COUNT(*) FROM part"
        " UNION ALL SELECT 'order_item', COUNT(*), COUNT(*) FROM lineitem)",
        "checked",
    )
)
def reconciled_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the source tables against those read back from bronze: orders lack what was quarantined."""
    lake = dirty_sources(spark, sf_dir)
    medallion.load_bronze_dimensions(lake)
    medallion.load_bronze_orders(lake)
    names = ("order", "customer", "product", "order_item")
    return count_report([(n, lake.read(medallion.SOURCE, n), lake.read("raw", n)) for n in names])


@query(
    f"SELECT side AS \"table\", COUNT(*) AS \"groups\", CAST(SUM(total_quantity) AS BIGINT) AS quantity,"
    " CAST(SUM(total_orders) AS BIGINT) AS orders, CAST(0 AS BIGINT) AS differing"
    f" FROM ({LATE}) CROSS JOIN (SELECT unnest(['order_agg', 'order_agg_sdp']) AS side) GROUP BY side"
)
def gold_sides_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two days through the batch and the streaming side: both gold tables, and how many rows differ."""
    lake = two_day_lake(spark, sf_dir, streaming=True)
    cents = F.round("total_value", 2)
    sides = {n: lake.read("report", n).withColumn("total_value", cents) for n in ("order_agg", freeze.GOLD_TABLE)}
    differing = differences_by_digest(*sides.values()).agg(F.count(F.lit(1))).scalar()
    rows = None
    for name, gold in sides.items():
        row = gold.agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("groups"),
            F.sum("total_quantity").alias("quantity"),
            F.sum("total_orders").alias("orders"),
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows.withColumn("differing", differing)


@query(
    "SELECT day AS seed_date, 2000000 + (day - DATE '2024-01-01') * 5000 + 1 AS first_id,"
    " 2000000 + (day - DATE '2024-01-01') * 5000 + 5000 AS last_id, CAST(5000 AS BIGINT) AS orders,"
    " CAST(0 AS BIGINT) AS shared FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)"
)
def generated_days_are_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders generated for every day that has events: each day's range of ids, and the ids it shares with another day."""
    days = t.load(spark, sf_dir, "events").select(F.to_date("ts").alias("seed_date")).distinct()
    slots = days.withColumn("slot", F.explode(F.sequence(F.lit(1), F.lit(generate.ORDERS_PER_DAY))))
    orders = generate.gen_day_orders(slots, IDS_WIDE)
    copies = orders.groupBy("id").agg(F.min("date").alias("date"), F.countDistinct("date").alias("days"))
    return copies.groupBy(F.col("date").cast("date").alias("seed_date")).agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("days") > 1).alias("shared"),
    )


_AREAS = (("NATION_1", "north"), ("NATION_2", "north"), ("NATION_3", "south"), ("NATION_99", "nowhere"))


@query(
    t.sql(
        "SELECT COALESCE(area, 'elsewhere') AS area, COUNT(*) AS customers FROM cust LEFT JOIN (VALUES "
        + ", ".join(f"('{country}', '{area}')" for country, area in _AREAS)
        + ") AS areas(country, area) USING (country) GROUP BY 1",
        "cust",
    )
)
def customers_by_literal_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relation of literal rows in a declared shape, joined to the customers."""
    shape = T.StructType().add("country", T.StringType()).add("area", T.StringType())
    areas = spark.createDataFrame(list(_AREAS), shape)
    named = t.customer(spark, sf_dir).join(areas, "country", "left")
    return named.groupBy(F.coalesce("area", F.lit("elsewhere")).alias("area")).agg(F.count(F.lit(1)).alias("customers"))
