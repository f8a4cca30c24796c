from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from conftest import rows
from golden import GOLD, SILVER
from orderloom import schemas
from orderloom.operators import orders
from orderloom.operators.orders import aggregate_orders, enrich_order, gold_from_bronze


def test_enrich_gives_one_row_per_line(spark, shop):
    customer, order, items, product = shop
    out = enrich_order(customer, order, items, product)
    assert out.columns == schemas.silver_schema().fieldNames()
    assertDataFrameEqual(out, spark.createDataFrame(SILVER, schemas.silver_schema()))


def test_enrich_drops_lines_without_partner(spark, shop):
    customer, order, items, product = shop
    orphan = spark.createDataFrame([(99, 1, "Item Z", 1, 1.0)], schemas.order_item_schema())
    assert enrich_order(customer, order, items.union(orphan), product).count() == 3
    assert enrich_order(customer.filter("id = 10"), order, items, product).count() == 2


def test_aggregate(spark, shop):
    silver = spark.createDataFrame(SILVER, schemas.silver_schema())
    out = aggregate_orders(silver)
    assert schemas.check_schema(out, schemas.gold_schema()).columns == out.columns
    assertDataFrameEqual(out, spark.createDataFrame(GOLD, schemas.gold_schema()))


def test_gold_from_bronze_equals_two_steps(spark, shop):
    customer, order, items, product = shop
    assertDataFrameEqual(
        gold_from_bronze(customer, order, items, product), spark.createDataFrame(GOLD, schemas.gold_schema())
    )


def test_gold_from_bronze_with_repeated_orders_and_lines(spark, shop):
    customer, order, items, product = shop
    doubled, lines = order.union(order.filter("id = 1")), items.union(items.filter("id_order = 2"))
    assertDataFrameEqual(
        gold_from_bronze(customer, doubled, lines, product),
        aggregate_orders(enrich_order(customer, doubled, lines, product)),
    )


def test_gold_from_bronze_joins_one_row_per_order(spark, shop):
    """Lines are summed before they meet the orders."""
    plan = gold_from_bronze(*shop)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner, (order_id")
    assert "Aggregate [id_order" in plan[join:]


def test_gold_in_ranges_is_gold_with_two_shuffles(spark, shop):
    """The same rows, NULL and frozen names included, dealt out by the layout without a shuffle of their own."""
    silver = orders.enrich_order(*shop)
    renamed = silver.withColumn("product_name", F.concat("product_name", F.lit(".1")))
    unnumbered = silver.withColumns({"order_id": F.lit(None).cast("int"), "country": F.lit(None).cast("string")})
    lines = silver.unionByName(silver).unionByName(renamed).unionByName(unnumbered)
    layout = ("order_date", "product_id")
    found = orders.gold_in_ranges(lines, layout)
    assert rows(found) == rows(orders.aggregate_orders(lines))
    plan = found.sortWithinPartitions(*layout)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1
    assert plan.count("Exchange hashpartitioning(customer_name") == 1
