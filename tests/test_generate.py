from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom import schemas
from orderloom.plans import medallion as m
from orderloom.sources import generate as g


def test_customers_follow_the_country_mix(spark):
    customers = g.gen_customers(g.ids(spark, 500))
    assert customers.schema.fieldNames() == schemas.customer_schema().fieldNames()
    counts = {r["country"]: r["count"] for r in customers.groupBy("country").count().collect()}
    assert counts == {"US": 200, "UK": 100, "DE": 50, "FR": 50, "BR": 30, "CA": 25, "AU": 20, "JP": 15, "MX": 7, "IN": 3}


def test_products(spark):
    products = schemas.check_schema(g.gen_products(g.ids(spark, 100)), schemas.product_schema())
    assert rows(products.filter("product_id IN (1, 10, 11)")) == [
        (1, "Product 1", pytest.approx(9.99), 1, "Category 1"),
        (10, "Product 10", pytest.approx(54.99), 10, "Category 10"),
        (11, "Product 11", pytest.approx(9.99), 1, "Category 1"),
    ]


def test_orders_and_items(spark):
    numbers = g.ids(spark, 1000)
    orders = schemas.check_schema(g.gen_orders(numbers, "2024-06-30"), schemas.order_schema())
    items = schemas.check_schema(g.gen_order_items(numbers), schemas.order_item_schema())
    assert tuple(orders.filter("id = 5").first()) == (5, 5, 60.0, "2024-06-25", 6)
    assert orders.agg(F.min("date"), F.max("date")).first()[:] == ("2023-07-04", "2024-06-30")
    assert items.count() == 3000 and items.select("id_order", "seq").distinct().count() == 3000
    assert items.filter("qty NOT BETWEEN 1 AND 5").isEmpty()
    assert items.select("desc_item").distinct().count() == 3000


def test_noise_does_not_depend_on_partitions(spark):
    a = g.gen_order_items(spark.range(1, 500, 1, 1))
    b = g.gen_order_items(spark.range(1, 500, 1, 7))
    assert rows(a) == rows(b)


def test_a_day_of_orders(spark):
    slots = g.day_slots(spark, "2024-01-01")
    orders = schemas.check_schema(g.gen_day_orders(slots), schemas.order_schema())
    items = schemas.check_schema(g.gen_day_items(slots), schemas.order_item_schema())
    assert orders.count() == items.count() == 5000
    assert [r[0] for r in orders.select("date").distinct().collect()] == ["2024-01-01"]
    assert orders.agg(F.min("id"), F.max("id")).first()[:] == (2_000_001, 2_005_000)
    assert items.join(orders, items["id_order"] == orders["id"], "left_anti").isEmpty()


def test_days_are_disjoint(spark):
    first = g.gen_day_orders(g.day_slots(spark, "2024-01-01"))
    second = g.gen_day_orders(g.day_slots(spark, "2024-01-02"))
    assert first.join(second, "id", "left_semi").isEmpty()


def test_country_updates(spark):
    for offset, country, block in ((0, "US", range(1, 51)), (3, "DE", range(151, 201)), (10, "US", range(1, 51))):
        day = date(2024, 1, 1) + timedelta(days=offset)
        found = g.gen_country_updates(g.single_day(spark, day)).collect()
        assert {r["id"] for r in found} == set(block)
        assert {r["country"] for r in found} == {country}


def test_rename_suffix_counts_selections(spark):
    """The closed form against counting the days one by one."""
    chosen = [[(d * 2 + i) % 100 + 1 for i in range(2)] for d in range(131)]
    expected = {
        (d, p, f"Product {p}.{sum(p in earlier for earlier in chosen[: d + 1])}") for d in range(131) for p in chosen[d]
    }
    days = spark.range(131).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("seed_date"))
    found = {
        ((r["seed_date"] - date(2024, 1, 1)).days, r["product_id"], r["name"])
        for r in g.gen_rename_updates(days).collect()
    }
    assert found == expected


def test_first_day_renames_end_in_one(spark):
    found = g.gen_rename_updates(g.single_day(spark, "2024-01-01")).drop("seed_date")
    assert [r["name"] for r in schemas.check_schema(found, schemas.product_schema()).collect()] == [
        "Product 1.1",
        "Product 2.1",
    ]


def test_days_before_the_epoch_are_rejected(spark):
    with pytest.raises(Exception, match="seed dates start"):
        g.gen_day_orders(g.day_slots(spark, "2023-12-31")).collect()


def test_days_follow_the_seed_whatever_its_size(spark, lake):
    """A day's ids start behind the seeded orders, so a larger seed plus a day grows by exactly a day."""
    sizes = m.SeedSizes(customers=1000, products=50, orders=2400, per_day=10)
    m.seed_sources(lake, "2024-01-02", sizes)
    order = lake.read(m.SOURCE, "order")
    assert order.agg(F.max("id_customer"), F.max("product_id")).first() == (1000, 50)
    m.seed_sources(lake, "2024-01-03", sizes)
    m.seed_sources(lake, "2024-01-03", sizes)
    assert lake.read(m.SOURCE, "order").count() == 2410
    with pytest.raises(m.ForeignIds):
        m.seed_day(lake, "2024-01-03", m.SeedSizes(customers=1000, products=50, orders=2000, per_day=10))
