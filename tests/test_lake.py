"""End to end: batch and streaming over small source tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

import golden
from conftest import rows
from orderloom import schemas
from orderloom.operators import quality as q
from orderloom.operators.expect import ExpectationFailed, differences, expect_count, expect_equal, expect_none, violators
from orderloom.operators.tablewrites import append_new, merge_update, overwrite_table
from orderloom.plans import medallion as m
from orderloom.plans.checks import check_gold, check_load_test, health_check
from orderloom.session import scratch_path
from orderloom.streaming import freeze

SMALL = m.SeedSizes(customers=500, products=100, orders=100, per_day=5000)


def seed_example(spark, lake):
    tables = {
        "customer": (golden.CUSTOMERS, schemas.customer_schema()),
        "product": (golden.LAKE_PRODUCTS, schemas.product_schema()),
        "order": (golden.LAKE_ORDERS, schemas.order_schema()),
        "order_item": (golden.LAKE_ITEMS, schemas.order_item_schema()),
    }
    for name, (data, schema) in tables.items():
        overwrite_table(spark.createDataFrame(data, schema), lake.name(m.SOURCE, name), schema)


EXPECTED = golden.LAKE_GOLD


def gold_of(lake, table="order_agg"):
    return lake.read("report", table).select(*schemas.gold_schema().fieldNames())


def test_batch_and_stream_give_the_expected_gold(spark, lake):
    seed_example(spark, lake)
    m.run_day(lake, "2023-01-02")
    freeze.refresh(lake, scratch_path(spark, "offsets"))
    check_gold(lake, spark.createDataFrame(EXPECTED, schemas.gold_schema()))
    assert lake.read("raw", "order_quarantine").count() == 4


def test_repeated_order_with_lines_differs_between_the_sides(spark, lake):
    """Batch quarantines every copy; the stream keeps both, which doubles the sums of that order."""
    seed_example(spark, lake)
    spark.createDataFrame([(3, 1, "Item D", 1, 5.0)], schemas.order_item_schema()).write.insertInto(
        lake.name(m.SOURCE, "order_item")
    )
    m.run_day(lake, "2023-01-02")
    freeze.refresh(lake, scratch_path(spark, "offsets"))
    assert gold_of(lake).filter("product_id = 3").isEmpty()
    third = gold_of(lake, freeze.GOLD_TABLE).filter("product_id = 3").first()
    assert (third["total_quantity"], third["total_value"], third["total_orders"]) == (2, 10.0, 1)


def test_gate_stops_the_run_but_keeps_the_quarantine(spark, lake):
    seed_example(spark, lake)
    with pytest.raises(q.QuarantineRatioExceeded):
        m.load_bronze_orders(lake, fail_ratio=0.5)
    assert lake.read("raw", "order_quarantine").count() == 4
    assert not spark.catalog.tableExists(f"{lake.database('raw')}.order")
    assert m.load_bronze_orders(lake, fail_ratio=0.67) == (2, 4, pytest.approx(4 / 6))


def test_two_seeded_days_freeze_names_and_rerun_changes_nothing(spark, lake):
    offsets = scratch_path(spark, "offsets")
    m.seed_sources(lake, "2024-01-01", SMALL)
    m.run_day(lake, "2024-01-01")
    freeze.refresh(lake, offsets)
    totals = {r["table"]: r["rows"] for r in m.seed_sources(lake, "2024-01-02", SMALL).collect()}
    assert totals == {"customer": 500, "order": 5100, "order_item": 5300}
    m.run_day(lake, "2024-01-02")
    freeze.refresh(lake, offsets)

    names = gold_of(lake).filter("product_id = 3").groupBy("product_name").agg(F.max("order_date"), F.min("order_date"))
    assert {r["product_name"]: r[1:] for r in names.collect()}["Product 3.1"] == (date(2024, 1, 2), date(2024, 1, 2))
    assert gold_of(lake).filter("product_id = 3 AND product_name = 'Product 3'").count() > 0
    expect_equal(lake.read("curated", "order_enriched"), lake.read(*freeze.SILVER))
    expect_equal(gold_of(lake), gold_of(lake, freeze.GOLD_TABLE))

    before = {name: rows(lake.read(*name)) for name in (("curated", "order_enriched"), ("report", "order_agg"))}
    again = {r["table"]: r["rows"] for r in m.seed_sources(lake, "2024-01-02", SMALL).collect()}
    assert again == totals
    m.run_day(lake, "2024-01-02")
    freeze.refresh(lake, offsets)
    for name, content in before.items():
        assert rows(lake.read(*name)) == content
    expect_equal(gold_of(lake), gold_of(lake, freeze.GOLD_TABLE))
    moved = lake.read(m.SOURCE, "customer").filter("id BETWEEN 51 AND 100")
    assert [r[0] for r in moved.select("country").distinct().collect()] == ["UK"]


def test_incremental_lines_equal_the_full_copy(spark, lake):
    offsets = scratch_path(spark, "offsets")
    seed_example(spark, lake)
    items = lake.name(m.SOURCE, "order_item")
    m.load_bronze_items(lake)
    for number in (4, 5):
        m.load_bronze_items(lake, offsets)
        expect_equal(lake.read("raw", "order_item"), lake.read(m.SOURCE, "order_item"))
        more = spark.createDataFrame([(number, 1, "Item X", 1, 1.0)], schemas.order_item_schema())
        more.write.insertInto(items)
    m.run_day(lake, "2023-01-02", checkpoints=offsets)
    expect_equal(lake.read("raw", "order_item"), lake.read(m.SOURCE, "order_item"))
    assertDataFrameEqual(gold_of(lake), spark.createDataFrame(EXPECTED, schemas.gold_schema()))
    m.load_bronze_items(lake)
    m.load_bronze_items(lake, offsets)
    expect_equal(lake.read("raw", "order_item"), lake.read(m.SOURCE, "order_item"))


def test_appended_orders_equal_the_recomputed_view(spark, lake):
    """Through both refreshes, with orders and lines that arrive in between, silver and gold are the same."""
    offsets = scratch_path(spark, "offsets")
    seed_example(spark, lake)
    freeze.refresh(lake, offsets, append_orders=True)
    late = spark.createDataFrame(
        [(4, 10, 7.0, "2023-01-03", 1), (None, 10, 7.0, "2023-01-03", 1), (5, None, 7.0, "2023-01-03", 1)],
        schemas.order_schema(),
    )
    late.write.insertInto(lake.name(m.SOURCE, "order"))
    lines = spark.createDataFrame([(4, 1, "Item E", 1, 7.0), (5, 1, "Item F", 1, 7.0)], schemas.order_item_schema())
    lines.write.insertInto(lake.name(m.SOURCE, "order_item"))
    before = lake.read(*freeze.ORDERS).count()
    freeze.refresh(lake, offsets, append_orders=True)
    assert lake.read(*freeze.ORDERS).count() == before + 1
    expect_equal(lake.read(*freeze.ORDERS), freeze.identified_orders(lake.read(m.SOURCE, "order")))
    silver, gold = rows(lake.read(*freeze.SILVER)), rows(gold_of(lake, freeze.GOLD_TABLE))
    assert any(4 in r for r in silver) and not any("Item F" in r for r in silver)
    freeze.refresh(lake, offsets)  # recomputed
    assert (rows(lake.read(*freeze.SILVER)), rows(gold_of(lake, freeze.GOLD_TABLE))) == (silver, gold)


def test_backlog_in_several_batches(spark, lake):
    offsets = scratch_path(spark, "offsets")
    rows_in = spark.range(0, 100, 1, 10).selectExpr(
        "CAST(id AS INT) id_order", "1 AS seq", "'x' AS desc_item", "1 AS qty", "CAST(1 AS FLOAT) total_item"
    )
    rows_in.write.saveAsTable(lake.name(m.SOURCE, "order_item"))
    freeze.stream_items(lake, offsets, files_per_batch=3)
    expect_equal(lake.read(*freeze.ITEMS), lake.read(m.SOURCE, "order_item"))
    table = lake.name(*freeze.ITEMS)
    folder = spark.sql(f"SHOW TBLPROPERTIES {table}").filter("key LIKE '%checkpoint'").first()["value"]
    assert spark.read.text(f"{folder}/commits").select(F.input_file_name()).distinct().count() == 4


def test_seeding_before_the_epoch_is_refused(spark, lake):
    m.seed_sources(lake, "2024-01-01", SMALL)
    with pytest.raises(ValueError):
        m.seed_sources(lake, "2023-12-31", SMALL)


def test_late_line_is_dropped_by_the_stream(spark, lake):
    """A line that arrives before its order is consumed without result and not retried."""
    offsets = scratch_path(spark, "offsets")
    seed_example(spark, lake)
    items = lake.name(m.SOURCE, "order_item")
    spark.createDataFrame([(4, 1, "Item E", 1, 7.0)], schemas.order_item_schema()).write.insertInto(items)
    freeze.refresh(lake, offsets)
    late = spark.createDataFrame([(4, 10, 7.0, "2023-01-03", 1)], schemas.order_schema())
    append_new(late, lake.name(m.SOURCE, "order"), schemas.order_schema(), ["id"])
    freeze.refresh(lake, offsets)
    assert lake.read(*freeze.SILVER).filter("order_id = 4").isEmpty()
    freeze.refresh(lake, offsets, full_refresh=True)
    assert lake.read(*freeze.SILVER).filter("order_id = 4").count() == 1


def test_stream_freezes_and_full_refresh_restates(spark, lake):
    offsets = scratch_path(spark, "offsets")
    seed_example(spark, lake)
    freeze.refresh(lake, offsets)
    rename = spark.createDataFrame([(1, "Product 1.1", 0.0, 1, "x")], schemas.product_schema())
    merge_update(rename, lake.name(m.SOURCE, "product"), ["product_id"], ["name"])
    freeze.refresh(lake, offsets)
    assert gold_of(lake, freeze.GOLD_TABLE).filter("product_name = 'Product 1'").count() == 1
    freeze.refresh(lake, offsets, full_refresh=True)
    assert gold_of(lake, freeze.GOLD_TABLE).filter("product_name = 'Product 1.1'").count() == 1
    assert gold_of(lake, freeze.GOLD_TABLE).count() == 2
    freeze.refresh(lake, offsets)
    assert lake.read(*freeze.SILVER).count() == 3


def test_load_test_invariants(spark, lake):
    """Customer determines product, so there are 500 groups; each holds orders / 500 orders."""
    sizes = m.SeedSizes(orders=20_000)
    m.seed_load_test(lake, sizes)
    m.run_day(lake, "2024-01-01")
    freeze.refresh(lake, scratch_path(spark, "offsets"))
    check_load_test(lake, sizes)
    assert violators(gold_of(lake), total_quantity=240, total_value=6000.0, total_orders=40).isEmpty()
    expect_none(gold_of(lake), F.col("country") != "USA")
    with pytest.raises(ExpectationFailed):
        check_load_test(lake, m.SeedSizes(orders=20_500))


def test_health_check(lake):
    for _ in range(2):
        assert health_check(lake).first()["ok"] == 1


def test_expectations_report_failures(spark):
    two = spark.createDataFrame([(1, "a"), (1, "a")], "k int, v string")
    one = two.limit(1)
    with pytest.raises(ExpectationFailed):
        expect_count(two, 1)
    with pytest.raises(ExpectationFailed):
        expect_none(two, F.col("k") == 1)
    with pytest.raises(ExpectationFailed):
        expect_equal(two, one)
    assert rows(differences(two, one)) == [(1, "a", 1)]
    assert violators(spark.createDataFrame([(None,), (1,)], "k int"), k=1).count() == 1
    expect_equal(two, two.repartition(3))
