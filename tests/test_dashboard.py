from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom import schemas
from orderloom.operators.latest import latest_names, latest_revision
from orderloom.plans import dashboard as d

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


@pytest.fixture
def gold(spark):
    data = [
        ("Ann", "US", D1, 1, "P1", 1, "C1", 1, 10.0, 1),
        ("Bob", "UK", D2, 1, "P1.1", 1, "C1", 1, 20.0, 1),
        ("Ann", "US", D2, 2, "P2.9", 2, "C2", 1, 5.0, 2),
        ("Ann", "US", D2, 2, "P2.10", 2, "C2", 1, 7.0, 1),
        ("Cy", "DE", D3, 1, "P1.2", 1, "C1", 1, 40.0, 1),
        ("Cy", "DE", D3, None, "??", 1, "C1", 1, 99.0, 1),
    ]
    return spark.createDataFrame(data, schemas.gold_schema())


def test_latest_name_breaks_ties_by_text(gold):
    assert rows(latest_names(gold)) == [(1, "P1.2"), (2, "P2.9")]


def test_latest_name_equals_ranking(gold):
    ranked = gold.filter("product_id IS NOT NULL").selectExpr(
        "product_id",
        "product_name",
        "ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY order_date DESC, product_name DESC) AS rn",
    )
    assert rows(latest_names(gold)) == rows(ranked.filter("rn = 1").drop("rn"))


def test_dataset_binds_names_from_all_of_gold(gold):
    """The range ends before the last rename, yet its name is shown."""
    ds = d.dashboard_dataset(gold, "2024-01-01", "2024-01-02")
    assert {(r["product"], r["product_name"]) for r in ds.collect()} == {
        ("P1.2", "P1"),
        ("P1.2", "P1.1"),
        ("P2.9", "P2.9"),
        ("P2.9", "P2.10"),
    }
    assert d.kpi_value(ds).first()[0] == 42.0
    assert d.kpi_orders(ds).first()[0] == 5
    assert d.kpi_customers(ds).first()[0] == 2
    assert rows(d.daily_by(ds, "product")) == [(D1, "P1.2", 10.0), (D2, "P1.2", 20.0), (D2, "P2.9", 12.0)]
    assert rows(d.filter_values(ds, "category")) == [("C1",), ("C2",)]


def test_filters(gold):
    ds = d.dashboard_dataset(gold, "2024-01-01", "2024-01-31")
    assert d.filter_dashboard(ds).count() == 5
    assert d.filter_dashboard(ds, country=["US"], product=["P2.9"]).count() == 2
    assert d.filter_dashboard(ds, customer=["Nobody"]).isEmpty()


def test_default_range_is_the_last_year(spark, gold):
    today = spark.range(1).select(F.current_date()).first()[0]
    shifted = gold.withColumn(
        "order_date", F.when(F.col("order_date") == D1, F.add_months(F.current_date(), -13)).otherwise(F.lit(today))
    )
    assert d.in_date_range(shifted).count() == 5


def test_unknown_dimension(gold):
    with pytest.raises(ValueError):
        d.daily_by(gold, "weekday")


def test_latest_revision_ignores_undated(spark):
    revisions = spark.createDataFrame(
        [("a", "one", "2024-01-01"), ("a", "two", "2024-02-01"), ("a", "three", None), ("b", None, "2024-01-01")],
        "pipeline_id string, name string, change_time string",
    )
    assert rows(latest_revision(revisions)) == [("a", "two"), ("b", None)]
