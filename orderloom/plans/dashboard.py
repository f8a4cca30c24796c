"""Dashboard queries over gold."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.latest import latest_names

DIMENSIONS = ("country", "customer", "product", "category")
DAILY = ("country", "product", "category")
TOTALS = "totals"


def in_date_range(gold: DataFrame, date_from: str | date | None = None, date_to: str | date | None = None) -> DataFrame:
    """Gold rows dated within the range, both ends included; defaults to the last year up to today."""
    low = F.to_date(F.lit(date_from)) if date_from else F.add_months(F.current_date(), -12)
    high = F.to_date(F.lit(date_to)) if date_to else F.current_date()
    return gold.filter(F.col("order_date").between(low, high))


def with_latest_name(gold: DataFrame, names: DataFrame) -> DataFrame:
    """Gold rows with the current name of their product; rows without product id drop out."""
    return gold.join(names, "product_id")


def dashboard_dataset(
    gold: DataFrame, date_from: str | date | None = None, date_to: str | date | None = None
) -> DataFrame:
    """The dashboard's base relation: a renamed product appears under its current name.

    The current name comes from all of gold, not only from the date range shown.
    """
    named = with_latest_name(in_date_range(gold, date_from, date_to), latest_names(gold))
    return named.groupBy(
        "order_date",
        "country",
        F.col("customer_name").alias("customer"),
        F.col("latest_name").alias("product"),
        "product_name",
        F.col("category_name").alias("category"),
    ).agg(F.sum("total_value").alias("total_value"), F.sum("total_orders").alias("total_orders"))


def filter_dashboard(
    dataset: DataFrame,
    country: Sequence[str] = (),
    customer: Sequence[str] = (),
    product: Sequence[str] = (),
    category: Sequence[str] = (),
) -> DataFrame:
    """Multi-select filters; an empty selection keeps everything."""
    for column, chosen in zip(DIMENSIONS, (country, customer, product, category)):
        if chosen:
            dataset = dataset.filter(F.col(column).isin(list(chosen)))
    return dataset


def filter_values(dataset: DataFrame, dimension: str) -> DataFrame:
    """The entries of one filter list."""
    if dimension not in DIMENSIONS:
        raise ValueError(f"unknown dimension {dimension}")
    return dataset.select(dimension).distinct()


def kpi_value(dataset: DataFrame) -> DataFrame:
    return dataset.agg(F.sum("total_value").alias("total_value"))


def kpi_orders(dataset: DataFrame) -> DataFrame:
    """Sum of the per-group order counts: an order split over two frozen names counts twice."""
    return dataset.agg(F.sum("total_orders").alias("total_orders"))


def kpi_customers(dataset: DataFrame) -> DataFrame:
    return dataset.agg(F.countDistinct("customer").alias("num_customers"))


def daily_by(dataset: DataFrame, dimension: str) -> DataFrame:
    """Value per day and entry of one dimension."""
    if dimension not in DIMENSIONS:
        raise ValueError(f"unknown dimension {dimension}")
    day = F.date_trunc("DAY", F.col("order_date")).cast("date")
    return dataset.groupBy(day.alias("day"), dimension).agg(F.sum("total_value").alias("total_value"))


def widgets(dataset: DataFrame) -> DataFrame:
    """(widget, day, label, total_value, total_orders, num_customers): every number of the dashboard from one pass.

    ``totals`` is one row with the three totals; the widgets ``DAILY`` have a row for each day and entry. Grouping sets
    combine map-side, and customers are a grouping set of their own, counted afterwards from its one row each,
    so that no distinct count multiplies the rows of the others.
    """
    day = F.date_trunc("DAY", F.col("order_date")).cast("date")
    sets = [[], *(["day", dimension] for dimension in DAILY), ["customer"]]
    grouped = (
        dataset.withColumn("day", day)
        .groupingSets(sets, "day", *DAILY, "customer")
        .agg(
            F.grouping_id("day", *DAILY, "customer").alias("_set"),
            F.sum("total_value").alias("total_value"),
            F.sum("total_orders").alias("total_orders"),
        )
    )
    columns = ("day", *DAILY, "customer")

    def number(chosen: list[str]) -> int:
        """The grouping id: a bit for each column that is not in the set, the first column's the highest."""
        return int("".join("0" if c in chosen else "1" for c in columns), 2)

    widget, label = F.lit(TOTALS), F.lit(None).cast("string")
    for dimension in DAILY:
        here = F.col("_set") == number(["day", dimension])
        widget, label = F.when(here, dimension).otherwise(widget), F.when(here, F.col(dimension)).otherwise(label)
    customers = F.col("_set") == number(["customer"])
    totals = F.col("_set") == number([])
    named = grouped.select(
        widget.alias("widget"),
        "day",
        label.alias("label"),
        F.when(~customers, F.col("total_value")).alias("total_value"),
        F.when(~customers, F.col("total_orders")).alias("total_orders"),
        F.when(customers & F.col("customer").isNotNull(), 1).when(customers | totals, 0).alias("num_customers"),
    )
    return named.groupBy("widget", "day", "label").agg(
        *(F.sum(c).alias(c) for c in ("total_value", "total_orders", "num_customers"))
    )
