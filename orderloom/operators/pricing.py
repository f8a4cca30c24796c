"""Pricing usage rows against a price list with validity intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _versions(list_prices: DataFrame) -> DataFrame:
    return list_prices.select(
        F.col("sku_name").alias("_sku"),
        F.col("price_start_time").alias("_from"),
        F.col("price_end_time").alias("_until"),
        F.col("pricing.effective_list.default").alias("effective_price"),
    )


def _in_force(moment: Column) -> Column:
    """Half-open validity: the version that starts at a boundary applies there."""
    return (moment >= F.col("_from")) & (F.col("_until").isNull() | (moment < F.col("_until")))


def price_usage(usage: DataFrame, list_prices: DataFrame) -> DataFrame:
    """Usage left-joined to the price version in force at ``usage_end_time``.

    Adds ``effective_price`` and ``priced``; usage without a version stays, unpriced. One plan for any
    size: the optimiser broadcasts a list whose real size allows it, and otherwise adaptive execution
    splits the usage of a hot SKU, which is the preserved side.
    """
    condition = (F.col("sku_name") == F.col("_sku")) & _in_force(F.col("usage_end_time"))
    joined = usage.join(_versions(list_prices), condition, "left")
    return joined.select(*usage.columns, "effective_price", F.col("_sku").isNotNull().alias("priced"))


def price_totals(list_prices: DataFrame) -> DataFrame:
    """Per (sku_name, cloud): number of versions and the sum of their list prices."""
    return list_prices.groupBy("sku_name", "cloud").agg(
        F.count(F.lit(1)).alias("versions"), F.sum("pricing.default").alias("price_sum")
    )
