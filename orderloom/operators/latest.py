"""Latest value per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_names(gold: DataFrame) -> DataFrame:
    """Current name of each product: the name on its newest date, the greatest name on a tie.

    Same rows as ranking by date and name descending, but as an aggregate that combines map-side
    instead of sorting a whole product in one task.
    """
    newest = F.max(F.struct("order_date", "product_name"))["product_name"]
    return gold.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(newest.alias("latest_name"))


def latest_revision(revisions: DataFrame, key: str = "pipeline_id", name: str = "name", time: str = "change_time"):
    """One row per key with the name of its last revision, so that a join on it cannot fan out."""
    when_named = F.when(F.col(time).isNotNull(), F.struct(F.col(time), F.col(name)))
    return revisions.groupBy(key).agg(F.max_by(F.col(name), when_named).alias(name))
