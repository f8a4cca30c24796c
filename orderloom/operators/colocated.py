"""Lines and orders in buckets of the order id, so that enriching or summing lines needs no shuffle of them.

A bucket is read by one task, which no adaptive plan can split. Orders with a great many lines are therefore kept
out of the buckets, in a table of their own that is joined like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.orders import SILVER_COLUMNS, GOLD_KEYS, book_orders, enrich_order
from orderloom.operators.tablewrites import recover, table_exists
from orderloom.session import materialize

#: Lines of one order up to which they go to its bucket.
HEAVY_LINES = 100_000


@dataclass(frozen=True)
class Colocated:
    """Three tables: orders and lines in as many buckets of the order id, and the lines of heavy orders.

    ``buckets`` should be at least the shuffle partitions of the sessions that read them: with fewer, Spark may
    prefer to shuffle. All three are written whole.
    """

    spark: SparkSession
    name: str
    buckets: int

    def _table(self, part: str) -> str:
        database, _, name = self.name.replace("`", "").rpartition(".")
        return f"`{database}`.`{name}__{part}`" if database else f"`{name}__{part}`"

    def _write(self, df: DataFrame, part: str, key: str) -> None:
        """Rows of a bucket meet in one task, so that a bucket is one file, sorted by the key."""
        table = self._table(part)
        recover(self.spark, table)
        placed = df.repartition(self.buckets, key).sortWithinPartitions(key)
        placed.write.bucketBy(self.buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)

    def write(self, order: DataFrame, order_item: DataFrame, heavy_lines: int = HEAVY_LINES) -> None:
        """Write the tables. Lines are counted per order first, which combines map-side."""
        counts = order_item.groupBy("id_order").agg(F.count(F.lit(1)).alias("_lines"))
        heavy = materialize(counts.filter(F.col("_lines") > heavy_lines).select("id_order"), "heavy-orders")
        self._write(order, "orders", "id")
        # NULL ids match no order; they would all meet in one bucket
        named = order_item.filter(F.col("id_order").isNotNull())
        self._write(named.join(heavy, "id_order", "left_anti"), "lines", "id_order")
        table = self._table("heavy")
        named.join(heavy, "id_order", "left_semi").write.mode("overwrite").saveAsTable(table)

    def exists(self) -> bool:
        return all(table_exists(self.spark, self._table(p)) for p in ("orders", "lines", "heavy"))

    @property
    def orders(self) -> DataFrame:
        return self.spark.table(self._table("orders"))

    @property
    def lines(self) -> DataFrame:
        """The lines in buckets: all but those of heavy orders."""
        return self.spark.table(self._table("lines"))

    @property
    def heavy(self) -> DataFrame:
        return self.spark.table(self._table("heavy"))


def booked_in_place(tables: Colocated, customer: DataFrame, product: DataFrame) -> DataFrame:
    """Booked orders for a join by order id: they move for the dimensions, and once more to the lines' buckets."""
    return book_orders(customer, tables.orders, product)


def silver_in_place(tables: Colocated, customer: DataFrame, product: DataFrame) -> DataFrame:
    """``enrich_order`` over the bucketed lines, which stay where they are, and the few heavy orders."""
    booked = booked_in_place(tables, customer, product)
    lines = tables.lines.select(
        F.col("id_order").alias("order_id"),
        F.col("seq").alias("item_seq"),
        F.col("desc_item").alias("item_description"),
        F.col("qty").alias("item_quantity"),
        F.col("total_item").alias("item_total"),
    )
    light = lines.join(booked, "order_id").select(*SILVER_COLUMNS)
    return light.unionByName(enrich_order(customer, tables.orders, tables.heavy, product))


def gold_in_place(tables: Colocated, customer: DataFrame, product: DataFrame) -> DataFrame:
    """Gold with the lines summed per order where they lie; only order sums are shuffled, to their gold groups.

    An order is either heavy or not, so the distinct orders of both parts add up within a group.
    """
    booked = booked_in_place(tables, customer, product)

    def summed(lines: DataFrame) -> DataFrame:
        return lines.groupBy(F.col("id_order").alias("order_id")).agg(
            F.sum("qty").alias("quantity"), F.sum("total_item").alias("value")
        )

    parts = booked.join(summed(tables.lines), "order_id").unionByName(booked.join(summed(tables.heavy), "order_id"))
    return parts.groupBy(*GOLD_KEYS).agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum("value").alias("total_value"),
        F.countDistinct("order_id").alias("total_orders"),
    )
