"""The stream-static join with an account of the lines that it drops.

A line whose order, customer or product is not there when its micro-batch runs is dropped for good. Here every
micro-batch writes its joined lines, its dropped lines with the reason, and their numbers, each under the batch's id:
a batch that runs again replaces what it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import schemas
from orderloom.operators.orders import enrich_order
from orderloom.operators.tablewrites import ensure_table, replace_partition, table_exists
from orderloom.session import materialize
from orderloom.sources.tables import Lake
from orderloom.streaming.freeze import ITEMS

JOINED = ("curated", "order_enriched_accounted")
DROPPED = ("ops", "dropped_lines")
ACCOUNT = ("ops", "line_account")
BATCH = "batch"
_OFFSETS = "orderloom.account.checkpoint"

NO_ORDER, NO_CUSTOMER, NO_PRODUCT = "no order", "no customer", "no product"


def _by_batch(*fields: T.StructField) -> T.StructType:
    return T.StructType([*fields, T.StructField(BATCH, T.LongType())])


def _shapes(lake: Lake) -> dict[tuple[str, str], T.StructType]:
    counts = [T.StructField(c, T.LongType()) for c in ("lines", "matched", "dropped", "joined_rows")]
    reason = T.StructField("reason", T.StringType())
    return {
        JOINED: _by_batch(*schemas.silver_schema(lake.ids)),
        DROPPED: _by_batch(*schemas.order_item_schema(lake.ids), reason),
        ACCOUNT: _by_batch(*counts),
    }


def judged_lines(customer: DataFrame, order: DataFrame, order_item: DataFrame, product: DataFrame) -> DataFrame:
    """Lines plus ``reason``: what is missing for them, or NULL; a line is one row, also when its order repeats.

    Of repeated orders the best counts: the line is joined if any of them has its customer and product.
    """
    buyers = customer.select(F.col("id").alias("id_customer"), F.lit(True).alias("_buyer")).distinct()
    goods = product.select("product_id", F.lit(True).alias("_good")).distinct()
    heads = order.filter(F.col("id").isNotNull()).join(buyers, "id_customer", "left").join(goods, "product_id", "left")
    lacking = F.when(F.col("_buyer").isNull(), 2).when(F.col("_good").isNull(), 1).otherwise(0)
    best = heads.groupBy(F.col("id").alias("id_order")).agg(F.min(lacking).alias("_lacking"))
    reason = (
        F.when(F.col("_lacking").isNull(), NO_ORDER).when(F.col("_lacking") == 2, NO_CUSTOMER).when(F.col("_lacking") == 1, NO_PRODUCT)
    )
    return order_item.join(best, "id_order", "left").select(*order_item.columns, reason.alias("reason"))


def write_batch(lake: Lake, lines: DataFrame, batch: int) -> None:
    """Join one micro-batch and account for it. The lines are judged once, in a written frame.

    The static side is read as it is now. All three writes replace the batch, the numbers last: a batch with numbers
    is complete. Joined and dropped lines are written once, where they are computed.
    """
    customer, order, product = (lake.read("raw", f"{t}_sdp") for t in ("customer", "order", "product"))
    judged = materialize(judged_lines(customer, order, lines, product), "judged-lines")
    matched = judged.filter(F.col("reason").isNull()).drop("reason")
    here, shapes = Row(**{BATCH: batch}), _shapes(lake)
    replace_partition(enrich_order(customer, order, matched, product), lake.name(*JOINED), shapes[JOINED], here)
    replace_partition(judged.filter(F.col("reason").isNotNull()), lake.name(*DROPPED), shapes[DROPPED], here)
    joined = judged.sparkSession.table(lake.name(*JOINED)).filter(F.col(BATCH) == batch)
    numbers = judged.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("reason").isNull()).alias("matched"),
        F.count_if(F.col("reason").isNotNull()).alias("dropped"),
    )
    numbers = numbers.withColumn("joined_rows", joined.agg(F.count(F.lit(1))).scalar())
    replace_partition(numbers, lake.name(*ACCOUNT), shapes[ACCOUNT], here)


def stream_silver_accounted(
    lake: Lake, checkpoints: str, full_refresh: bool = False, files_per_batch: int | None = None
) -> None:
    """Consume the lines that arrived since the last run, batch by batch, into the three tables."""
    spark, shapes = lake.spark, _shapes(lake)
    if full_refresh:
        for name in shapes:
            spark.sql(f"DROP TABLE IF EXISTS {lake.name(*name)}")
    folder = _offsets(lake, checkpoints)
    for name, shape in shapes.items():
        ensure_table(spark, lake.name(*name), shape, partition_by=(BATCH,))
    spark.sql(f"ALTER TABLE {lake.name(*ACCOUNT)} SET TBLPROPERTIES ('{_OFFSETS}' = '{folder}')")
    query = (
        lake.read_stream(*ITEMS, files_per_batch=files_per_batch)
        .writeStream.foreachBatch(lambda lines, batch: write_batch(lake, lines, batch))
        .option("checkpointLocation", folder)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _offsets(lake: Lake, checkpoints: str) -> str:
    """The checkpoint folder that the account goes on from; a new one when the tables are new."""
    table = lake.name(*ACCOUNT)
    if table_exists(lake.spark, table):
        found = lake.spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == _OFFSETS).collect()
        if found:
            return found[0]["value"]
    return f"{checkpoints.rstrip('/')}/account-{uuid.uuid4().hex}"
