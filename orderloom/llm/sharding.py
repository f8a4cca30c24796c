"""Contiguous shards of equal bytes from global prefix sums.

Rows are ranged by id. Each partition's total gives, by a prefix sum over the partitions, the bytes and
rows before it; a running sum inside the partition does the rest, so no task ever sees more than its
own partition. The cuts lie at equal targets of the total size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import prepare, staged_once

SHARDS = 40
OVERHEAD = 16

#: Rows of a range partition, about.
PARTITION_ROWS = 1_000_000
LEAST_PARTITIONS = 32


def byte_shards(rows: DataFrame, order_by: list[str], shards: int = SHARDS, size_col: str = "size") -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1, contiguous in ``order_by``) and ``slot`` in it, from 0.

    A row belongs to the shard in whose stretch of the total its middle byte lies, so shards differ from
    the target by less than their outermost rows. Ties of ``order_by`` are broken by the place in the
    input, so even a table of equal rows spreads. An empty table gives an empty result; columns called
    ``shard`` and ``slot`` are replaced.
    """
    spark = prepare(rows.sparkSession)
    parts = LEAST_PARTITIONS + rows.count() // PARTITION_ROWS
    ranged = (
        rows.drop("shard", "slot")
        .withColumn("_in", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order_by, "_in")
        .sortWithinPartitions(*order_by, "_in")
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
        .drop("_in")
    )
    ranged = staged_once(ranged, "ranged")
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    totals = ranged.groupBy(F.col("_part").alias("_of")).agg(F.sum(size_col).alias("_bytes"), F.count("*").alias("_rows"))
    totals = staged_once(
        totals.select(
            "_of",
            "_bytes",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        ),
        "partition-totals",
    )
    total = totals.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    so_far = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.select(
        "*", F.sum(size_col).over(so_far).alias("_end"), F.row_number().over(so_far).alias("_row")
    ).join(totals, F.col("_part") == F.col("_of"))
    middle = 2 * (F.col("_bytes_before") + F.col("_end")) - F.col(size_col)
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(max(1, 2 * total)).cast("decimal(20,0)")))
    placed = staged_once(
        summed.withColumn("shard", shard.cast("int")).withColumn("_row", F.col("_row") + F.col("_rows_before") - 1)
        .drop("_of", "_bytes", "_bytes_before", "_rows_before", "_end", "_part", "_at"),
        "placed",
    )
    firsts = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("_row").alias("_first"))
    return (
        placed.join(F.broadcast(firsts), F.col("shard") == F.col("_shard"))  # a row for each shard
        .withColumn("slot", F.col("_row") - F.col("_first"))
        .drop("_row", "_shard", "_first")
    )


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every document, by the ``bytes`` law.

    ``size`` is the text's UTF-8 bytes (null: none) and 16 more. Texts themselves are not moved. Null ids
    come first; repeated rows are all placed.
    """
    sized = docs.select(
        id_col,
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return byte_shards(sized, [id_col, "text_crc32"], shards).select(
        id_col,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
