"""Exact distinct counts that add up: bits of ids by day beside gold.

Distinct counts of days cannot be summed to a month. Their bits can: a month's are the union of its days', and a
day that is loaded again replaces only its own. Bits are kept in words of 64 ids, a plain number each: where a group
has few ids of a wide range, a word costs no more than the id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.tablewrites import ensure_table, replace_partitions

DAY = "order_date"


def state_schema(by: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    fields = [T.StructField(name, kind) for name, kind in by]
    rest = [("measure", T.StringType()), ("word", T.LongType()), ("bits", T.LongType()), (DAY, T.DateType())]
    return T.StructType([*fields, *(T.StructField(name, kind) for name, kind in rest)])


def id_state(lines: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """(by..., measure, word, bits, order_date): for each day and group, the ids of every measured column.

    Bits combine map-side, so a row for each group, column and word of 64 ids is shuffled, however many lines
    there are. NULL ids count in no group, as in COUNT(DISTINCT).
    """
    entries = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).cast("long").alias("id")) for m in measures))
    each = lines.select(*by, DAY, F.explode(entries).alias("_e")).select(*by, DAY, "_e.measure", "_e.id")
    bit = F.expr("shiftleft(1L, CAST(id & 63 AS INT))")
    grouped = each.filter(F.col("id").isNotNull()).groupBy(*by, "measure", F.shiftright("id", 6).alias("word"), DAY)
    return grouped.agg(F.bit_or(bit).alias("bits")).select(*by, "measure", "word", "bits", DAY)


def record_days(
    spark: SparkSession, table: str, lines: DataFrame, by: Sequence[str], measures: Sequence[str], days: Sequence
) -> None:
    """Put the state of ``days``, all of whose lines are in ``lines``, in place of what the table has of them."""
    shape = state_schema([(c, lines.schema[c].dataType) for c in by])
    ensure_table(spark, table, shape, partition_by=(DAY,))
    touched = [Row(**{DAY: day}) for day in days]
    held = lines.filter(F.col(DAY).isin(list(days)))
    replace_partitions(id_state(held, by, measures), table, shape, touched)


def distinct_counts(state: DataFrame, by: Sequence[str], period: Column) -> DataFrame:
    """(period, by..., one column for each measure): exact distinct ids of the days of each period."""
    merged = state.groupBy(period.alias("period"), *by, "measure", "word").agg(F.bit_or("bits").alias("bits"))
    counts = merged.groupBy("period", *by, "measure").agg(F.sum(F.bit_count("bits").cast("long")).alias("ids"))
    return counts


def wide_counts(state: DataFrame, by: Sequence[str], period: Column, measures: Sequence[str]) -> DataFrame:
    """``distinct_counts`` with a column ``distinct_<measure>`` each; a group without ids of a measure has 0."""
    counts = distinct_counts(state, by, period)
    return counts.groupBy("period", *by).agg(
        *(F.coalesce(F.sum(F.when(F.col("measure") == m, F.col("ids"))), F.lit(0)).alias(f"distinct_{m}") for m in measures)
    )
