"""Uniqueness of keys over batches, from a ledger of key counts.

The ledger is a table partitioned by batch: how often each key occurs in each batch. A new batch is judged
against it, so neither the rows of earlier batches nor their uniqueness are looked at again. A key that the new
batch repeats also makes its only earlier copy a repeated one, and a corrected batch may free such a copy
again: ``turned`` names the batches whose rows change sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.keys import within_key_range
from orderloom.operators.tablewrites import ensure_table, overwrite_table, replace_partitions
from orderloom.schemas import check_schema
from orderloom.session import materialize

BATCH = "batch"


@dataclass(frozen=True)
class Verdict:
    """What a batch does to the uniqueness of its keys, as written tables."""

    repeated: DataFrame  # keys of the batch's rows that occur more than once, in it or elsewhere
    turned: DataFrame  # keys, with a batch before or after it whose rows of that key change sides, and ``repeated``


@dataclass(frozen=True)
class KeyLedger:
    """Counts of ``keys`` by batch in ``table``. Keys with a NULL part are exempt and not in it."""

    spark: SparkSession
    table: str
    keys: tuple[str, ...]

    def schema(self, rows: DataFrame) -> T.StructType:
        fields = [T.StructField(k, rows.schema[k].dataType) for k in self.keys]
        return T.StructType([*fields, T.StructField("copies", T.LongType()), T.StructField(BATCH, T.StringType())])

    def _counted(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.keys).na.drop("any").groupBy(*self.keys).agg(F.count(F.lit(1)).alias("copies"))

    def judge(self, rows: DataFrame, batch: str) -> Verdict:
        """Compare ``rows``, all of the batch, with the ledger as it is; whatever it holds of this batch is replaced.

        Reads ``rows`` and, of the ledger, this batch and the key columns in the key range of both. Copies of a
        key combine map-side before they meet.
        """
        ensure_table(self.spark, self.table, self.schema(rows), partition_by=(BATCH,))
        ledger = self.spark.table(self.table)
        now = self._counted(rows).withColumnRenamed("copies", "now")
        old = ledger.filter(F.col(BATCH) == batch).select(*self.keys, F.col("copies").alias("old"))
        both = now.join(old, list(self.keys), "full")
        touched = materialize(both.na.fill(0, ["now", "old"]), "touched-keys")
        elsewhere = within_key_range(ledger.filter(F.col(BATCH) != batch), self.keys[0], touched, self.keys[0])
        found = materialize(elsewhere.join(touched, list(self.keys)), "earlier-copies")
        others = found.groupBy(*self.keys).agg(F.sum("copies").alias("others"))
        totals = touched.join(others, list(self.keys), "left").na.fill(0, ["others"])
        repeated = totals.filter((F.col("now") > 0) & (F.col("others") + F.col("now") > 1)).select(*self.keys)
        # one copy elsewhere: its uniqueness hangs on this batch; of several each is repeated anyway
        alone = found.join(others.filter("others = 1").select(*self.keys), list(self.keys), "left_semi")
        turned = alone.filter((F.col("old") > 0) != (F.col("now") > 0))
        turned = turned.select(*self.keys, BATCH, (F.col("now") > 0).alias("repeated"))
        return Verdict(materialize(repeated, "repeated-keys"), materialize(turned, "turned-keys"))

    def record(self, rows: DataFrame, batch: str) -> None:
        """Put the counts of the batch into the ledger, in place of what it holds of the batch."""
        counts = self._counted(rows).withColumn(BATCH, F.lit(batch))
        replace_partitions(counts, self.table, self.schema(rows), [Row(**{BATCH: batch})], cluster_by=self.keys)


    def record_all(self, rows: DataFrame) -> None:
        """Begin the ledger anew from ``rows`` of many batches, told by their column ``batch``."""
        counts = rows.select(*self.keys, BATCH).na.drop("any").groupBy(*self.keys, BATCH)
        counts = counts.agg(F.count(F.lit(1)).alias("copies"))
        overwrite_table(counts, self.table, self.schema(rows), partition_by=(BATCH,), cluster_by=self.keys)


def flagged(rows: DataFrame, repeated: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """``rows`` plus ``flag``: the key is in ``repeated``, a written table with distinct keys.

    Rows with a NULL key match nothing. They go round the join, so that they never meet in one task.
    """
    named = F.lit(True)
    for key in keys:
        named &= F.col(key).isNotNull()
    marked = repeated.select(*keys, F.lit(True).alias(flag))
    joined = rows.filter(named).join(marked, list(keys), "left").select(*rows.columns, F.coalesce(flag, F.lit(False)).alias(flag))
    return joined.unionByName(rows.filter(~named).withColumn(flag, F.lit(False)))


def check_batch(rows: DataFrame, shape: T.StructType, what: str) -> DataFrame:
    """``rows`` in declared shape, written once: a batch is read for its counts and again for its rows."""
    return materialize(check_schema(rows, shape, what), "batch")
