"""Insert-only merges through an exact bitmap index of the ids that a table holds.

The table is partitioned into spans of ids, and so is its index: a bitmap for every ``BITS`` ids. Whether an id is
known is one bit, found by a join on the bitmap's number, however the new ids are spread. Only rows whose id is
known are compared with the table, and only its partitions that hold such ids are read. A bitmap takes 4 KB
however few ids it has, before Parquet compresses it: ids should not be many thousands apart on average.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.keys import BITS, SHIFT, has_bit, without_keys
from orderloom.operators.tablewrites import (
    by_partition,
    ensure_table,
    in_partitions,
    overwrite_table,
    recover,
    replace_partitions,
)
from orderloom.schemas import check_schema
from orderloom.session import staged

SPAN = "id_span"
#: Partitions of a table at most: spans further on are dealt to the same ones again.
SPANS = 256


def _number(key: str) -> Column:
    return F.shiftright(F.col(key).cast("long"), SHIFT)  # rounds down, also for negative ids


@dataclass(frozen=True)
class IndexedTable:
    """``table`` keyed by ``keys``, the first of which, an integer, is indexed in ``<table>__ids``.

    ``2 ** span_shift`` bitmaps make a span, every ``SPANS``-th of which shares a partition, so that the number of
    partitions does not grow with the range of ids. Rows whose id is NULL are never found; they are in the partition
    of the NULL span.
    """

    spark: SparkSession
    table: str
    schema: T.StructType
    keys: tuple[str, ...]
    span_shift: int = 10

    @property
    def index(self) -> str:
        database, _, name = self.table.replace("`", "").rpartition(".")
        return f"`{database}`.`{name}__ids`" if database else f"`{name}__ids`"

    def _span(self) -> Column:
        return self._span_of(_number(self.keys[0]))

    def _span_of(self, bitmap: Column) -> Column:
        return F.pmod(F.shiftright(bitmap, self.span_shift), F.lit(SPANS).cast("long"))

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(SPAN, T.LongType())])

    def _index_schema(self) -> T.StructType:
        return T.StructType.fromDDL(f"bitmap long, ids binary, {SPAN} long")

    def ensure(self) -> None:
        ensure_table(self.spark, self.table, self._stored(), partition_by=(SPAN,))
        ensure_table(self.spark, self.index, self._index_schema(), partition_by=(SPAN,))

    def read(self) -> DataFrame:
        return self.spark.table(self.table).select(*self.schema.fieldNames())

    def bitmaps(self, rows: DataFrame) -> DataFrame:
        """The ids of ``rows`` as (bitmap, ids, id_span). Bits combine map-side, so a hot id is one bit."""
        key = F.col(self.keys[0])
        place = F.pmod(key.cast("long"), F.lit(BITS))
        return (
            rows.filter(key.isNotNull())
            .groupBy(_number(self.keys[0]).alias("bitmap"))
            .agg(F.bitmap_construct_agg(place).alias("ids"))
            .withColumn(SPAN, self._span_of(F.col("bitmap")))
        )

    def known(self, rows: DataFrame, flag: str) -> DataFrame:
        """``rows``, a written frame, plus ``flag``: the index has their id. Rows without an id go round the join.

        Of the index only the spans and bitmaps that the rows ask for are read and joined.
        """
        key = F.col(self.keys[0])
        placed = rows.filter(key.isNotNull()).withColumns(
            {"_of": _number(self.keys[0]), "_place": F.pmod(key.cast("long"), F.lit(BITS)).cast("int")}
        )
        spans = self._spans_of(rows)
        asked = placed.select(F.col("_of").alias("bitmap")).distinct()
        ids = self.spark.table(self.index).filter(in_partitions((SPAN,), spans)).join(asked, "bitmap", "left_semi")
        joined = placed.join(ids.select(F.col("bitmap").alias("_of"), F.col("ids").alias("_ids")), "_of", "left")
        has = F.coalesce(has_bit(F.col("_ids"), F.col("_place")), F.lit(False))
        found = joined.select(*rows.columns, has.alias(flag))
        return found.unionByName(rows.filter(key.isNull()).withColumn(flag, F.lit(False)))

    def _spans_of(self, rows: DataFrame) -> list[Row]:
        """The spans of the ids of ``rows``: at most as many as the table has, or will have, partitions."""
        return rows.select(self._span().alias(SPAN)).filter(F.col(SPAN).isNotNull()).distinct().collect()

    def held(self, suspects: DataFrame) -> DataFrame:
        """Distinct keys of ``suspects`` that the table holds; reads the key columns of their spans only."""
        rows = self.spark.table(self.table).filter(in_partitions((SPAN,), self._spans_of(suspects)))
        return rows.select(*self.keys).join(suspects.select(*self.keys).distinct(), list(self.keys), "left_semi").distinct()

    def merge_insert_only(self, new: DataFrame) -> None:
        """Insert the rows with an unknown key; repeated new keys and NULL keys all insert, as in the plain merge.

        Keys alone are looked up and staged; whole rows are written once, then filtered and laid out.
        """
        self.ensure()
        recover(self.spark, self.table)
        with (
            staged(check_schema(new, self.schema, self.table), "merge") as rows,
            staged(self.known(rows.select(*self.keys), "_known"), "known") as marked,
            staged(self.held(marked.filter("_known").na.drop("any")), "held") as held,
        ):
            # first: an id in the index but not in the table is merely looked for in vain
            self._add_ids(marked.filter("NOT _known"))
            self._append(without_keys(rows, held, self.keys).withColumn(SPAN, self._span()))

    def _append(self, placed: DataFrame) -> None:
        columns = self.spark.table(self.table).columns
        laid = by_partition(placed, (SPAN,), self.keys)
        laid.select(*columns).write.mode("append").insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def _add_ids(self, placed: DataFrame) -> None:
        spans = self._spans_of(placed)
        before = self.spark.table(self.index).filter(in_partitions((SPAN,), spans))
        both = before.unionByName(self.bitmaps(placed)).groupBy("bitmap", SPAN).agg(F.bitmap_or_agg("ids").alias("ids"))
        replace_partitions(both, self.index, self._index_schema(), spans, cluster_by=("bitmap",))

    def replace(self, rows: DataFrame) -> None:
        """Put ``rows`` in place of the whole table, and index them. Cut off in between, ``rebuild`` finishes it."""
        placed = check_schema(rows, self.schema, self.table).withColumn(SPAN, self._span())
        overwrite_table(placed, self.table, self._stored(), partition_by=(SPAN,), cluster_by=self.keys)
        self.rebuild()

    def rebuild(self) -> None:
        """Index the table as it is, after it was written by other means."""
        ids = self.bitmaps(self.spark.table(self.table))
        ids.select("bitmap", "ids", SPAN).write.mode("overwrite").partitionBy(SPAN).saveAsTable(self.index)
