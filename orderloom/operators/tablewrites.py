"""Table writes with drift guard: overwrite, append, merge and slice replacement on Parquet tables.

Plain Parquet tables have no MERGE and no transaction log. Full rewrites go to a standby table and
take the target's place by rename, so a failing job leaves the old table whole; slices are replaced
by partition. Between drop and rename the target is absent for a moment; ``recover`` finishes a swap
that was cut off there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.keys import unmatched
from orderloom.schemas import check_schema
from orderloom.session import staged

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _standby(table: str) -> str:
    database, _, name = table.replace("`", "").rpartition(".")
    return f"`{database}`.`{name}__standby`" if database else f"`{name}__standby`"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table.replace("`", ""))


def recover(spark: SparkSession, table: str) -> None:
    """Finish a swap that stopped after dropping the target, or discard a half-written standby table."""
    standby = _standby(table)
    if not table_exists(spark, standby):
        return
    if table_exists(spark, table):
        spark.sql(f"DROP TABLE {standby}")
    else:
        _take_place(spark, standby, table)


def _take_place(spark: SparkSession, standby: str, table: str) -> None:
    """Rename the standby table; a partitioned one then registers its partitions at the new place."""
    spark.sql(f"ALTER TABLE {standby} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    if partition_columns(spark, table):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def ensure_table(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """Create ``table`` empty unless it exists."""
    recover(spark, table)
    if not table_exists(spark, table):
        writer = spark.createDataFrame([], schema).write
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def needs_backfill(spark: SparkSession, table: str) -> bool:
    """True when the table is missing or holds no row."""
    recover(spark, table)
    return not table_exists(spark, table) or spark.table(table).isEmpty()


def _hashable(df: DataFrame, besides: Sequence[str]) -> list[Column]:
    """The other columns, but for those with maps, which have no hash."""
    return [F.col(f.name) for f in df.schema if f.name not in besides and "map<" not in f.dataType.simpleString()]


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ranges of ``keys``, sorted, so that each file covers a narrow range and Parquet statistics prune on it.

    The remaining columns and the input partition break ties: a heavy key, even one of identical rows,
    spreads over several files. There are as many ranges as shuffle partitions, which are set by data size.
    """
    rest = _hashable(df, keys)
    return _ranged(df, keys, F.xxhash64(*rest) if rest else F.lit(0))


def _ranged(df: DataFrame, keys: Sequence[str], spread: Column) -> DataFrame:
    """``spread`` is computed where rows are dealt out, so that it is not shuffled with them."""
    placed = df.withColumn("_origin", F.spark_partition_id())
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = placed.repartitionByRange(tasks, *[F.col(k) for k in keys], spread, F.col("_origin"))
    return ranged.sortWithinPartitions(*keys).drop("_origin")


def by_partition(df: DataFrame, partition_by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows in order of the table's partitions, a few partitions per task.

    A partitioned table has at least one file per partition to write, however few the rows, so the
    number of tasks is fixed instead of following the data size. The remaining columns and the input
    partition break ties: a heavy partition, even one of identical rows, spreads over several tasks.
    """
    leading = [*partition_by, *[k for k in keys if k not in partition_by]]
    rest = _hashable(df, leading)
    return _ranged(df, leading, F.xxhash64(*rest) if rest else F.lit(0))


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table.replace("`", "")) if c.isPartition]


class PartitioningChanged(ValueError):
    """An overwrite with other partition columns than the table has."""


def overwrite_table(
    df: DataFrame,
    table: str,
    schema: T.StructType,
    partition_by: Sequence[str] | None = None,
    cluster_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> None:
    """Replace the whole table. ``df`` may read the table it replaces.

    An existing table keeps its partitioning; naming another one raises before anything is written.
    ``cluster_by`` lays the table out across files, at the price of a shuffle; ``sort_by`` only
    orders the rows within each file. With ``sort_by`` a partitioned table takes ``df`` as it is dealt to tasks, which
    should then hold a few partitions each.
    """
    spark = df.sparkSession
    guarded = check_schema(df, schema, table)
    recover(spark, table)
    exists = table_exists(spark, table)
    now = partition_columns(spark, table) if exists else list(partition_by or ())
    if partition_by is not None and list(partition_by) != now:
        raise PartitioningChanged(f"{table}: partitioned by {now}, not by {list(partition_by)}")
    partition_by = now
    if sort_by:
        guarded = guarded.sortWithinPartitions(*sort_by)
    elif partition_by:
        guarded = by_partition(guarded, partition_by, cluster_by)
    elif cluster_by:
        guarded = clustered(guarded, cluster_by)
    destination = _standby(table) if exists else table
    writer = guarded.write
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(destination)
    if exists:
        spark.sql(f"DROP TABLE {table}")
        _take_place(spark, destination, table)


def _append(df: DataFrame, table: str, cluster_by: Sequence[str] = ()) -> None:
    ordered = df.select(*df.sparkSession.table(table).columns)
    (clustered(ordered, cluster_by) if cluster_by else ordered).write.mode("append").insertInto(table)


def append_new(
    df: DataFrame, table: str, schema: T.StructType, keys: Sequence[str], cluster_by: Sequence[str] = ()
) -> None:
    """Append the rows whose key the table does not hold, so that a rerun adds nothing."""
    merge_insert_only(df, table, schema, keys, cluster_by)


def merge_insert_only(
    df: DataFrame, table: str, schema: T.StructType, keys: Sequence[str], cluster_by: Sequence[str] = ()
) -> None:
    """Insert rows with an unknown key and never touch existing ones (the freeze).

    Keys are compared with the table as it was before the merge: repeated new keys and NULL keys
    all insert.
    """
    spark = df.sparkSession
    recover(spark, table)
    with staged(check_schema(df, schema, table), "merge") as new:
        _append(unmatched(new, spark.table(table), keys), table, cluster_by)


def in_partitions(by: Sequence[str], values: Sequence[Row]) -> Column:
    """Condition on partition columns that holds in the partitions ``values``; the scan prunes on it."""
    if len(by) == 1:
        known = [v[0] for v in values if v[0] is not None]
        found = F.col(by[0]).isin(known) if known else F.lit(False)
        return found | F.col(by[0]).isNull() if len(known) < len(values) else found
    found = F.lit(False)
    for value in values:
        here = F.lit(True)
        for column, part in zip(by, value, strict=True):
            here &= F.col(column).eqNullSafe(F.lit(part))
        found |= here
    return found


def hit_partitions(target: DataFrame, by: Sequence[str], matches: DataFrame, keys: Sequence[str]) -> list[Row]:
    """The partitions of ``target`` that hold a key of ``matches``; reads partition and key columns only.

    At most one row for each partition of the table, a number that the table's layout bounds.
    """
    wanted = matches.select(*keys).distinct()
    return target.select(*{*by, *keys}).join(wanted, list(keys), "left_semi").select(*by).distinct().collect()


def replace_partitions(
    df: DataFrame, table: str, schema: T.StructType, touched: Sequence[Row], cluster_by: Sequence[str] = ()
) -> None:
    """Replace the partitions ``touched`` by the rows of ``df``, which may read them; all others keep their files.

    The new rows are written to scratch first. A touched partition without a row is dropped. Partitions take their
    place one by one: a run that is cut off there is to be repeated, which gives the same result.
    """
    spark = df.sparkSession
    by = partition_columns(spark, table)
    if not by:
        raise NotASlice(f"{table}: not partitioned")
    if not touched:
        return
    with staged(check_schema(df, schema, table), "partitions") as fresh:
        if not fresh.filter(~F.coalesce(in_partitions(by, touched), F.lit(False))).isEmpty():
            raise RowsOutsideSlice(f"{table}: rows outside the replaced partitions")
        filled = {tuple(r) for r in fresh.select(*by).distinct().collect()}
        for value in touched:
            if tuple(value) not in filled:
                _drop_partition(spark, table, by, value)
        if filled:
            _overwrite_dynamically(by_partition(fresh, by, cluster_by), table)
    spark.catalog.refreshTable(table)


def replace_partition(df: DataFrame, table: str, schema: T.StructType, value: Row) -> None:
    """Replace the one partition ``value`` by the rows of ``df``, which must not read the table.

    ``df`` comes without the partition columns, so it has no row outside, and is written as it is computed: neither
    staged nor laid out. The partition is dropped first: a run that is cut off is to be repeated.
    """
    spark = df.sparkSession
    by = partition_columns(spark, table)
    if sorted(by) != sorted(value.asDict()):
        raise NotASlice(f"{table}: partitioned by {by}, not by {sorted(value.asDict())}")
    placed = df.withColumns({c: F.lit(value[c]).cast(schema[c].dataType) for c in by})
    guarded = check_schema(placed, schema, table)
    _drop_partition(spark, table, by, [value[c] for c in by])
    _overwrite_dynamically(guarded, table)
    spark.catalog.refreshTable(table)


def _drop_partition(spark: SparkSession, table: str, by: Sequence[str], value: Sequence) -> None:
    spec = ", ".join(
        f"`{c}` = NULL" if v is None else f"`{c}` = '{str(v).replace(chr(39), chr(92) + chr(39))}'"
        for c, v in zip(by, value, strict=True)
    )
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _overwrite_dynamically(df: DataFrame, table: str) -> None:
    spark = df.sparkSession
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


class AmbiguousUpdate(ValueError):
    """More than one update row for a key."""


def updated(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``target`` with ``columns`` taken from the matching update row; an update to NULL wins."""
    renamed = [F.col(c).alias(f"_new_{c}") for c in columns]
    changes = updates.select(*keys, *renamed, F.lit(True).alias("_hit"))
    joined = target.join(changes, list(keys), "left")
    kept = [
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns
    ]
    return joined.select(*kept)


def merge_update(
    updates: DataFrame, table: str, keys: Sequence[str], columns: Sequence[str], cluster_by: Sequence[str] = ()
) -> None:
    """Update ``columns`` of the rows with a matching key; unmatched updates are ignored.

    Of a partitioned table only the partitions that hold a matched key are rewritten, with the layout
    ``cluster_by``; all others keep their files. A table without partitions, or one whose partition columns are
    updated, so that rows move, is rewritten whole and keeps its partitioning.
    """
    spark = updates.sparkSession
    recover(spark, table)
    named = [F.col(k).isNotNull() for k in keys]
    known = updates
    for present in named:
        known = known.filter(present)
    if not known.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise AmbiguousUpdate(f"{table}: several updates for one {tuple(keys)}")
    target = spark.table(table)
    by = partition_columns(spark, table)
    if not by or set(by) & set(columns):
        overwrite_table(updated(target, known, keys, columns), table, target.schema, cluster_by=cluster_by)
        return
    hit = hit_partitions(target, by, known, keys)
    held = target.filter(in_partitions(by, hit))
    replace_partitions(updated(held, known, keys, columns), table, target.schema, hit, cluster_by)


class RowsOutsideSlice(ValueError):
    """Replacement rows that belong to another slice."""


class NotASlice(ValueError):
    """A slice named by a column the table is not partitioned by."""


def replace_slice(df: DataFrame, table: str, schema: T.StructType, column: str, value) -> None:
    """Replace the rows with ``column = value``; an empty ``df`` clears the slice.

    ``column`` must be the table's only partition column: anything else raises before a row is written,
    since a dynamic overwrite would replace rows outside the slice. The new slice is written to scratch first, so
    the check and the insert see the same rows and the table stays unchanged when the check fails.
    """
    spark = df.sparkSession
    if partition_columns(spark, table) != [column]:
        raise NotASlice(f"{table}: not partitioned by {column}")
    here = F.col(column).eqNullSafe(F.lit(value))
    with staged(check_schema(df, schema, table), "slice") as fresh:
        strays, size = fresh.agg(F.count_if(~here), F.count(F.lit(1))).first()
        if strays:
            raise RowsOutsideSlice(f"{table}: {strays} rows outside {column} = {value}")
        if size == 0:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{value}')")
            spark.catalog.refreshTable(table)
            return
        _overwrite_dynamically(fresh, table)
