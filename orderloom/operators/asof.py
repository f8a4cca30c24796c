"""As-of pricing by a sweep over time: every usage row meets one price version, however many its SKU has.

Usage and versions are laid end to end, dealt out by SKU and stretch of time, and sorted by time: the version in
force is the last one before a usage row. A stretch begins with the version carried in from the stretches before it,
which is found among the last versions of the stretches, not among the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.columns import epoch_second
from orderloom.session import materialize

STRETCH_SECONDS = 86_400
#: Usage rows of a stretch that one task sweeps; those of a busier one are dealt to several, each with its versions.
STRETCH_ROWS = 1_000_000

_VERSION = ("_from", "_until", "_price")


def _stretch(moment: Column, kind: T.DataType, seconds: int) -> Column:
    return F.floor(epoch_second(moment, kind) / seconds).cast("long")


def price_versions(list_prices: DataFrame) -> DataFrame:
    """(sku_name, _from, _until, _price) of the versions that are in force at some time."""
    made = list_prices.select(
        "sku_name",
        F.col("price_start_time").alias("_from"),
        F.col("price_end_time").alias("_until"),
        F.col("pricing.effective_list.default").alias("_price"),
    )
    ever = F.col("_until").isNull() | (F.col("_until") > F.col("_from"))
    return made.filter(F.col("sku_name").isNotNull() & F.col("_from").isNotNull() & ever)


def overlapping_versions(list_prices: DataFrame) -> DataFrame:
    """(sku_name, price_start_time, price_end_time, next_start) of versions still in force when the next one begins.

    The sweep takes the newest version, so it equals the interval join only where there is no such row.
    """
    order = Window.partitionBy("sku_name").orderBy("_from", F.col("_until").asc_nulls_last())
    following = F.lead("_from").over(order)
    found = price_versions(list_prices).withColumn("next_start", following)
    late = F.col("next_start").isNotNull() & (F.col("_until").isNull() | (F.col("next_start") < F.col("_until")))
    return found.filter(late).select(
        "sku_name", F.col("_from").alias("price_start_time"), F.col("_until").alias("price_end_time"), "next_start"
    )


def _carried(cells: DataFrame, versions: DataFrame) -> DataFrame:
    """``cells`` (sku_name, _cell) with ``_carried``, the last version that begins before the cell, and ``_tasks``.

    Both sides have a row for each SKU and stretch at most.
    """
    newest = versions.groupBy("sku_name", "_cell").agg(F.max(F.struct(*_VERSION)).alias("_last"))
    both = cells.join(newest, ["sku_name", "_cell"], "full")
    before = Window.partitionBy("sku_name").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
    return carried.filter(F.col("_tasks").isNotNull()).select("sku_name", "_cell", "_tasks", "_carried")


def price_usage_by_sweep(
    usage: DataFrame,
    list_prices: DataFrame,
    stretch_seconds: int = STRETCH_SECONDS,
    stretch_rows: int = STRETCH_ROWS,
) -> DataFrame:
    """``usage`` with ``effective_price`` and ``priced``, as ``price_usage``, for versions that do not overlap.

    Usage is read once for the number of rows of each SKU and stretch, and once for the sweep. Its work grows with
    usage and versions, not with their product. Usage without SKU or time, or that no version covers, stays unpriced.
    """
    kind = usage.schema["usage_end_time"].dataType
    versions = price_versions(list_prices).withColumn("_cell", _stretch(F.col("_from"), kind, stretch_seconds))
    placed = usage.withColumn("_cell", _stretch(F.col("usage_end_time"), kind, stretch_seconds))
    known = F.col("sku_name").isNotNull() & F.col("_cell").isNotNull()
    counts = placed.filter(known).groupBy("sku_name", "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    cells = counts.select("sku_name", "_cell", F.ceil(F.col("_rows") / stretch_rows).cast("int").alias("_tasks"))
    cells = materialize(_carried(cells, versions), "price-cells")
    busy = cells.filter("_tasks > 1").select("sku_name", "_cell", "_tasks")

    # every task of a cell gets the version carried in and those that begin in the cell
    inside = versions.join(cells.select("sku_name", "_cell", "_tasks"), ["sku_name", "_cell"])
    inside = inside.select("sku_name", "_cell", "_tasks", F.struct(*_VERSION).alias("_version"))
    carried = cells.filter("_carried IS NOT NULL").select("sku_name", "_cell", "_tasks", F.col("_carried").alias("_version"))
    offered = inside.unionByName(carried).withColumn("_task", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1)))

    row = F.struct(*[F.col(c) for c in usage.columns]).alias("_row")
    named = placed.filter(known).join(busy, ["sku_name", "_cell"], "left")
    spread = F.pmod(F.xxhash64(*_hashable(usage), F.spark_partition_id()), F.coalesce("_tasks", F.lit(1))).cast("int")
    events = named.select(
        "sku_name", "_cell", spread.alias("_task"), F.col("usage_end_time").alias("_at"), F.lit(1).alias("_kind"), row
    ).unionByName(
        # a version in force from a moment applies at it, so it stands before the usage of that moment
        offered.select(
            "sku_name", "_cell", "_task", F.col("_version._from").alias("_at"), F.lit(0).alias("_kind"), "_version"
        ),
        allowMissingColumns=True,
    )
    sweep = Window.partitionBy("sku_name", "_cell", "_task").orderBy("_at", "_kind")
    swept = events.withColumn("_v", F.last("_version", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0)))
    in_force = F.col("_v").isNotNull() & (F.col("_v._until").isNull() | (F.col("_at") < F.col("_v._until")))
    priced = swept.filter("_kind = 1").select(
        *[F.col(f"_row.`{c}`") for c in usage.columns],
        F.when(in_force, F.col("_v._price")).alias("effective_price"),
        in_force.alias("priced"),
    )
    price = priced.schema["effective_price"].dataType
    unknown = usage.filter(F.col("sku_name").isNull() | F.col("usage_end_time").isNull())
    return priced.unionByName(unknown.withColumns({"effective_price": F.lit(None).cast(price), "priced": F.lit(False)}))


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()]
