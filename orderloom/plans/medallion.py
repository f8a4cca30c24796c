"""The batch day run: sources, bronze, silver, gold.

Every step takes the seed date explicitly, so that a run across midnight stays on one day.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.functions.columns import EPOCH_DAY, as_day
from orderloom.operators import quality
from orderloom.operators.keys import with_keys_of
from orderloom.operators.orders import aggregate_orders, enrich_order, gold_in_ranges
from orderloom.operators.tablewrites import (
    append_new,
    ensure_table,
    merge_insert_only,
    merge_update,
    needs_backfill,
    overwrite_table,
    replace_slice,
)
from orderloom.sources import generate
from orderloom.sources.tables import Lake
from orderloom.streaming.append import filled_by_stream, stream_append

SOURCE = "external_source"
SILVER_KEYS = ("order_id", "item_seq")

# Layout of the tables that grow: what their readers filter on, then what they join on.
ORDER_LAYOUT = ("date", "id")
ITEM_LAYOUT = ("id_order",)
PRODUCT_LAYOUT = ("product_id",)
SILVER_LAYOUT = ("order_date", "order_id")
GOLD_LAYOUT = ("order_date", "product_id")


@dataclass(frozen=True)
class SeedSizes:
    customers: int = generate.INITIAL_CUSTOMERS
    products: int = generate.INITIAL_PRODUCTS
    orders: int = generate.INITIAL_ORDERS
    per_day: int = generate.ORDERS_PER_DAY


def ensure_sources(lake: Lake) -> None:
    for table, shape in (
        ("customer", schemas.customer_schema),
        ("product", schemas.product_schema),
        ("order", schemas.order_schema),
        ("order_item", schemas.order_item_schema),
    ):
        ensure_table(lake.spark, lake.name(SOURCE, table), shape(lake.ids))


def seed_initial(lake: Lake, seed_date: str | date, sizes: SeedSizes = SeedSizes()) -> None:
    """Fill the source tables: customers, products, a year of orders and their lines."""
    spark, kind = lake.spark, lake.ids
    numbers = generate.ids(spark, sizes.orders)
    orders = generate.gen_orders(numbers, seed_date, kind, sizes.customers, sizes.products)
    items = generate.gen_order_items(numbers, kind)
    products = generate.gen_products(generate.ids(spark, sizes.products), kind)
    overwrite_table(orders, lake.name(SOURCE, "order"), schemas.order_schema(kind), cluster_by=ORDER_LAYOUT)
    overwrite_table(items, lake.name(SOURCE, "order_item"), schemas.order_item_schema(kind), cluster_by=ITEM_LAYOUT)
    overwrite_table(products, lake.name(SOURCE, "product"), schemas.product_schema(kind), cluster_by=PRODUCT_LAYOUT)
    # Customers last: their number tells a complete seed from an interrupted one.
    customers = generate.gen_customers(generate.ids(spark, sizes.customers), kind)
    overwrite_table(customers, lake.name(SOURCE, "customer"), schemas.customer_schema(kind))


class ForeignIds(ValueError):
    """Orders of another day within a day's range of ids."""


def refuse_foreign_ids(lake: Lake, day: date, sizes: SeedSizes) -> None:
    """Raise if the day's ids are taken by other orders, which would pass for known ones and be left out."""
    first, last = generate.day_range(day, sizes.per_day, sizes.orders)
    orders = lake.read(SOURCE, "order").filter(F.col("id").between(first, last))
    if not orders.filter(~F.col("date").eqNullSafe(F.lit(day.isoformat()))).isEmpty():
        raise ForeignIds(f"ids {first} to {last} of {day} are taken; was the lake seeded with other sizes?")


def seed_day(lake: Lake, seed_date: str | date, sizes: SeedSizes = SeedSizes()) -> None:
    """Add one day: new orders and lines, moved customers, renamed products. A rerun changes nothing."""
    day = as_day(seed_date)
    if day < EPOCH_DAY:
        raise ValueError(f"seed dates start at {EPOCH_DAY}")
    spark, kind = lake.spark, lake.ids
    slots, today = generate.day_slots(spark, day, sizes.per_day), generate.single_day(spark, day)
    refuse_foreign_ids(lake, day, sizes)
    orders = generate.gen_day_orders(slots, kind, sizes.per_day, sizes.orders, sizes.customers, sizes.products)
    items = generate.gen_day_items(slots, kind, sizes.per_day, sizes.orders)
    append_new(orders, lake.name(SOURCE, "order"), schemas.order_schema(kind), ["id"])
    append_new(items, lake.name(SOURCE, "order_item"), schemas.order_item_schema(kind), ["id_order", "seq"])
    moves = generate.gen_country_updates(today, kind, sizes.customers)
    renames = generate.gen_rename_updates(today, kind)
    merge_update(moves, lake.name(SOURCE, "customer"), ["id"], ["country"])
    merge_update(renames, lake.name(SOURCE, "product"), ["product_id"], ["name"], cluster_by=PRODUCT_LAYOUT)


def seed_sources(lake: Lake, seed_date: str | date, sizes: SeedSizes = SeedSizes()) -> DataFrame:
    """Initial load on a fresh lake, otherwise the day's changes. Returns the source row counts."""
    ensure_sources(lake)
    if lake.read(SOURCE, "customer").count() < sizes.customers:
        seed_initial(lake, seed_date, sizes)
    else:
        seed_day(lake, seed_date, sizes)
    return source_totals(lake)


def source_totals(lake: Lake) -> DataFrame:
    """(table, rows) of the three source tables."""
    counts = [
        lake.read(SOURCE, table).agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("rows"))
        for table in ("customer", "order", "order_item")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def seed_load_test(lake: Lake, sizes: SeedSizes = SeedSizes()) -> None:
    """Constant-valued source tables whose gold result is known in advance."""
    spark, kind = lake.spark, lake.ids
    numbers = generate.ids(spark, sizes.orders)
    customers = generate.gen_customers(generate.ids(spark, sizes.customers), kind, country="USA")
    products = generate.gen_products(generate.ids(spark, sizes.products), kind, unit_price=25.0)
    for table, rows, shape, layout in (
        ("customer", customers, schemas.customer_schema, ()),
        ("product", products, schemas.product_schema, PRODUCT_LAYOUT),
        ("order", generate.gen_load_orders(numbers, kind, sizes.customers, sizes.products), schemas.order_schema, ORDER_LAYOUT),
        ("order_item", generate.gen_load_items(numbers, kind), schemas.order_item_schema, ITEM_LAYOUT),
    ):
        overwrite_table(rows, lake.name(SOURCE, table), shape(kind), cluster_by=layout)


def load_bronze_dimensions(lake: Lake) -> None:
    for table, shape in (("customer", schemas.customer_schema), ("product", schemas.product_schema)):
        overwrite_table(lake.read(SOURCE, table), lake.name("raw", table), shape(lake.ids))


def load_bronze_items(lake: Lake, checkpoints: str | None = None) -> None:
    """Bring the lines to bronze: a full copy, or with ``checkpoints`` only those that are new.

    Lines are only ever appended at the source, so consuming each once gives the same table. A table
    that was last written as a full copy is rebuilt by the first incremental load.
    """
    shape = schemas.order_item_schema(lake.ids)
    source, target = (SOURCE, "order_item"), ("raw", "order_item")
    if checkpoints is None:
        overwrite_table(lake.read(*source), lake.name(*target), shape)
        return
    rebuild = not filled_by_stream(lake, lake.name(*target))
    stream_append(lake, source, target, shape, f"{checkpoints}/bronze_items", full_refresh=rebuild)


def load_bronze_orders(
    lake: Lake, fail_ratio: float = 1.0, checkpoints: str | None = None
) -> tuple[int, int, float]:
    """Check the orders, quarantine the bad ones, then bring orders and lines to bronze.

    Only the repeated ids are written to scratch; beyond that the annotation is a scan with a
    broadcast, cheaper to repeat for an output than to store. The quarantine is written before the gate, so it
    is there to inspect when the gate stops the run; the pass that writes it also counts for the gate.
    """
    kind = lake.ids
    annotated = quality.annotate(lake.read(SOURCE, "order"), quality.order_rules())
    counting, seen = quality.observed(annotated)
    overwrite_table(
        quality.invalid_rows(counting), lake.name("raw", "order_quarantine"), schemas.quarantine_schema(kind)
    )
    good, bad, ratio = quality.observed_ratio(seen)
    quality.gate(good, bad, ratio, fail_ratio)
    overwrite_table(quality.valid_rows(annotated), lake.name("raw", "order"), schemas.order_schema(kind))
    load_bronze_items(lake, checkpoints)
    return good, bad, ratio


def load_silver(lake: Lake, seed_date: str | date) -> None:
    """Enrich everything on the first run, afterwards only the orders of ``seed_date``.

    The daily run inserts unknown lines and leaves the others alone, which freezes the names they
    were booked under. Its line scan is cut to the id range of the day's orders, and to their ids before any shuffle.
    """
    target, shape = lake.name("curated", "order_enriched"), schemas.silver_schema(lake.ids)
    customer, product = lake.read("raw", "customer"), lake.read("raw", "product")
    orders, lines = lake.read("raw", "order"), lake.read("raw", "order_item")
    if needs_backfill(lake.spark, target):
        overwrite_table(enrich_order(customer, orders, lines, product), target, shape, cluster_by=SILVER_LAYOUT)
        return
    today = orders.filter(F.col("date") == as_day(seed_date).isoformat())
    new_lines = with_keys_of(lines, "id_order", today, "id")
    fresh = enrich_order(customer, today, new_lines, product)
    # Files of one date need no further layout.
    merge_insert_only(fresh, target, shape, SILVER_KEYS)


def load_gold(lake: Lake, seed_date: str | date) -> None:
    """Aggregate everything on the first run, afterwards replace the slice of ``seed_date``."""
    target, shape = lake.name("report", "order_agg"), schemas.gold_schema(lake.ids)
    silver = lake.read("curated", "order_enriched")
    if needs_backfill(lake.spark, target):
        backfill_gold(lake, silver, "order_agg")
        return
    day = as_day(seed_date)
    replace_slice(aggregate_orders(silver.filter(F.col("order_date") == day)), target, shape, "order_date", day)


def backfill_gold(lake: Lake, silver: DataFrame, table: str) -> None:
    """Sum all of ``silver`` in the table's layout: gold is not shuffled again to be written."""
    gold, shape = gold_in_ranges(silver, GOLD_LAYOUT), schemas.gold_schema(lake.ids)
    overwrite_table(gold, lake.name("report", table), shape, partition_by=("order_date",), sort_by=GOLD_LAYOUT)


def run_day(
    lake: Lake, seed_date: str | date, fail_ratio: float = 1.0, checkpoints: str | None = None
) -> None:
    """Bronze, silver and gold for one day, from whatever the source layer holds.

    With ``checkpoints``, a folder on shared storage, the lines reach bronze incrementally.
    """
    load_bronze_dimensions(lake)
    load_bronze_orders(lake, fail_ratio, checkpoints)
    load_silver(lake, seed_date)
    load_gold(lake, seed_date)
