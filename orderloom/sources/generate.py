"""Deterministic row generators for the source layer.

Every generator maps a relation of identifiers to rows, so the same code fills a seed table from
``spark.range`` and scales with whatever relation supplies the identifiers. "Noise" is arithmetic
of the identifier, so results do not depend on the number of partitions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.columns import EPOCH_DAY, as_day, day_offset
from orderloom.schemas import IDS_NARROW

# Sizes of the seed, country rotation and the country bands of the first 500 customers.
INITIAL_CUSTOMERS = 500
INITIAL_PRODUCTS = 100
INITIAL_ORDERS = 2_000_000
ITEMS_PER_ORDER = 3
ORDERS_PER_DAY = 5_000
COUNTRY_UPDATES_PER_DAY = 50
RENAMES_PER_DAY = 2
BACKFILL_DAYS = 363
CATEGORIES = 10
COUNTRY_ROTATION = ("US", "UK", "CA", "DE", "FR", "BR", "AU", "JP", "MX", "IN")
COUNTRY_BANDS = (
    (200, "US"),
    (300, "UK"),
    (350, "DE"),
    (400, "FR"),
    (430, "BR"),
    (455, "CA"),
    (475, "AU"),
    (490, "JP"),
    (497, "MX"),
    (500, "IN"),
)


def ids(spark: SparkSession, count: int, start: int = 1) -> DataFrame:
    return spark.range(start, start + count)


def _one_based(number: Column, size: int) -> Column:
    """1..size, cycling with ``number`` starting at 1."""
    return F.pmod(number - 1, F.lit(size)) + 1


def _country_of(customer: Column) -> Column:
    place = _one_based(customer, INITIAL_CUSTOMERS)
    banded = F.lit(None).cast("string")
    for upper, country in reversed(COUNTRY_BANDS):
        banded = F.when(place <= upper, F.lit(country)).otherwise(banded)
    return banded


def _category_of(product: Column) -> Column:
    return _one_based(product, CATEGORIES)


def _product_columns(product: Column, name: Column, unit_price: Column, kind: T.DataType) -> list[Column]:
    category = _category_of(product)
    return [
        product.cast(kind).alias("product_id"),
        name.alias("name"),
        unit_price.cast("float").alias("unit_price"),
        category.cast("int").alias("category_id"),
        F.concat(F.lit("Category "), category.cast("string")).alias("category_name"),
    ]


def _banded_price(product: Column) -> Column:
    return _category_of(product) * 5.0 + 4.99


def gen_customers(numbers: DataFrame, kind: T.DataType = IDS_NARROW, country: str | None = None) -> DataFrame:
    """Customers for an ``id`` relation, with the skewed country mix repeated every 500 ids."""
    number = F.col("id")
    where = F.lit(country) if country else _country_of(number)
    return numbers.select(
        number.cast(kind).alias("id"), F.concat(F.lit("Customer_"), number).alias("name"), where.alias("country")
    )


def gen_products(numbers: DataFrame, kind: T.DataType = IDS_NARROW, unit_price: float | None = None) -> DataFrame:
    """Products for an ``id`` relation; price follows the category unless fixed."""
    number = F.col("id")
    price = _banded_price(number) if unit_price is None else F.lit(unit_price)
    return numbers.select(*_product_columns(number, F.concat(F.lit("Product "), number), price, kind))


def _order_columns(
    number: Column, total: Column, day: Column, kind: T.DataType, customers: int, products: int
) -> list[Column]:
    return [
        number.cast(kind).alias("id"),
        _one_based(number, customers).cast(kind).alias("id_customer"),
        total.cast("float").alias("total"),
        day.cast("string").alias("date"),
        (F.pmod(number, F.lit(products)) + 1).cast(kind).alias("product_id"),
    ]


def _cycling_total(number: Column) -> Column:
    return (F.pmod(number, F.lit(99)) + 1) * 10


def gen_orders(
    numbers: DataFrame,
    seed_date: str | date,
    kind: T.DataType = IDS_NARROW,
    customers: int = INITIAL_CUSTOMERS,
    products: int = INITIAL_PRODUCTS,
) -> DataFrame:
    """Backfill orders for an ``id`` relation, spread over the year that ends on ``seed_date``."""
    number = F.col("id")
    back = F.pmod(number, F.lit(BACKFILL_DAYS)).cast("int")
    day = F.date_sub(F.lit(as_day(seed_date)), back)
    return numbers.select(*_order_columns(number, _cycling_total(number), day, kind, customers, products))


def _noise_qty(item: Column) -> Column:
    return (F.pmod(item * 7 + 3, F.lit(5)) + 1).cast("int")


def _noise_amount(item: Column) -> Column:
    """0.00 to 9.99."""
    return F.pmod(item * 7919, F.lit(1000)) / 100.0


def _line_value(order: Column, item: Column) -> Column:
    return F.round((F.pmod(order, F.lit(10)) + 1) * 15.0 + _noise_amount(item), 2).cast("float")


def _lines(numbers: DataFrame, per_order: int) -> DataFrame:
    """(order, seq, item) rows, ``per_order`` for each id."""
    spread = numbers.select(F.col("id").alias("order"), F.explode(F.sequence(F.lit(1), F.lit(per_order))).alias("seq"))
    return spread.withColumn("item", (F.col("order") - 1) * per_order + F.col("seq"))


def gen_order_items(
    order_numbers: DataFrame, kind: T.DataType = IDS_NARROW, per_order: int = ITEMS_PER_ORDER
) -> DataFrame:
    """Lines of the backfill orders; value rises with the product category of the order."""
    order, item = F.col("order"), F.col("item")
    return _lines(order_numbers, per_order).select(
        order.cast(kind).alias("id_order"),
        F.col("seq").cast("int").alias("seq"),
        F.concat(F.lit("Item_"), item).alias("desc_item"),
        _noise_qty(item).alias("qty"),
        _line_value(order, item).alias("total_item"),
    )


def day_slots(spark: SparkSession, seed_date: str | date, per_day: int = ORDERS_PER_DAY) -> DataFrame:
    """(seed_date, slot) rows of one day; any relation of this shape feeds the daily generators."""
    return spark.range(1, per_day + 1).select(
        F.lit(as_day(seed_date)).alias("seed_date"), F.col("id").alias("slot")
    )


def _day_number(per_day: int, seeded: int) -> Column:
    """Order number of a slot: days own disjoint ranges behind the ``seeded`` orders."""
    return F.lit(seeded) + day_offset(F.col("seed_date")).cast("bigint") * per_day + F.col("slot")


def day_range(seed_date: str | date, per_day: int = ORDERS_PER_DAY, seeded: int = INITIAL_ORDERS) -> tuple[int, int]:
    """First and last order number of a day."""
    first = seeded + (as_day(seed_date) - EPOCH_DAY).days * per_day
    return first + 1, first + per_day


def gen_day_orders(
    slots: DataFrame,
    kind: T.DataType = IDS_NARROW,
    per_day: int = ORDERS_PER_DAY,
    seeded: int = INITIAL_ORDERS,
    customers: int = INITIAL_CUSTOMERS,
    products: int = INITIAL_PRODUCTS,
) -> DataFrame:
    """Orders of the given days, all dated on their seed date, numbered behind the ``seeded`` ones."""
    numbered = slots.select("seed_date", _day_number(per_day, seeded).alias("id"))
    number = F.col("id")
    return numbered.select(*_order_columns(number, _cycling_total(number), F.col("seed_date"), kind, customers, products))


def gen_day_items(
    slots: DataFrame, kind: T.DataType = IDS_NARROW, per_day: int = ORDERS_PER_DAY, seeded: int = INITIAL_ORDERS
) -> DataFrame:
    """One line for each order of the given days."""
    number = F.col("id")
    return slots.select(_day_number(per_day, seeded).alias("id")).select(
        number.cast(kind).alias("id_order"),
        F.lit(1).cast("int").alias("seq"),
        F.concat(F.lit("Item_incr_"), number).alias("desc_item"),
        _noise_qty(number).alias("qty"),
        _line_value(number, number).alias("total_item"),
    )


def single_day(spark: SparkSession, seed_date: str | date) -> DataFrame:
    return spark.range(1).select(F.lit(as_day(seed_date)).alias("seed_date"))


def _rotation(days: DataFrame, per_day: int, size: int) -> DataFrame:
    """(seed_date, offset, number): the block of ``per_day`` numbers a day takes from 1..size."""
    offset = day_offset(F.col("seed_date")).cast("bigint")
    placed = days.select(
        "seed_date",
        offset.alias("offset"),
        F.explode(F.sequence(F.lit(0), F.lit(per_day - 1))).alias("step"),
    )
    place = F.pmod(F.col("offset") * per_day + F.col("step"), F.lit(size)) + 1
    return placed.select("seed_date", "offset", place.alias("number"))


def gen_country_updates(
    days: DataFrame, kind: T.DataType = IDS_NARROW, customers: int = INITIAL_CUSTOMERS
) -> DataFrame:
    """Customers that move on each day: a rotating block of 50, all to that day's country."""
    number = F.col("number")
    names = F.array(*[F.lit(c) for c in COUNTRY_ROTATION])
    country = F.element_at(names, (F.pmod(F.col("offset"), F.lit(len(COUNTRY_ROTATION))) + 1).cast("int"))
    return _rotation(days, min(COUNTRY_UPDATES_PER_DAY, customers), customers).select(
        "seed_date",
        number.cast(kind).alias("id"),
        F.concat(F.lit("Customer_"), number).alias("name"),
        country.alias("country"),
    )


def gen_rename_updates(days: DataFrame, kind: T.DataType = IDS_NARROW) -> DataFrame:
    """Products renamed on each day.

    The suffix counts how often the product was chosen through that day. One cycle of the rotation
    takes 50 days and chooses every product once, so the count is the number of started cycles.
    """
    number = F.col("number")
    cycle = INITIAL_PRODUCTS // RENAMES_PER_DAY
    times = F.floor(F.col("offset") / cycle) + 1
    name = F.concat(F.lit("Product "), number, F.lit("."), times)
    return _rotation(days, RENAMES_PER_DAY, INITIAL_PRODUCTS).select(
        "seed_date", *_product_columns(number, name, _banded_price(number), kind)
    )


def gen_load_orders(
    numbers: DataFrame,
    kind: T.DataType = IDS_NARROW,
    customers: int = INITIAL_CUSTOMERS,
    products: int = INITIAL_PRODUCTS,
) -> DataFrame:
    """Load-test orders: constant total, one date. Customer decides product, because 100 divides 500."""
    return numbers.select(*_order_columns(F.col("id"), F.lit(100.0), F.lit("2024-01-01"), kind, customers, products))


def gen_load_items(order_numbers: DataFrame, kind: T.DataType = IDS_NARROW) -> DataFrame:
    """Load-test lines: three per order, quantity 2, value 50."""
    return _lines(order_numbers, ITEMS_PER_ORDER).select(
        F.col("order").cast(kind).alias("id_order"),
        F.col("seq").cast("int").alias("seq"),
        F.concat(F.lit("Item_"), F.col("item")).alias("desc_item"),
        F.lit(2).cast("int").alias("qty"),
        F.lit(50.0).cast("float").alias("total_item"),
    )
