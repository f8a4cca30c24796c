"""Bronze orders by batch: a day is checked against a ledger of ids, not against all orders before it.

``raw.order_daily`` and ``raw.order_daily_quarantine`` hold the valid and the quarantined rows of every batch in a
partition of its own; together they are what checking all orders at once gives. A day writes its own partitions,
and those earlier ones in which an order is repeated only now.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import schemas
from orderloom.functions.columns import as_day
from orderloom.operators import quality
from orderloom.operators.idbitmap import IndexedTable
from orderloom.operators.keys import with_keys_of
from orderloom.operators.orders import enrich_order
from orderloom.operators.tablewrites import (
    ensure_table,
    in_partitions,
    merge_insert_only,
    needs_backfill,
    overwrite_table,
    replace_partitions,
)
from orderloom.operators.uniqueness import BATCH, KeyLedger, check_batch, flagged
from orderloom.plans.medallion import (
    SILVER_KEYS,
    SILVER_LAYOUT,
    SOURCE,
    load_bronze_dimensions,
    load_bronze_items,
    load_gold,
)
from orderloom.schemas import check_schema
from orderloom.session import materialize
from orderloom.sources.tables import Lake

VALID = ("raw", "order_daily")
QUARANTINE = ("raw", "order_daily_quarantine")
LEDGER = ("ops", "order_ids")
KEYS = ("id",)
_FLAG = "_is_repeated"
#: Batch of the orders without a date in the first load.
NO_DATE = "undated"


def _in_batches(shape: T.StructType) -> T.StructType:
    return T.StructType([*shape.fields, T.StructField(BATCH, T.StringType())])


def _ledger(lake: Lake) -> KeyLedger:
    return KeyLedger(lake.spark, lake.name(*LEDGER), KEYS)


def load_order_batch(
    lake: Lake,
    orders: DataFrame,
    batch: str,
    fail_ratio: float = 1.0,
    rules: Sequence[quality.Rule] | None = None,
) -> tuple[int, int, float]:
    """Check ``orders``, all of one batch, and bring them to bronze; a repeated batch replaces itself.

    Returns valid, invalid and ratio of the batch. As in the full load the quarantine is written before the gate,
    by the pass that counts for it. When the gate stops the run, neither the valid rows nor the ledger know the
    batch, so it can be loaded again.
    """
    kind, spark = lake.ids, lake.spark
    rules = quality.order_rules() if rules is None else rules
    valid, quarantine = lake.name(*VALID), lake.name(*QUARANTINE)
    ensure_table(spark, valid, _in_batches(schemas.order_schema(kind)), partition_by=(BATCH,))
    ensure_table(spark, quarantine, _in_batches(schemas.quarantine_schema(kind)), partition_by=(BATCH,))

    rows = check_batch(orders, schemas.order_schema(kind), "orders")
    ledger = _ledger(lake)
    verdict = ledger.judge(rows, batch)
    annotated = quality.annotate(flagged(rows, verdict.repeated, KEYS, _FLAG), rules, _FLAG)
    counting, seen = quality.observed(annotated.withColumn(BATCH, F.lit(batch)))
    invalid = materialize(quality.invalid_rows(counting), "invalid")
    here = [Row(**{BATCH: batch})]
    replace_partitions(invalid, quarantine, _in_batches(schemas.quarantine_schema(kind)), here)
    good, bad, ratio = quality.observed_ratio(seen)
    quality.gate(good, bad, ratio, fail_ratio)

    _change_sides(lake, verdict.turned, rules)
    passed = quality.valid_rows(annotated).withColumn(BATCH, F.lit(batch))
    replace_partitions(passed, valid, _in_batches(schemas.order_schema(kind)), here)
    ledger.record(rows, batch)  # last: until then a repeated run sees the ledger as this one did
    return good, bad, ratio


def load_order_history(
    lake: Lake, orders: DataFrame, fail_ratio: float = 1.0, rules: Sequence[quality.Rule] | None = None
) -> tuple[int, int, float]:
    """The first load: all orders at once, in batches by their date, so that any day can be loaded again later."""
    kind = lake.ids
    rules = quality.order_rules() if rules is None else rules
    rows = check_schema(orders, schemas.order_schema(kind), "orders")
    rows = rows.withColumn(BATCH, F.coalesce("date", F.lit(NO_DATE)))
    annotated = quality.annotate(rows, rules)
    counting, seen = quality.observed(annotated)
    invalid = materialize(quality.invalid_rows(counting), "invalid")
    for name, kept, shape in (
        (QUARANTINE, invalid, schemas.quarantine_schema(kind)),
        (VALID, quality.valid_rows(annotated), schemas.order_schema(kind)),
    ):
        if name == VALID:
            good, bad, ratio = quality.observed_ratio(seen)
            quality.gate(good, bad, ratio, fail_ratio)
        overwrite_table(kept, lake.name(*name), _in_batches(shape), partition_by=(BATCH,), cluster_by=KEYS)
    _ledger(lake).record_all(rows)
    return good, bad, ratio


def _change_sides(lake: Lake, turned: DataFrame, rules: Sequence[quality.Rule]) -> None:
    """Judge the rows of ``turned`` (id, batch, repeated) again and rewrite the partitions they are in."""
    batches = turned.select(BATCH).distinct().collect()  # at most one row for each batch
    if not batches:
        return
    kind = lake.ids
    where = in_partitions((BATCH,), batches)
    good, bad = lake.read(*VALID).filter(where), lake.read(*QUARANTINE).filter(where)
    on = [*KEYS, BATCH]
    # an order with errors is in quarantine only; one with warnings, or nothing, is among the valid rows
    rows = good.unionByName(bad.filter(F.col("_errors").isNotNull()).select(*good.columns))
    rows = rows.dropDuplicates(on)  # a turned key has one copy; a run that was cut off may have left it on both sides
    again = quality.annotate(rows.join(turned.withColumnRenamed("repeated", _FLAG), on), rules, _FLAG)
    again = materialize(again, "judged-again")
    stay = [x.join(turned.select(*on), on, "left_anti") for x in (good, bad)]
    for kept, fresh, name, shape in (
        (stay[1], quality.invalid_rows(again), QUARANTINE, schemas.quarantine_schema(kind)),
        (stay[0], quality.valid_rows(again), VALID, schemas.order_schema(kind)),
    ):
        replace_partitions(kept.unionByName(fresh), lake.name(*name), _in_batches(shape), batches)


def run_day(
    lake: Lake,
    seed_date: str | date,
    fail_ratio: float = 1.0,
    checkpoints: str | None = None,
    silver_span_shift: int | None = None,
) -> tuple[int, int, float]:
    """Bronze, silver and gold for one day, with work that follows the day's orders.

    The first run takes all orders, in batches by date; later ones take those dated on the day, as its batch. Silver
    is as in the full run: lines are booked once, also those of an order that a later batch repeats.

    With ``silver_span_shift`` silver is an ``IndexedTable`` of that span, for order ids that a day spreads over the
    whole range: otherwise known lines are looked for in the key range of the day's.
    """
    day = as_day(seed_date).isoformat()
    orders = lake.read(SOURCE, "order")
    load_bronze_dimensions(lake)
    if needs_backfill(lake.spark, lake.name(*LEDGER)):
        counts = load_order_history(lake, orders, fail_ratio)
    else:
        counts = load_order_batch(lake, orders.filter(F.col("date") == day), day, fail_ratio)
    load_bronze_items(lake, checkpoints)

    _load_silver(lake, day, silver_span_shift)
    load_gold(lake, seed_date)
    return counts


def _load_silver(lake: Lake, day: str, span_shift: int | None) -> None:
    target, shape = lake.name("curated", "order_enriched"), schemas.silver_schema(lake.ids)
    customer, product = lake.read("raw", "customer"), lake.read("raw", "product")
    booked, lines = lake.read(*VALID), lake.read("raw", "order_item")
    indexed = None if span_shift is None else IndexedTable(lake.spark, target, shape, SILVER_KEYS, span_shift)
    if needs_backfill(lake.spark, target):
        enriched = enrich_order(customer, booked.drop(BATCH), lines, product)
        if indexed:
            indexed.replace(enriched)
        else:
            overwrite_table(enriched, target, shape, cluster_by=SILVER_LAYOUT)
        return
    today = booked.filter(F.col(BATCH) == day).drop(BATCH)
    fresh = enrich_order(customer, today, with_keys_of(lines, "id_order", today, "id"), product)
    if indexed:
        indexed.merge_insert_only(fresh)
    else:
        merge_insert_only(fresh, target, shape, SILVER_KEYS)
