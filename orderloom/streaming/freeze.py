"""The streaming form of the lake: recomputed views around two append-only streams.

Customer, product, order and gold are views: recomputed and replaced at each refresh. Lines and
silver are streams: a line is joined once, against the dimensions as they are then, and its names
stay frozen. A line whose order, customer or product is not there yet is dropped for good. Repeated
order ids are not filtered; only rows without an id or customer are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators.orders import enrich_order
from orderloom.operators.tablewrites import overwrite_table
from orderloom.plans.medallion import ORDER_LAYOUT, PRODUCT_LAYOUT, SOURCE, backfill_gold
from orderloom.sources.tables import Lake
from orderloom.streaming.append import filled_by_stream, stream_append

ITEMS = ("raw", "order_item_sdp")
SILVER = ("curated", "order_enriched_sdp")
GOLD_TABLE = "order_agg_sdp"


def identified_orders(order: DataFrame) -> DataFrame:
    """Orders with an id and a customer."""
    return order.filter(F.col("id").isNotNull() & F.col("id_customer").isNotNull())


ORDERS = ("raw", "order_sdp")


def refresh_order_view(lake: Lake, checkpoints: str | None = None) -> None:
    """The identified orders: recomputed, or with ``checkpoints`` only what is new since the last refresh appended.

    The view keeps a row or not by that row alone, so while orders are only ever appended at the source, appending
    gives what recomputing gives. A view that was last recomputed is rebuilt by the first incremental refresh. Silver
    reads all orders at each trigger, so they are sorted within files but not shuffled into a layout.
    """
    shape, target = schemas.order_schema(lake.ids), lake.name(*ORDERS)
    if checkpoints is None:
        overwrite_table(identified_orders(lake.read(SOURCE, "order")), target, shape, sort_by=ORDER_LAYOUT)
        return
    rebuild = not filled_by_stream(lake, target)
    source, offsets = (SOURCE, "order"), f"{checkpoints}/order_view"
    stream_append(lake, source, ORDERS, shape, offsets, transform=identified_orders, full_refresh=rebuild)


def refresh_dimension_views(lake: Lake, order_checkpoints: str | None = None) -> None:
    """Bring the three views up to date; customers and products change in place and are recomputed."""
    kind = lake.ids
    overwrite_table(
        lake.read(SOURCE, "customer"), lake.name("raw", "customer_sdp"), schemas.customer_schema(kind)
    )
    overwrite_table(
        lake.read(SOURCE, "product"),
        lake.name("raw", "product_sdp"),
        schemas.product_schema(kind),
        cluster_by=PRODUCT_LAYOUT,
    )
    refresh_order_view(lake, order_checkpoints)


def stream_items(
    lake: Lake, checkpoints: str, full_refresh: bool = False, files_per_batch: int | None = None
) -> None:
    stream_append(
        lake,
        (SOURCE, "order_item"),
        ITEMS,
        schemas.order_item_schema(lake.ids),
        f"{checkpoints}/items",
        full_refresh=full_refresh,
        files_per_batch=files_per_batch,
    )


def stream_silver(
    lake: Lake, checkpoints: str, full_refresh: bool = False, files_per_batch: int | None = None
) -> None:
    """Stream-static join; the static side is resolved anew at each call."""
    customer, order, product = (lake.read("raw", f"{t}_sdp") for t in ("customer", "order", "product"))
    stream_append(
        lake,
        ITEMS,
        SILVER,
        schemas.silver_schema(lake.ids),
        f"{checkpoints}/silver",
        transform=lambda lines: enrich_order(customer, order, lines, product),
        full_refresh=full_refresh,
        files_per_batch=files_per_batch,
    )


def refresh_gold_view(lake: Lake) -> None:
    """Re-sum frozen silver; names are not restated."""
    backfill_gold(lake, lake.read(*SILVER), GOLD_TABLE)


def refresh(
    lake: Lake,
    checkpoints: str,
    full_refresh: bool = False,
    files_per_batch: int | None = None,
    append_orders: bool = False,
) -> None:
    """One update of the whole streaming side, in dependency order.

    With ``append_orders`` the order view takes in new orders instead of being recomputed.
    """
    refresh_dimension_views(lake, checkpoints if append_orders else None)
    stream_items(lake, checkpoints, full_refresh, files_per_batch)
    stream_silver(lake, checkpoints, full_refresh, files_per_batch)
    refresh_gold_view(lake)
