"""Consume-once appends from one table to another."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.tablewrites import ensure_table, table_exists
from orderloom.schemas import check_schema
from orderloom.sources.tables import Lake

_OFFSETS = "orderloom.stream.checkpoint"


def _known_offsets(lake: Lake, table: str) -> str | None:
    """Checkpoint folder of the target's current generation, remembered on the table itself."""
    if not table_exists(lake.spark, table):
        return None
    properties = lake.spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == _OFFSETS).collect()
    return properties[0]["value"] if properties else None


def _offsets_of(lake: Lake, table: str, schema: T.StructType, checkpoints: str) -> str:
    known = _known_offsets(lake, table)
    if known:
        if known.rpartition("/")[0] != checkpoints.rstrip("/"):
            warnings.warn(f"{table} goes on from {known}, not from {checkpoints}", stacklevel=3)
        return known
    folder = f"{checkpoints.rstrip('/')}/{uuid.uuid4().hex}"
    ensure_table(lake.spark, table, schema)
    if not lake.spark.table(table).isEmpty():
        raise ValueError(f"{table} was filled by other means; use full_refresh to rebuild it as a stream")
    lake.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_OFFSETS}' = '{folder}')")
    return folder


def filled_by_stream(lake: Lake, table: str) -> bool:
    """True when the table is the target of a stream and not of a batch write."""
    return _known_offsets(lake, table) is not None


def stream_append(
    lake: Lake,
    source: tuple[str, str],
    target: tuple[str, str],
    schema: T.StructType,
    checkpoints: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    full_refresh: bool = False,
    files_per_batch: int | None = None,
) -> None:
    """Append the source rows that arrived since the last run, then stop.

    Each source row is transformed and written once. A full refresh drops the target and consumes
    the source from the start. ``checkpoints`` is a folder on shared storage. ``files_per_batch``
    divides a large backlog into micro-batches that commit one by one. The source must be
    append-only: rewriting it replays all rows.
    """
    table = lake.name(*target)
    if full_refresh:
        lake.spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = lake.read_stream(*source, files_per_batch=files_per_batch)
    if transform is not None:
        rows = transform(rows)
    rows = check_schema(rows, schema, table)
    query = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", _offsets_of(lake, table, schema, checkpoints))
        .trigger(availableNow=True)
        .toTable(table.replace("`", ""))
    )
    query.awaitTermination()
    lake.spark.catalog.refreshTable(table)
