"""Layered namespace and table readers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderloom import schemas

LAYERS = ("external_source", "raw", "curated", "report", "ops")


@dataclass(frozen=True)
class Lake:
    """One isolated copy of the layered databases; ``prefix`` separates environments."""

    spark: SparkSession
    prefix: str = ""
    ids: T.DataType = field(default_factory=lambda: schemas.IDS_NARROW)

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"`{self.database(layer)}`.`{table}`"

    def create(self, location: str | None = None) -> "Lake":
        """Create the databases, under ``location`` when given."""
        for layer in LAYERS:
            where = f" LOCATION '{location}/{layer}'" if location else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database(layer)}`{where}")
        return self

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.table(self.name(layer, table))

    def read_stream(self, layer: str, table: str, files_per_batch: int | None = None) -> DataFrame:
        """Append-only table as a stream. The table must only ever be appended to."""
        reader = self.spark.readStream
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.table(self.name(layer, table))
