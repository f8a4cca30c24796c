"""Report formatting as a projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import cell


def format_report(df: DataFrame) -> DataFrame:
    """Every column as display text; the frame keeps its columns and rows."""
    return df.select(*[cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
