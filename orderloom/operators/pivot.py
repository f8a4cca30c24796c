"""Weekly pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import starred
from orderloom.session import materialize


def weekly_cells(df: DataFrame, label: str, value: str, flag: str | None = None) -> DataFrame:
    """(week, label, amount, flagged): the long form of the pivot; unbounded in labels."""
    marked = F.bool_or(F.col(flag)) if flag else F.lit(False)
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy("week", F.col(label).alias("label"))
        .agg(F.coalesce(F.sum(value), F.lit(0)).alias("amount"), F.coalesce(marked, F.lit(False)).alias("flagged"))
    )


#: Columns of a pivot. More labels are for ``weekly_cells``: neither the driver nor a row should hold them.
MOST_LABELS = 2000


class TooManyLabels(ValueError):
    """A pivot that would have more columns than ``MOST_LABELS``."""


def weekly_pivot(
    df: DataFrame, label: str, value: str, flag: str | None = None, most_labels: int = MOST_LABELS
) -> DataFrame:
    """Weeks as rows, labels as columns, plus ``Total``; missing cells are 0.

    ``df`` is reduced to one row per week and label first; finding the columns and pivoting both
    read that result, not the input. Labels whose sum is not positive get no column and are not in
    ``Total``. A week with a flagged row is marked ``*``. Every other label gets a column; more than
    ``most_labels`` of them raise, and none is left out: ``weekly_cells`` is the same result as rows.
    """
    cells = materialize(weekly_cells(df, label, value, flag), "pivot")
    spending = cells.groupBy("label").agg(F.sum("amount").alias("amount")).filter("amount > 0")
    columns = [row["label"] for row in spending.orderBy("label").limit(most_labels + 1).collect()]
    if len(columns) > most_labels:
        raise TooManyLabels(f"more than {most_labels} labels; use weekly_cells")
    chosen = F.col("label").isin(columns) if columns else F.lit(False)
    per_label = [
        F.sum(F.when(F.col("label") == F.lit(c), F.col("amount")).otherwise(F.lit(0))).alias(c) for c in columns
    ]
    total = F.sum(F.when(chosen, F.col("amount")).otherwise(F.lit(0)))
    wide = cells.groupBy("week").agg(F.bool_or("flagged").alias("_flagged"), *per_label, total.alias("Total"))
    names = [F.col(f"`{c}`") for c in columns]
    return wide.select(starred(F.col("week"), F.col("_flagged")).alias("Week"), *names, "Total")
