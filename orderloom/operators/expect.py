"""Table expectations: counts, invariants and equality, for integration and load checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import check_schema


class ExpectationFailed(RuntimeError):
    """A table does not hold what it should."""


def expect_count(df: DataFrame, expected: int, what: str = "table") -> None:
    found = df.count()
    if found != expected:
        raise ExpectationFailed(f"{what}: expected {expected} rows, got {found}")


def count_report(tables: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """(table, expected, found, as_expected) for every (name, what it was written from, what it holds): one row each."""
    made = None
    for name, source, written in tables:
        expected, found = (df.agg(F.count(F.lit(1)).alias("n")) for df in (source, written))
        row = expected.select(F.lit(name).alias("table"), F.col("n").alias("expected"), found.scalar().alias("found"))
        made = row if made is None else made.unionByName(row)
    return made.withColumn("as_expected", F.col("expected") == F.col("found"))


def violators(df: DataFrame, **expected) -> DataFrame:
    """Rows in which some column differs from its expected constant; NULL differs."""
    wrong = F.lit(False)
    for column, value in expected.items():
        wrong = wrong | ~F.col(column).eqNullSafe(F.lit(value))
    return df.filter(wrong)


def expect_none(df: DataFrame, violated: Column, what: str = "table") -> None:
    found = df.filter(violated).count()
    if found:
        raise ExpectationFailed(f"{what}: {found} rows violate the invariant")


def differences(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the surplus in ``actual`` (negative: missing).

    One grouped pass over both sides; equal rows cancel map-side and no copies are expanded.
    """
    aligned = check_schema(actual, expected.schema, "actual")
    signed = aligned.withColumn("_copies", F.lit(1)).unionByName(expected.withColumn("_copies", F.lit(-1)))
    return (
        signed.groupBy(*expected.columns)
        .agg(F.sum("_copies").alias("surplus"))
        .filter(F.col("surplus") != 0)
    )


def paired(differing: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``differences`` by key: both sides' measures, NULL on a side that lacks the key. Keys are unique on each side."""
    side = {"actual": F.col("surplus") > 0, "expected": F.col("surplus") < 0}
    return differing.groupBy(*keys).agg(
        *(F.max(F.when(held, F.col(m))).alias(f"{m}_{name}") for m in measures for name, held in side.items())
    )


def expect_equal(actual: DataFrame, expected: DataFrame, what: str = "table") -> None:
    """Both sides hold the same rows with the same number of copies."""
    found = differences(actual, expected).count()
    if found:
        raise ExpectationFailed(f"{what}: {found} distinct rows differ")
